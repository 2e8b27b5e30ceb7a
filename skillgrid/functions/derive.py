"""Derived variables, names, scales, and numbers on scorecards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .catalog import DEPENDENCIES, VARIABLES


def dew_point(q: Column, ps: Column) -> Column:
    """Dew point in K from specific humidity (kg/kg) and surface pressure (Pa), after Bolton (1980) (F1)."""
    vapour = ps / 100 * q / (F.lit(0.622) + F.lit(0.378) * q)
    log = F.ln(vapour / 6.112)
    return F.try_divide(F.lit(243.5) * log, F.lit(17.67) - log) + 273.15


#: Derived variables: what is computed from the columns of DEPENDENCIES (F1-F5); missing values stay missing.
FORMULAS: dict[str, Callable[..., Column]] = {
    "D2m": dew_point,
    "LOGAOD": lambda aod: F.ln(aod + 0.01),
    "Z": lambda h: h * 9.80665,
    "PM25": lambda *mass: sum(mass[1:], mass[0]),
}


def with_derived(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with derived variables; what a file already holds is not computed again (F5). Missing dependencies raise."""
    have = {c.lower(): c for c in df.columns}
    for name in names:
        if name.lower() in have:
            continue
        missing = [d for d in DEPENDENCIES[name] if d.lower() not in have]
        if missing:
            raise ValueError(f"{name} needs {', '.join(missing)}")
        df = df.withColumn(name, FORMULAS[name](*(F.col(have[d.lower()]) for d in DEPENDENCIES[name])))
        have[name.lower()] = name
    return df


def across_collections(collections: list[DataFrame], keys: list[str], names: list[str]) -> DataFrame:
    """The first collection with derived variables whose dependencies may lie in others.

    Only the lacking dependencies are taken from the first other collection that has them, joined on the
    coordinates; a dependency that none has is an error.
    """
    out = collections[0]
    needed = [d for n in names if n.lower() not in {c.lower() for c in out.columns} for d in DEPENDENCIES[n]]
    for other in collections[1:]:
        have = {c.lower() for c in out.columns}
        more = [c for c in other.columns if c not in keys and c.lower() in {d.lower() for d in needed} - have]
        if more:
            out = out.join(other.select(*keys, *more), keys, "left")
    return with_derived(out, names)


def normal_name(name: Column) -> Column:
    """A variable's name: upper case before the first digit, lower case from there on."""
    head = F.regexp_extract(name, r"^([^0-9]*)", 1)
    return F.concat(F.upper(head), F.lower(F.substr(name, F.length(head) + 1)))


def scaled(value: Column, var: Column) -> Column:
    """A value in display units."""
    factor = F.lit(1.0)
    for f in sorted({f for _, _, f in VARIABLES.values()} - {1.0}):
        factor = F.when(F.upper(var).isin(*(n for n, v in VARIABLES.items() if v[2] == f)), f).otherwise(factor)
    return value * factor


def unscaled_for_scorecard(value: Column, var: Column, stat: Column) -> Column:
    """A statistic in the units of scorecards (F7): humidity and particles back, pressures as they are."""
    name, squared = F.upper(var), stat.isin("rms_dis", "rms_dsp")
    factor = (
        F.when(stat == "acorr", 1.0)
        .when(name.isin("Q", "Q2M"), F.when(squared, 1e-6).otherwise(1e-3))
        .when(name == "PM25", F.when(squared, 1e-12).otherwise(1e-6))
        .otherwise(1.0)
    )
    return value * factor


def seven_digits(value: Column) -> Column:
    """A number with seven significant digits as scorecards write it (F8).

    Digits are those of the double itself, to the nearest and of two equally near to the even one, as C prints them
    (but subnormals, which are written from their few own digits).
    """
    x = value.cast("double")
    size = F.abs(x)
    pattern = lambda p: F.call_function("format_number", x, F.lit(p))
    # 1.234567E5 and 1.234567E-5 become 1.234567E+05 and 1.234567E-05
    power = F.regexp_replace(F.regexp_replace(pattern("0.000000E00"), "E([0-9])", "E+$1"), "E([+-])([0-9])$", "E$10$2")
    out = F.when(x.isNull() | F.isnan(x), "9.9999999E+14").when(x == 0, "0.0000000")
    out = out.when((size < 0.01) | (size >= 10000), power)
    for digits in (1, 2, 3):
        out = out.when(size < 10**digits, pattern("0." + "0" * (7 - digits)))
    return out.otherwise(pattern("0.000"))


def display_name(name: Column) -> Column:
    """An experiment's name if it consists of letters and digits, else null."""
    return F.when(name.rlike("^[A-Za-z0-9]+$"), name)


def split_stat_name(name: Column) -> dict[str, Column]:
    """Variable, statistic and kind of an array name such as T_rms_bar_avg."""
    base = F.regexp_replace(name, "_(avg|glo)$", "")
    return {
        "var": F.regexp_extract(base, "^([^_]+)_", 1),
        "stat": F.regexp_extract(base, "^[^_]+_(.*)$", 1),
        "kind": F.coalesce(F.nullif(F.regexp_extract(name, "_(avg|glo)$", 1), F.lit("")), F.lit("each")),
    }
