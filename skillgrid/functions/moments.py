"""Error statistics of forecast f, analysis a and climatology c from one pass of sums.

Every mean is taken where its own expression and the weight are present, so that
different means may rest on different cells. All centred moments follow from
sums of raw ones: with d = f - c, e = a - c and D, E the differences of the
means of f, a with that of c, the mean of (d - D)^2 is that of d^2 less 2 D times that of d, plus D^2.
The same sums serve as aggregates and as window frames.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The expressions whose weighted means are needed.
TERMS: dict[str, Callable[[Column, Column, Column], Column]] = {
    "f": lambda f, a, c: f,
    "a": lambda f, a, c: a,
    "c": lambda f, a, c: c,
    "d": lambda f, a, c: f - c,
    "e": lambda f, a, c: a - c,
    "dd": lambda f, a, c: (f - c) * (f - c),
    "ee": lambda f, a, c: (a - c) * (a - c),
    "de": lambda f, a, c: (f - c) * (a - c),
    "d_de": lambda f, a, c: F.when(a.isNotNull(), f - c),
    "e_de": lambda f, a, c: F.when(f.isNotNull(), a - c),
    "x": lambda f, a, c: f - a,
    "xx": lambda f, a, c: (f - a) * (f - a),
    "ff": lambda f, a, c: f * f,
    "aa": lambda f, a, c: a * a,
    "fa": lambda f, a, c: f * a,
    "f_fa": lambda f, a, c: F.when(a.isNotNull(), f),
    "a_fa": lambda f, a, c: F.when(f.isNotNull(), a),
}
#: The terms that RMSE and anomaly correlation need.
BASIC = ("f", "a", "c", "d", "e", "dd", "ee", "de", "d_de", "e_de", "x", "xx")


def raw_sums(f: Column, a: Column, c: Column, w: Column, terms: tuple[str, ...], total: Callable[[Column], Column]) -> list[Column]:
    """Sums s_<term> of the weighted terms and n_<term> of the weights where they are present."""
    out = []
    for name in terms:
        term = TERMS[name](f, a, c)
        out.append(total(term * w).alias(f"s_{name}"))
        out.append(total(F.when(term.isNotNull(), w)).alias(f"n_{name}"))
    return out


def shifts(shifted: bool = True) -> tuple[Column, Column, Column]:
    """f, a and c, less the column ``shift`` if wanted.

    One constant taken from all three leaves every statistic as it is, as they rest on differences; but sums of squares of values
    that are large against their spread, such as pressures in Pa, then keep their digits (A5-A12).
    """
    return tuple(F.col(x) - F.col("shift") if shifted else F.col(x) for x in "fac")


def with_shift(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells with ``shift``: the mean of c, or else of f, over the rows of the same ``keys`` (a variable, a level), null keys included.

    Keys should be few: their means are counted and, if few, broadcast.
    """
    centre = F.coalesce(F.avg("c"), F.avg("f"), F.lit(0.0)).alias("shift")
    if not keys:
        return cells.crossJoin(F.broadcast(cells.agg(centre)))
    table = cells.groupBy(*keys).agg(centre).select(*(F.col(k).alias(f"__{k}") for k in keys), "shift")
    on = [cells[k].eqNullSafe(table[f"__{k}"]) for k in keys]
    return cells.join(F.broadcast(table), on).drop(*(f"__{k}" for k in keys))


def means(terms: tuple[str, ...]) -> dict[str, Column]:
    """Weighted means m_<term>; null where no weight is left (A1)."""
    return {f"m_{t}": F.try_divide(F.col(f"s_{t}"), F.when(F.col(f"n_{t}") != 0, F.col(f"n_{t}"))) for t in terms}


#: A variance is none if it is at most this share of the second moment it is the rest of: that much is rounding.
NO_VARIANCE = 1e-13


def _spread(variance: Column, raw: Column) -> Column:
    """Standard deviation; exactly 0 where only rounding is left, whatever the unit. Missing stays missing."""
    return F.when(variance <= NO_VARIANCE * raw, 0.0).otherwise(F.sqrt(F.when(variance < 0, 0.0).otherwise(variance)))


def _root(x: Column) -> Column:
    # greatest() would make a missing value 0
    return F.sqrt(F.when(x < 0, 0.0).otherwise(x))


def anomaly_correlation() -> Column:
    """A5 from the means."""
    m = lambda t: F.col(f"m_{t}")
    big_d, big_e = m("f") - m("c"), m("a") - m("c")
    f_var = m("dd") - 2 * big_d * m("d") + big_d * big_d
    a_var = m("ee") - 2 * big_e * m("e") + big_e * big_e
    cov = m("de") - big_e * m("d_de") - big_d * m("e_de") + big_d * big_e
    scale = _spread(f_var, m("dd")) * _spread(a_var, m("ee"))
    return F.try_divide(cov, F.when(scale != 0, scale))


def statistics(wanted: tuple[str, ...]) -> dict[str, Column]:
    """Columns of the wanted statistics from the means."""
    m = lambda t: F.col(f"m_{t}")
    mse = m("xx")
    bar = F.abs(m("f") - m("a"))
    s_f, s_a = _spread(m("ff") - m("f") * m("f"), m("ff")), _spread(m("aa") - m("a") * m("a"), m("aa"))
    amp = F.abs(s_f - s_a)
    scale = s_f * s_a
    cross = m("fa") - m("a") * m("f_fa") - m("f") * m("a_fa") + m("f") * m("a")
    rho = F.try_divide(cross, F.when(scale != 0, scale))
    dsp = 2 * (1 - rho) * scale
    phz = F.when(dsp >= 0, F.sqrt(F.greatest(dsp, F.lit(0.0)))).when((dsp > -1e-3) & (dsp < 0), 0.0)
    shift = m("f") - m("a")
    ran = _root(m("xx") - 2 * shift * m("x") + shift * shift)
    every = {
        "me": m("x"), "mse": mse, "rms": _root(mse), "acorr": anomaly_correlation(), "rms_bar": bar, "rms_amp": amp,
        "rms_dis": (s_f - s_a) * (s_f - s_a) + bar * bar, "rms_dsp": dsp, "rms_phz": phz, "rms_ran": ran,
        "res1": F.sqrt(F.abs(mse - bar * bar - amp * amp - phz * phz)), "res2": F.sqrt(F.abs(mse - bar * bar - ran * ran)),
    }
    return {k: every[k] for k in wanted}
