"""Alignment of forecast, analysis and climatology, and merges of collections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = ("lat_idx", "lon_idx")


#: Rows of a few numbers up to this are broadcast (under 100 MB); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if a count shows that it is small; the count stops beyond the bound."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on equal names in which a missing level is a level of its own: 2-D variables have ``lev`` null.

    Spark still hashes or sorts both sides by all keys.
    """
    if "lev" not in keys:
        return left.join(right, keys, how)
    r = right.select(*(F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in right.columns))
    on = [left[k].eqNullSafe(r[f"__{k}"]) if k == "lev" else left[k] == r[f"__{k}"] for k in keys]
    return left.join(r, on, how).drop(*(f"__{k}" for k in keys))


def with_known_times(cells: DataFrame, other: DataFrame, time: list[str], name: str) -> DataFrame:
    """``cells``, whose reading fails at a time that the other field lacks altogether (J1); no job runs before.

    Times are few (a row an hour makes a million in a century), so they are broadcast.
    """
    times = other.select(*time).distinct().select(*time, F.lit(True).alias("__known"))
    told = F.concat(F.lit(f"{name} has no time "), F.concat_ws(", ", *(F.concat(F.lit(f"{t}="), F.col(t).cast("string")) for t in time)))
    flagged = cells.join(F.broadcast(times), time, "left")
    return flagged.where(F.when(F.col("__known"), F.lit(True)).otherwise(F.raise_error(told).cast("boolean"))).drop("__known")


def aligned(fcst: DataFrame, ana: DataFrame, clim: DataFrame, time: tuple[str, ...], clim_time: tuple[str, ...] | None = None, absent: str = "error") -> DataFrame:
    """Forecast cells with the analysis and climatology of their valid time.

    Cells without counterpart keep a null there; a time that a field lacks altogether is an error when the result is read, or null as well
    with ``absent="null"``. Joins are on time, variable, level (null for 2-D variables) and cell, where both sides have these, so Spark can
    hash both sides once on these keys.
    """
    if absent not in ("error", "null"):
        raise ValueError(f"absent times are an error or null, not {absent}")
    joined = fcst
    for other, name, at in ((ana, "the analysis", time), (clim, "the climatology", time if clim_time is None else clim_time)):
        if absent == "error" and at:
            joined = with_known_times(joined, other, list(at), name)
        extra = [k for k in ("var", "lev") if k in fcst.columns and k in other.columns]
        joined = null_safe_join(joined, other, [*at, *extra, *CELL])
    return joined


def missing_times(fcst: DataFrame, other: DataFrame, time: tuple[str, ...]) -> DataFrame:
    """Times of the forecast that the other field lacks; an error if there are any."""
    return fcst.select(*time).distinct().join(other.select(*time).distinct(), list(time), "left_anti")


def by_region(cells: DataFrame, region_cells: DataFrame) -> DataFrame:
    """Cells with every region that holds them."""
    return cells.join(small(region_cells), list(CELL))


def with_weights(cells: DataFrame, weights: DataFrame) -> DataFrame:
    """Cells with their weight (J3); weights that know levels join null-safely on the level."""
    if "lev" not in weights.columns:
        return cells.join(small(weights), list(CELL))
    (value,) = (c for c in weights.columns if c not in (*CELL, "lev"))
    w = weights.select(F.col("lev").alias("__lev"), *(F.col(k).alias(f"__{k}") for k in CELL), F.col(value).alias("grid_weight"))
    on = [cells[k] == w[f"__{k}"] for k in CELL] + [cells["lev"].eqNullSafe(w["__lev"])]
    return cells.join(small(w), on).drop("__lat_idx", "__lon_idx", "__lev")


def interpolated_climatology(times: DataFrame, clim_raw: DataFrame, value: str = "c") -> DataFrame:
    """Monthly means of the right cycle blended at every time.

    ``times`` has (valid_time, cycle, m1, w1, m2, w2). Each time is exploded into
    its two months, joined once and summed; a month that is missing makes the result missing.
    """
    two = F.explode(F.array(F.struct(F.col("m1").alias("month"), F.col("w1").alias("w")), F.struct(F.col("m2").alias("month"), F.col("w2").alias("w"))))
    wanted = times.select("valid_time", "cycle", two.alias("p")).select("valid_time", "cycle", "p.month", "p.w")
    both = clim_raw.join(small(wanted), ["cycle", "month"]).groupBy("valid_time", *CELL)
    whole = F.count(F.col(value)) == 2
    return both.agg(F.when(whole, F.sum(F.col(value) * F.col("w"))).alias(value))


def climatology_gaps(times: DataFrame, clim_raw: DataFrame) -> DataFrame:
    """(cycle, n_months): cycles that times need and for which the climatology has not all twelve months."""
    have = clim_raw.groupBy("cycle").agg(F.count_distinct("month").alias("n"))
    found = times.select("cycle").distinct().join(have, "cycle", "left").select("cycle", F.coalesce("n", F.lit(0)).cast("int").alias("n_months"))
    return found.where("n_months < 12")


def merged(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Collections on the same coordinates in one frame; a variable in several is the first's, as a whole.

    Where the first has such a variable missing or has no such cell it stays missing: values of
    different files are never mixed within a variable.
    """

    def two(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right.drop(*(c for c in right.columns if c in left.columns and c not in keys)), keys, "full")

    return reduce(two, frames)


def combined(single: DataFrame, multi: DataFrame, keys: list[str]) -> DataFrame:
    """Files of one lead and of several together; variables that files of several leads hold replace the others whole."""
    names = dict.fromkeys(c for c in (*single.columns, *multi.columns) if c not in keys)
    return merged([multi, single], keys).select(*keys, *names)


def lead_from_first_time(cells: DataFrame, init: str = "init_idx", time: str = "valid_time") -> DataFrame:
    """Cells with lead in hours since the first time of their run."""
    first = cells.groupBy(init).agg(F.min(time).alias("__first"))
    # runs are few rows against cells, and the join keeps cells where they are
    out = cells.join(first, init)
    return out.withColumn("lead", F.timestamp_diff("HOUR", F.col("__first"), F.col(time)).cast("int")).drop("__first")


def long_form(wide: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """Wide cells as (keys, var, value)."""
    return wide.unpivot(keys, variables, "var", "value")


def without_nan(df: DataFrame, variables: list[str]) -> DataFrame:
    """NaN as null, so that aggregates skip what is missing."""
    return df.withColumns({v: F.nanvl(F.col(v).cast("double"), F.lit(None).cast("double")) for v in variables})


def first_slice(df: DataFrame, stray: Column, keys: list[str]) -> DataFrame:
    """The first value of a stray dimension only."""
    low = df.groupBy(*keys).agg(F.min(stray).alias("__low"))
    return df.withColumn("__at", stray).join(low, keys).where("__at = __low").drop("__low", "__at")
