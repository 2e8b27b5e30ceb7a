"""Regional and per-gridpoint statistics, their weights and their averages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.moments import BASIC, TERMS, means, raw_sums, shifts, statistics
from .align import null_safe_join, small

ALL_TERMS = tuple(TERMS)


def terms_of(wanted: tuple[str, ...]) -> tuple[str, ...]:
    """The terms whose sums the wanted statistics need."""
    return BASIC if set(wanted) <= {"rms", "acorr", "me", "mse"} else ALL_TERMS


def regional(cells: DataFrame, keys: list[str], wanted: tuple[str, ...] = ("rms", "acorr"), weight: str = "grid_weight", shift: bool = False) -> DataFrame:
    """Area-weighted statistics of cells (keys, f, a, c, weight), one row a key.

    One hash aggregation with partial sums before the shuffle, whatever is wanted. With ``shift``, sums are of values less the column
    ``shift`` (``with_shift``), which is constant within a key.
    """
    terms = terms_of(wanted)
    sums = raw_sums(*shifts(shift), F.col(weight), terms, F.sum)
    got = cells.groupBy(*keys).agg(*sums).withColumns(means(terms))
    return got.select(*keys, *(s.alias(n) for n, s in statistics(wanted).items()))


def dense(cells: DataFrame, keys: list[str], grid: DataFrame, values: list[str]) -> DataFrame:
    """One row for every key and grid cell, null where there was none.

    The grid, a row a cell, goes along with every key as one array that explodes there (a million cells take 20 MB).
    """
    whole = F.broadcast(grid.agg(F.collect_list(F.struct(*grid.columns)).alias("__grid")))
    every = cells.select(*keys).distinct().crossJoin(whole).select(*keys, F.explode("__grid").alias("__g")).select(*keys, "__g.*")
    return null_safe_join(every, cells.select(*keys, "lat_idx", "lon_idx", *values), [*keys, "lat_idx", "lon_idx"])


def pointwise(cells: DataFrame, keys: list[str], size: int, wanted: tuple[str, ...] = ("rms", "acorr"), wrap_lon: int | None = None) -> DataFrame:
    """Statistics in a moving window of size x size cells around every cell.

    ``cells`` is dense and weighted. Sums run over longitude and then over latitude, so that
    the cost is linear in the window's side, and one exchange by ``keys`` and latitude is
    all that either pass needs beyond its sort. A window counts only if each of f, a and c has at
    least half of its cells. ``wrap_lon`` (cells around the globe) makes windows go around the date line.
    """
    terms, half = terms_of(wanted), size // 2
    f, a, c, w = F.col("f"), F.col("a"), F.col("c"), F.col("grid_weight")
    if wrap_lon:
        left = cells.where(F.col("lon_idx") >= wrap_lon - half).withColumn("lon_idx", F.col("lon_idx") - wrap_lon)
        right = cells.where(F.col("lon_idx") < half).withColumn("lon_idx", F.col("lon_idx") + wrap_lon)
        cells = cells.unionByName(left).unionByName(right)
    cells = cells.repartition(*keys)
    along = Window.partitionBy(*keys, "lat_idx").orderBy("lon_idx").rangeBetween(-half, half)
    across = Window.partitionBy(*keys, "lon_idx").orderBy("lat_idx").rangeBetween(-half, half)
    counts = [F.count(x).over(along).alias(f"k_{n}") for n, x in (("f", f), ("a", a), ("c", c))]
    first = cells.select(*keys, "lat_idx", "lon_idx", "f", "a", "c", *raw_sums(f, a, c, w, terms, lambda x: F.sum(x).over(along)), *counts)
    if wrap_lon:
        first = first.where(F.col("lon_idx").between(0, wrap_lon - 1))
    names = [n for t in terms for n in (f"s_{t}", f"n_{t}")] + ["k_f", "k_a", "k_c"]
    second = first.select(*keys, "lat_idx", "lon_idx", "f", "a", "c", *(F.sum(n).over(across).alias(n) for n in names))
    enough = F.least("k_f", "k_a", "k_c") >= int(size * size * 0.5)
    got = second.withColumns(means(terms))
    return got.select(*keys, "lat_idx", "lon_idx", "f", "a", (F.col("f") - F.col("c")).alias("f_c"), *(F.when(enough, s).alias(n) for n, s in statistics(wanted).items()))


def averaged(stats: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Means over init dates, skipping what is missing."""
    return stats.groupBy(*keys).agg(*(F.avg(v).alias(f"{v}_avg") for v in values))


def global_mean(maps: DataFrame, weights: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Weighted means over all cells of averaged maps (A14); weights (lat_idx, lon_idx[, keys], weight), by level where they have one."""
    on = [k for k in (*keys, "lat_idx", "lon_idx") if k in weights.columns]
    joined = null_safe_join(maps, weights, on, "inner")
    w = F.col("weight")
    return joined.groupBy(*keys).agg(*(weighted_mean(F.col(v), w).alias(v.replace("_avg", "") + "_glo") for v in values))


def weighted_mean(x: Column, w: Column) -> Column:
    """Weighted mean over what is present; null without weight (A1)."""
    total = F.sum(F.when(x.isNotNull(), w))
    return F.try_divide(F.sum(x * w), F.when(total != 0, total))


def dataset_weights(fields: list[tuple[DataFrame, list[str], str]], grid: DataFrame) -> DataFrame:
    """Grid weights, null wherever a sample variable is missing at any time of any field.

    ``fields`` has (cells, time keys, variable) of forecast, analysis and climatology; a cell
    is missing at a time if it has no row or no value there. Counting what is present against
    the number of times finds it without a dense table, and without a job while the plan is built.

    Where the first field (the forecast) has levels, weights are by level: its rows are those of a 3-D sample, and with ``lev`` null of a 2-D one.
    A field without a level counts at all levels, and one without any row of a level does not count there.
    """
    level = ["lev"] if "lev" in fields[0][0].columns else []
    cells_of_grid = grid.select("lat_idx", "lon_idx", "grid_weight")
    if level:
        # a row a level
        cells_of_grid = cells_of_grid.crossJoin(F.broadcast(fields[0][0].select("lev").distinct()))
    for k, (cells, times, var) in enumerate(fields):
        own = [c for c in level if c in cells.columns]
        n = cells.select(*times, *own).distinct().groupBy(*own).agg(F.count("*").alias(f"all_{k}"))
        have = cells.where(F.col(var).isNotNull()).groupBy("lat_idx", "lon_idx", *own).agg(F.count("*").alias(f"n_{k}"))
        cells_of_grid = null_safe_join(cells_of_grid, have, ["lat_idx", "lon_idx", *own])
        cells_of_grid = null_safe_join(cells_of_grid, F.broadcast(n), own) if own else cells_of_grid.crossJoin(F.broadcast(n))
    gone = reduce(lambda x, y: x | y, (F.coalesce(F.col(f"n_{k}"), F.lit(0)) < F.coalesce(F.col(f"all_{k}"), F.lit(0)) for k in range(len(fields))))
    return cells_of_grid.select("lat_idx", "lon_idx", *level, F.when(~gone, F.col("grid_weight")).alias("weight"))


def sample_rows(cells: DataFrame, samples: tuple[str, ...]) -> DataFrame:
    """Rows of the sample variables (A15, A16): one with levels and one without, which are told apart by their level."""
    return cells.where(F.col("var").isin(*samples))


def statistic_weights(stats: DataFrame, sample: str, grid: DataFrame) -> DataFrame:
    """Grid weights by lead (and level, null for a 2-D sample), null wherever a sample statistic is missing at any init date."""
    keys = ["lead", *(["lev"] if "lev" in stats.columns else []), "lat_idx", "lon_idx"]
    some = stats.groupBy(*keys).agg(F.bool_or(F.col(sample).isNull()).alias("gone"))
    return some.join(small(grid), ["lat_idx", "lon_idx"]).select(*keys, F.when(~F.col("gone"), F.col("grid_weight")).alias("weight"))


def long_statistics(stats: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Statistics in long form (keys, stat, value)."""
    return stats.unpivot(keys, names, "stat", "value")


def strict_mean(x: Column) -> Column:
    """Mean that is missing if any value is."""
    return F.when(F.count(x) == F.count(F.lit(1)), F.avg(x))


def weighted_file_average(averages: DataFrame, keys: list[str], value: str, n: str) -> DataFrame:
    """Average of per-file averages by their numbers of dates; missing if any is."""
    x, w = F.col(value), F.col(n)
    return averages.groupBy(*keys).agg(F.when(F.count(x) == F.count(F.lit(1)), F.try_divide(F.sum(x * w), F.sum(w))).alias(value))
