"""Regridding as joins on one-dimensional overlap tables.

The overlap of two rectangles of latitude and longitude is the product of their
overlaps along either axis. So a regrid is two equality joins with tables of a
few thousand rows at most, and one aggregation by target cell; there is no
two-dimensional range join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = ("lat_idx", "lon_idx")


def _edges(n: int, low: float, high: float, centred: bool) -> list[tuple[float, float]]:
    """Bounds of cells: around grid points that include both ends, or side by side."""
    if centred:
        step = (high - low) / (n - 1)
        return [(max(low, low + (k - 0.5) * step), min(high, low + (k + 0.5) * step)) for k in range(n)]
    step = (high - low) / n
    return [(low + (k - 0.5) * step, low + (k + 0.5) * step) for k in range(n)]


def overlap_tables(spark: SparkSession, source: tuple[int, int], target: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Tables (lat_src, lat_tgt, lat_w) and (lon_src, lon_tgt, lon_w) of two grids (n_lat, n_lon).

    Latitude weighs by the difference of sines, longitude by width and around the
    globe. One pair of grids needs them once, whatever is regridded.
    """
    import math

    lat, lon = [], []
    for t, (t0, t1) in enumerate(_edges(target[0], -90.0, 90.0, True)):
        for s, (s0, s1) in enumerate(_edges(source[0], -90.0, 90.0, True)):
            if (lo := max(s0, t0)) < (hi := min(s1, t1)):
                lat.append((s, t, math.sin(math.radians(hi)) - math.sin(math.radians(lo))))
    for t, (t0, t1) in enumerate(_edges(target[1], -180.0, 180.0, False)):
        for s, (s0, s1) in enumerate(_edges(source[1], -180.0, 180.0, False)):
            for turn in (-360.0, 0.0, 360.0):
                if (width := min(s1 + turn, t1) - max(s0 + turn, t0)) > 1e-12:
                    lon.append((s, t, width))
    return (
        spark.createDataFrame(lat, "lat_src int, lat_tgt int, lat_w double"),
        spark.createDataFrame(lon, "lon_src int, lon_tgt int, lon_w double"),
    )


def conservative(cells: DataFrame, tables: tuple[DataFrame, DataFrame], keys: list[str], variables: list[str]) -> DataFrame:
    """Conservative regrid, normalised by the overlap, of all variables in one aggregation.

    A target with a missing source is missing. ``keys`` are what fields are told
    apart by (time, level and so on); the cells of a source grid must be complete.
    """
    lat, lon = tables
    joined = cells.join(F.broadcast(lat), cells["lat_idx"] == lat["lat_src"]).join(F.broadcast(lon), cells["lon_idx"] == lon["lon_src"])
    w = F.col("lat_w") * F.col("lon_w")
    out = [F.when(F.count(v) == F.count(F.lit(1)), F.sum(F.col(v) * w) / F.sum(w)).alias(v) for v in variables]
    grouped = joined.groupBy(*keys, F.col("lat_tgt").alias("lat_idx"), F.col("lon_tgt").alias("lon_idx"))
    return grouped.agg(*out)


def conservative_per_variable(cells: DataFrame, tables: tuple[DataFrame, DataFrame], keys: list[str], variables: list[str]) -> DataFrame:
    """The same, variable by variable in long form: (keys, var, cell, value)."""
    long = cells.unpivot([*keys, *CELL], variables, "var", "value")
    return conservative(long, tables, [*keys, "var"], ["value"])


def standard_time(cells: DataFrame, climatology: bool, month: str = "month") -> DataFrame:
    """Cells with the standard time coordinate after a regrid: months 1 to 12 of a climatology, else 0."""
    return cells.withColumn("time", F.col(month).cast("int") if climatology else F.lit(0))


def regridded(cells: DataFrame, tables: tuple[DataFrame, DataFrame], keys: list[str], variables: list[str], required: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """Regridded variables, and those that were dropped.

    All variables that are numbers take one aggregation; any other is dropped, or is an error if it
    is among ``required`` (the dependencies of derived variables).
    """
    kinds = dict(cells.dtypes)
    fit = [v for v in variables if kinds.get(v) in ("tinyint", "smallint", "int", "bigint", "float", "double") or kinds.get(v, "").startswith("decimal")]
    gone = [v for v in variables if v not in fit]
    if lost := [v for v in gone if v in required]:
        raise ValueError(f"cannot regrid {', '.join(lost)}")
    return conservative(cells, tables, keys, fit), gone


def nearest_mask(mask: DataFrame, source: tuple[int, int], target: tuple[int, int], value: str) -> DataFrame:
    """Mask (lat_idx, lon_idx, mask) on the target grid from the nearest source point.

    The source spans latitudes -90 to 90 and longitudes 0 to 360; longitudes over
    180 are moved by one turn. Targets outside the source's span, and absent points, are 0.
    """
    spark = mask.sparkSession
    s_lat = [-90 + 180 * k / (source[0] - 1) for k in range(source[0])]
    s_lon = sorted(((lon - 360 if lon > 180 else lon), k) for k, lon in enumerate(360 * k / source[1] for k in range(source[1])))
    lat = [(t, min(range(source[0]), key=lambda s: (abs(s_lat[s] - y), s))) for t, y in enumerate(-90 + 180 * k / (target[0] - 1) for k in range(target[0]))]
    lon = [(t, min(s_lon, key=lambda s: (abs(s[0] - x), s[0]))[1] if s_lon[0][0] <= x <= s_lon[-1][0] else None) for t, x in enumerate(-180 + 360 * k / target[1] for k in range(target[1]))]
    near_lat = spark.createDataFrame(lat, "lat_idx int, lat_src int")
    near_lon = spark.createDataFrame(lon, "lon_idx int, lon_src int")
    # the target grid is small by construction, and so is each axis
    every_lon = F.broadcast(near_lon.agg(F.collect_list(F.struct("lon_idx", "lon_src")).alias("__lon")))
    cells = near_lat.crossJoin(every_lon).select("lat_idx", "lat_src", F.explode("__lon").alias("__l")).select("lat_idx", "lat_src", "__l.*")
    known = mask.select(F.col("lat_idx").alias("lat_src"), F.col("lon_idx").alias("lon_src"), F.col(value).alias("__value"))
    out = cells.join(known, ["lat_src", "lon_src"], "left")
    return out.select("lat_idx", "lon_idx", F.coalesce((F.col("__value") == 1).cast("int"), F.lit(0)).alias("mask"))


def majority_mask(mask: DataFrame, source: tuple[int, int], target: tuple[int, int], value: str) -> DataFrame:
    """Mask on the target grid: 1 where ones outnumber zeros among the source points in a cell.

    Cells are closed boxes and do not reach around the date line; a tie, and no points, give 0.
    """
    spark = mask.sparkSession
    d_lat, d_lon = 180 / (target[0] - 1), 360 / target[1]
    lat, lon = [], []
    for t in range(target[0]):
        lat += [(s, t) for s in range(source[0]) if abs(-90 + 180 * s / (source[0] - 1) - (-90 + t * d_lat)) <= d_lat / 2]
    for t in range(target[1]):
        for s in range(source[1]):
            x = 360 * s / source[1]
            if abs((x - 360 if x > 180 else x) - (-180 + t * d_lon)) <= d_lon / 2:
                lon.append((s, t))
    in_lat, in_lon = spark.createDataFrame(lat, "lat_src int, lat_tgt int"), spark.createDataFrame(lon, "lon_src int, lon_tgt int")
    joined = mask.join(F.broadcast(in_lat), mask["lat_idx"] == in_lat["lat_src"]).join(F.broadcast(in_lon), mask["lon_idx"] == in_lon["lon_src"])
    ones, zeros = F.count_if(F.col(value) == 1), F.count_if(F.col(value) == 0)
    won = joined.groupBy(F.col("lat_tgt").alias("lat_idx"), F.col("lon_tgt").alias("lon_idx")).agg((ones > zeros).cast("int").alias("mask"))
    cells = spark.range(target[0] * target[1]).select(F.floor(F.col("id") / target[1]).cast("int").alias("lat_idx"), F.pmod("id", F.lit(target[1])).cast("int").alias("lon_idx"))
    return cells.join(won, list(CELL), "left").select("lat_idx", "lon_idx", F.coalesce("mask", F.lit(0)).alias("mask"))


def regridded_mask(mask: DataFrame, source: tuple[int, int], target: tuple[int, int], value: str) -> DataFrame:
    """Majority if the target is coarser by more than a tenth on either axis, else nearest; equal grids as they are."""
    if source == target:
        return mask.select("lat_idx", "lon_idx", (F.col(value) == 1).cast("int").alias("mask"))
    coarser = 180 / (target[0] - 1) > 1.1 * 180 / (source[0] - 1) or 360 / target[1] > 1.1 * 360 / source[1]
    return (majority_mask if coarser else nearest_mask)(mask, source, target, value)
