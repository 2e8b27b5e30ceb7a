"""The target grid, its weights, and longitudes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def grid(spark: SparkSession, n_lat: int, n_lon: int) -> DataFrame:
    """Cells (lat_idx, lon_idx, lat, lon, grid_weight) of a regular grid (G4, G5); weights are cosines of latitude.

    The grid is arithmetic on one range, so it needs no join and no shuffle.
    """
    d_lat, d_lon = 180.0 / (n_lat - 1), 360.0 / n_lon
    at = spark.range(n_lat * n_lon)
    lat_idx, lon_idx = F.floor(F.col("id") / n_lon).cast("int"), F.pmod("id", F.lit(n_lon)).cast("int")
    lat, lon = F.lit(-90.0) + F.lit(d_lat) * lat_idx, F.lit(-180.0) + F.lit(d_lon) * lon_idx
    return at.select(lat_idx.alias("lat_idx"), lon_idx.alias("lon_idx"), lat.alias("lat"), lon.alias("lon"), F.cos(F.radians(lat)).alias("grid_weight"))


def check_spacing(n_lat: int, n_lon: int, d_lat: float, d_lon: float) -> None:
    """Raises unless the grid covers the globe."""
    if abs((n_lat - 1) * d_lat - 180) > 0.001 or abs(n_lon * d_lon - 360) > 0.001:
        raise ValueError(f"{n_lat} x {n_lon} cells of {d_lat} x {d_lon} degrees do not cover the globe")


def wrapped_longitude(lon: Column) -> Column:
    """Longitudes over 180 moved by one turn."""
    return F.when(lon > 180, lon - 360).otherwise(lon)


def with_cyclic_point(cells: DataFrame, n_lon: int) -> DataFrame:
    """``cells`` with the first longitude repeated at the end, one turn on."""
    seam = cells.where("lon_idx = 0").withColumn("lon_idx", F.lit(n_lon)).withColumn("lon", F.col("lon") + 360)
    return cells.unionByName(seam)


def window_size(lon_spacing: float, degrees: float = 15.0, least: int = 5, most: int = 21) -> int:
    """Odd number of cells whose width is nearest to the wanted degrees; of two the smaller."""
    return min(range(least, most + 1, 2), key=lambda n: (abs(n * lon_spacing - degrees), n))
