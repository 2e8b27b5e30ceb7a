"""Tables of cells laid out for joins: bucketed and sorted by valid time and cell.

Forecast, analysis and climatology (interpolated to valid times) that are bucketed alike join without an exchange: each
task merges the same bucket of all three. What is then summed by time and cell needs none either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys of buckets. Spark joins buckets as they lie only if they are by all keys of the join.
KEYS = ("valid_time", "lat_idx", "lon_idx")


def bucket_count(rows: int, rows_each: int = 1_000_000, least: int = 1) -> int:
    """Buckets for so many rows: a power of two, so that tables of different size are multiples of each other."""
    return max(least, 1 << max(0, (rows - 1) // rows_each).bit_length())


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: tuple[str, ...] = KEYS) -> None:
    """A table of cells in ``path``, bucketed by ``keys`` and sorted by them within buckets (K1).

    Rows are dealt by bucket before they are written, so that a bucket is one file and its order holds.
    """
    df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def aligned_in_place(fcst: DataFrame, ana: DataFrame, clim: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """J1 over tables that are bucketed by time and cell: merge joins that read buckets as they lie."""
    return fcst.join(ana.hint("merge"), list(keys), "left").join(clim.hint("merge"), list(keys), "left")


def exchanges_under_joins(df: DataFrame) -> int:
    """Exchanges of the physical plan: none if the layout serves all joins."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line for line in plan.splitlines())


def cell_sums(cells: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """By time and cell, which needs no exchange either: number of forecasts, sums of errors and of anomalies over leads."""
    return cells.groupBy(*keys).agg(F.count("f").alias("n"), F.sum(F.col("f") - F.col("a")).alias("error"), F.sum(F.col("f") - F.col("c")).alias("anomaly"))
