"""Statistics for dates that are not there yet, in batches or as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.align import small


def new_dates(available: DataFrame, done: DataFrame, date: str = "init_date") -> DataFrame:
    """Dates without statistics."""
    return available.select(date).distinct().join(done.select(date).distinct(), date, "left_anti")


def reusable(expected: DataFrame, stored: DataFrame, date: str = "init_date") -> bool:
    """Whether a stored result has exactly the expected dates."""
    e, s = expected.select(date).distinct(), stored.select(date).distinct()
    return e.exceptAll(s).isEmpty() and s.exceptAll(e).isEmpty()


def least_excluded(stored: DataFrame, expected: DataFrame, date: str = "init_date") -> DataFrame:
    """(result, n_dates, n_lacking): of stored results (result, date) those that hold expected dates only, the fullest first.

    A result with none lacking serves as it is; one with some lacking serves if that many more exclusions are allowed.
    """
    e = expected.select(date).distinct()
    dates = stored.select("result", date).distinct().join(e.withColumn("__e", F.lit(1)), date, "left")
    got = dates.groupBy("result").agg(F.count("*").alias("n_dates"), F.count("__e").alias("n_expected"))
    got = got.where("n_expected = n_dates").crossJoin(F.broadcast(e.agg(F.count("*").alias("n"))))
    return got.select("result", "n_dates", (F.col("n") - F.col("n_dates")).alias("n_lacking")).orderBy("n_lacking", "result")


def shape_mismatches(stored: DataFrame, n_dates: int, regions: list[str] | None = None, shape: tuple[int, int] | None = None, date: str = "init_date") -> list[str]:
    """What keeps merged statistics from being used again: number of dates, regions, grid (S10); empty if nothing does."""
    found = [F.count_distinct(date).alias("dates")]
    if regions is not None:
        found.append(F.sort_array(F.collect_set("region")).alias("regions"))
    if shape is not None:
        found += [F.count_distinct("lat_idx").alias("lat"), F.count_distinct("lon_idx").alias("lon")]
    r = stored.agg(*found).first()
    out = [] if r["dates"] == n_dates else [f"{r['dates']} dates instead of {n_dates}"]
    if regions is not None and r["regions"] != sorted(regions):
        out.append(f"regions {','.join(r['regions'])}")
    if shape is not None and (r["lat"], r["lon"]) != shape:
        out.append(f"grid {r['lat']}x{r['lon']} instead of {shape[0]}x{shape[1]}")
    return out


def status_report(parts: dict[str, tuple[DataFrame, DataFrame]], date: str = "init_date") -> DataFrame:
    """(dataset, n_needed, n_reused, n_missing) of forecast, analysis and climatology (K7)."""
    rows = None
    for name, (needed, stored) in parts.items():
        n = needed.select(date).distinct().withColumn("__n", F.lit(1))
        s = stored.select(date).distinct().withColumn("__s", F.lit(1))
        one = n.join(s, date, "left").agg(F.count("__n").alias("n_needed"), F.count("__s").alias("n_reused"), (F.count("__n") - F.count("__s")).alias("n_missing"))
        one = one.select(F.lit(name).alias("dataset"), "n_needed", "n_reused", "n_missing")
        rows = one if rows is None else rows.union(one)
    return rows


def append_batch(cells: DataFrame, path: str, compute: Callable[[DataFrame], DataFrame], keys: tuple[str, ...] = ("init_date", "lead")) -> None:
    """Computes and adds the statistics of new dates and leads only.

    Each date and lead has a folder of its own that is replaced whole, so that a job may
    fail and be repeated, and later leads of a date are added.
    """
    spark = cells.sparkSession
    try:
        done = spark.read.parquet(path).select(*keys).distinct()
        fresh = cells.join(small(done), list(keys), "left_anti")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        fresh = cells
    compute(fresh).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def verification_stream(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, compute: Callable[[DataFrame], DataFrame], keys: tuple[str, ...] = ("init_date", "lead")) -> StreamingQuery:
    """Follows a folder of forecast cells and adds statistics by date and lead, with the functions of the batch way.

    A date's leads may arrive in several batches, each whole; they are closed keys, so no watermark is needed.
    """
    stream = spark.readStream.schema(schema).parquet(source)

    def each(batch: DataFrame, _: int) -> None:
        append_batch(batch, out, compute, keys)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
