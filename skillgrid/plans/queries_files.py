"""Registered queries: cells and statistics through files and back, what is stored against what is wanted, metadata of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import fields
from ..sources.storage import shared_folder
from ..streaming import incremental
from . import fixtures as fx
from .queries import query, r6

CELL_KEYS = ["init_idx", "lead", "lat_idx", "lon_idx"]


@query("stored_cells", fx.with_sql("fcst") + "SELECT init_idx, lead, lat_idx, lon_idx, round(CAST(CAST(f AS FLOAT) AS DOUBLE), 6) + 0.0 AS \"T\" FROM fcst")
def stored_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells written in single precision, a folder a date, and read again with the wanted columns."""
    path = shared_folder(spark, "cells")
    fields.write_cells(fx.view(spark, sf, "fcst").withColumnRenamed("f", "T"), path, ["T"], "init_idx")
    got = fields.read_cells(spark, [path], CELL_KEYS, ["T"])
    return got.select(*CELL_KEYS, r6("T").alias("T"))


@query("stored_experiment", fx.with_sql("exp_stats") + "SELECT init_day AS init_date, lead, 'control' AS experiment, round(max(rms), 6) + 0.0 AS rms, count(DISTINCT init_day >= 15) AS n_files FROM exp_stats WHERE experiment = 0 GROUP BY 1, 2")
def stored_experiment(spark: SparkSession, sf: str) -> DataFrame:
    """An experiment's statistics in two files, named with a comma between; averages in them are left out."""
    own = fx.view(spark, sf, "exp_stats").where("experiment = 0").groupBy(F.col("init_day").alias("init_date"), "lead").agg(F.max("rms").alias("rms"))
    own, paths = own.withColumn("rms_avg", F.lit(0.0)), []
    for part in ("init_date < 15", "init_date >= 15"):
        paths.append(shared_folder(spark, "statistics"))
        own.where(part).coalesce(1).write.parquet(paths[-1])
    got = fields.read_experiment(spark, ", ".join(paths), "control")
    return got.groupBy("init_date", "lead", "experiment").agg(r6(F.max("rms")).alias("rms"), F.count_distinct("file").alias("n_files"))


@query("shape_mismatches", fx.with_sql("fcst") + "SELECT count(DISTINCT init_idx) || ' dates instead of 9' AS problem FROM fcst UNION ALL SELECT 'grid ' || count(DISTINCT lat_idx) || 'x' || count(DISTINCT lon_idx) || ' instead of 91x144' FROM fcst")
def shape_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """What keeps merged statistics from being used again: number of dates, grid."""
    found = incremental.shape_mismatches(fx.view(spark, sf, "fcst"), 9, shape=(91, 144), date="init_idx")
    return spark.createDataFrame([(f,) for f in found], "problem string")


@query("run_metadata", fx.with_sql("exp_stats") + "SELECT string_agg(d, ',' ORDER BY d) AS excluded_dates, CAST(count(*) AS INT) AS n_excluded, 'fcst' AS model FROM (SELECT DISTINCT lpad(CAST(init_day AS VARCHAR), 2, '0') AS d FROM exp_stats WHERE rms > 250)")
def run_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """One row about a run with the dates that it excludes (K6); they are days, so they are few."""
    days = fx.view(spark, sf, "exp_stats").where("rms > 250").select(F.lpad(F.col("init_day").cast("string"), 2, "0").alias("d")).distinct().orderBy("d").collect()
    return fields.run_metadata(spark, [r["d"] for r in days], model="fcst")
