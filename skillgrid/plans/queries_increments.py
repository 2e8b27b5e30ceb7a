"""Registered queries: statistics and averages that follow new, late and replaced dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import align, regions, statistics
from ..sources.storage import shared_folder
from ..streaming import store as st
from . import fixtures as fx
from .queries import RKEYS, REGIONAL, query, r6, two_pass, wm

KEYS = ("init_idx", "lead")
#: What is in a store in the end: date 1 replaced by the second forecast, all others from the first.
FINAL = "final AS (SELECT * FROM fcst WHERE init_idx <> 1 UNION ALL SELECT * FROM fcst2 WHERE init_idx = 1)"
FINAL_SQL = ("fcst2", *(p.replace("FROM fcst f", "FROM final f") for p in REGIONAL))


def _with_final(*more: str) -> str:
    return fx.with_sql("fcst", "fcst2", FINAL, *(p for p in FINAL_SQL if p not in ("fcst", "fcst2")), *more)


def _regional(spark: SparkSession, sf: str):
    """Regional statistics of forecast cells of any dates."""
    box = regions.box_cells(fx.grid(spark))

    def compute(cells: DataFrame) -> DataFrame:
        return statistics.regional(align.by_region(fx.trio_of(spark, sf, cells), box), RKEYS)

    return compute


def _expected(spark: SparkSession, sf: str) -> DataFrame:
    return fx.view(spark, sf, "fcst").groupBy(*KEYS).agg(F.count("*").alias("n_expected"))


def _fed(store: st.VerificationStore, spark: SparkSession, sf: str) -> st.VerificationStore:
    """Four batches: two dates; half of the cells of a third; its late cells with two more dates; date 1 replaced."""
    one, two = fx.view(spark, sf, "fcst"), fx.view(spark, sf, "fcst2")
    store.add(one.where("init_idx < 2"), "first")
    store.add(one.where("init_idx = 2 AND lat_idx < 6"), "half")
    store.add(one.where("init_idx = 2 AND lat_idx >= 6 OR init_idx > 2"), "late")
    store.add(one.where("init_idx = 2 AND lat_idx >= 6 OR init_idx > 2"), "late")  # handed over again
    store.add(two.where("init_idx = 1"), "replaced")
    return store


def regional_store(spark: SparkSession, sf: str) -> st.VerificationStore:
    return _fed(st.VerificationStore(spark, shared_folder(spark, "store"), _regional(spark, sf), _expected(spark, sf), KEYS), spark, sf)


LONG_AVG = "SELECT lead, region, 'rms' AS stat, count(sqrt(mse)) AS n, round(avg(sqrt(mse)), 6) + 0.0 AS avg FROM z GROUP BY 1, 2 UNION ALL SELECT lead, region, 'acorr', count(acorr), round(avg(acorr), 6) + 0.0 FROM z GROUP BY 1, 2"


@query("renewed_averages", _with_final(two_pass("init_idx, lead, region", "rc")) + LONG_AVG)
def renewed_averages(spark: SparkSession, sf: str) -> DataFrame:
    """Averages over dates from sums that batches add to and subtract from (T1, A13); the SQL computes all from scratch."""
    got = regional_store(spark, sf).averages()
    return got.select("lead", "region", "stat", "n", r6("avg").alias("avg"))


@query("renewed_statistics", _with_final(two_pass("init_idx, lead, region", "rc")) + "SELECT init_idx, lead, region, round(sqrt(mse), 6) + 0.0 AS rms, round(acorr, 6) + 0.0 AS acorr FROM z")
def renewed_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of dates whose cells come in several batches, or anew."""
    return regional_store(spark, sf).statistics().select(*RKEYS, r6("rms").alias("rms"), r6("acorr").alias("acorr"))


@query("cell_ledger", fx.with_sql("fcst") + "SELECT init_idx, lead, count(*) AS n_expected, count(*) FILTER (init_idx <> 2 OR lat_idx < 6) AS n_stored, count(*) = count(*) FILTER (init_idx <> 2 OR lat_idx < 6) AS whole FROM fcst WHERE init_idx <= 2 GROUP BY 1, 2")
def cell_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """How many cells each date and lead has and should have; date 2 is open."""
    store = st.VerificationStore(spark, shared_folder(spark, "store"), _regional(spark, sf), _expected(spark, sf), KEYS)
    one = fx.view(spark, sf, "fcst")
    store.add(one.where("init_idx < 2"))
    store.add(one.where("init_idx = 2 AND lat_idx < 6"))
    return store.ledger().select(*KEYS, "n_expected", "n_stored", "whole")


CELL_STATS = "cs AS (SELECT init_idx, lead, lat_idx, lon_idx, w, f - a AS me, (f - a)*(f - a) AS mse FROM cells)"
CELL_AVG = "ca AS (SELECT lead, lat_idx, lon_idx, any_value(w) AS w, avg(me) AS me, avg(mse) AS mse FROM cs GROUP BY 1, 2, 3)"


@query("renewed_global_means", _with_final(CELL_STATS, CELL_AVG) + f"SELECT lead, 'me' AS stat, round({wm('me')}, 6) + 0.0 AS glo FROM ca GROUP BY 1 UNION ALL SELECT lead, 'mse', round({wm('mse')}, 6) + 0.0 FROM ca GROUP BY 1")
def renewed_global_means(spark: SparkSession, sf: str) -> DataFrame:
    """Global means of averaged maps of errors, renewed with the averages."""

    def compute(cells: DataFrame) -> DataFrame:
        error = F.col("f") - F.col("a")
        return fx.trio_of(spark, sf, cells).select(*KEYS, "lat_idx", "lon_idx", error.alias("me"), (error * error).alias("mse"))

    maps = st.VerificationStore(spark, shared_folder(spark, "store"), compute, _expected(spark, sf), KEYS, group=("lat_idx", "lon_idx"), values=("me", "mse"))
    weights = fx.grid(spark).select("lat_idx", "lon_idx", F.col("grid_weight").alias("weight"))
    got = st.global_means(_fed(maps, spark, sf).state(), weights, ["lead"])
    return got.select("lead", "stat", r6("glo").alias("glo"))


FILES_SQL = "zz AS (SELECT *, sqrt(mse) AS rms FROM z), fa AS (SELECT lead, region, init_idx < 2 AS file, count(*) AS n, CASE WHEN count(rms) = count(*) THEN avg(rms) END AS rms, CASE WHEN count(acorr) = count(*) THEN avg(acorr) END AS acorr FROM zz GROUP BY 1, 2, 3)"


@query("merged_file_averages", fx.with_sql(*REGIONAL, two_pass("init_idx, lead, region", "rc"), FILES_SQL) + "SELECT lead, region, stat, n, round(v, 6) + 0.0 AS avg FROM (SELECT lead, region, CAST(sum(n) AS BIGINT) AS n, CASE WHEN count(rms) = count(*) THEN sum(rms*n)/sum(n) END AS rms, CASE WHEN count(acorr) = count(*) THEN sum(acorr*n)/sum(n) END AS acorr FROM fa GROUP BY 1, 2) UNPIVOT INCLUDE NULLS (v FOR stat IN (rms, acorr)) WHERE v IS NOT NULL")
def merged_file_averages(spark: SparkSession, sf: str) -> DataFrame:
    """Averages of two stores with different dates as one, weighted by their dates; missing if any date's value is."""
    one, stores = fx.view(spark, sf, "fcst"), []
    for part in ("init_idx < 2", "init_idx >= 2"):
        store = st.VerificationStore(spark, shared_folder(spark, "store"), _regional(spark, sf), _expected(spark, sf), KEYS)
        store.add(one.where(part))
        stores.append(store.state())
    keys = ["lead", "region"]
    got = st.averages(st.merged(stores, keys), keys, strict=True)
    return got.where("avg IS NOT NULL").select(*keys, "stat", "n", r6("avg").alias("avg"))
