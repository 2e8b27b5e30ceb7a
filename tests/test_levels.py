"""Levels, null among them, in joins, weights and global means; regions that stay; times that lack."""

import pytest
from pyspark.sql import functions as F

from skillgrid.functions.grid import grid
from skillgrid.operators import align, regions, statistics

KEYS = "t int, lev int, lat_idx int, lon_idx int"


def test_two_dimensional_rows_keep_their_analysis(spark):
    f = spark.createDataFrame([(1, None, 0, 0, 1.0), (1, 500, 0, 0, 2.0)], KEYS + ", f double")
    a = spark.createDataFrame([(1, None, 0, 0, 3.0), (1, 500, 0, 0, 4.0)], KEYS + ", a double")
    c = spark.createDataFrame([(1, None, 0, 0, 5.0), (1, 500, 0, 0, 6.0)], KEYS + ", c double")
    got = {(r.lev, r.f, r.a, r.c) for r in align.aligned(f, a, c, ("t",)).collect()}
    assert got == {(None, 1.0, 3.0, 5.0), (500, 2.0, 4.0, 6.0)}
    # a climatology has a level, the analysis has none: each is joined by what it shares with the forecast
    flat = a.where("lev = 500").drop("lev")
    assert {(r.lev, r.a, r.c) for r in align.aligned(f, flat, c, ("t",)).collect()} == {(None, 4.0, 5.0), (500, 4.0, 6.0)}


def test_absent_times_are_an_error(spark):
    f = spark.createDataFrame([(1, 500, 0, 0, 2.0), (2, 500, 0, 0, 2.0)], KEYS + ", f double")
    a = spark.createDataFrame([(1, 500, 0, 1, 4.0)], KEYS + ", a double")
    c = a.withColumnRenamed("a", "c")
    with pytest.raises(Exception, match="the analysis has no time t=2"):
        align.aligned(f, a, c, ("t",)).collect()
    assert {(r.t, r.a) for r in align.aligned(f, a, c, ("t",), absent="null").collect()} == {(1, None), (2, None)}
    # a time that is there with other cells is no error
    assert align.aligned(f.where("t = 1"), a, c, ("t",)).count() == 1
    with pytest.raises(ValueError, match="error or null"):
        align.aligned(f, a, c, ("t",), absent="x")


def test_a_cell_missing_at_one_level_loses_its_weight_there(spark):
    g = grid(spark, 3, 4)
    rows = [(t, v, r.lat_idx, r.lon_idx, None if (t, v, r.lat_idx, r.lon_idx) == (1, 500, 1, 1) else 1.0) for t in (1, 2) for v in (500, 850, None) for r in g.collect()]
    f = spark.createDataFrame(rows, KEYS + ", f double")
    a = f.where("lev IS NULL").where("NOT (t = 2 AND lat_idx = 1 AND lon_idx = 2)")
    got = statistics.dataset_weights([(f, ["t"], "f"), (a, ["t"], "f")], g).where("weight IS NULL").select("lev", "lat_idx", "lon_idx").collect()
    assert sorted(map(tuple, got), key=str) == [(500, 1, 1), (None, 1, 2)]
    assert statistics.dataset_weights([(f, ["t"], "f")], g).count() == 36


def test_statistic_weights_and_means_by_level(spark):
    g = grid(spark, 3, 4)
    stats = g.select(F.lit(0).alias("lead"), F.explode(F.array(F.lit(500), F.lit(None).cast("int"))).alias("lev"), "lat_idx", "lon_idx", F.lit(2.0).alias("rms"))
    hole = (F.col("lev") == 500) & (F.col("lat_idx") == 1) & (F.col("lon_idx") == 0)
    stats = stats.withColumn("rms", F.when(hole, None).otherwise(F.col("rms")))
    weights = statistics.statistic_weights(stats, "rms", g)
    assert [tuple(r) for r in weights.where("weight IS NULL").select("lev", "lat_idx", "lon_idx").collect()] == [(500, 1, 0)]
    means = statistics.global_mean(stats.withColumnRenamed("rms", "rms_avg"), weights, ["lead", "lev"], ["rms_avg"]).collect()
    assert {(r.lev, r.rms_glo) for r in means} == {(500, 2.0), (None, 2.0)}


def test_components_of_intersections_stay(spark):
    g = grid(spark, 13, 24)
    land = g.select("lat_idx", "lon_idx", F.when(F.col("lon_idx") % 2 == 0, 1).otherwise(0).alias("mask"))
    found = {r.region for r in regions.cells_of_regions(g, {"LND": land}, ("NHL",)).select("region").distinct().collect()}
    assert found == {"NHL", "NHE", "LND"}
