"""The store of cells, statistics and averages: late, replaced and repeated batches."""

import pytest
from pyspark.sql import functions as F

from skillgrid.streaming import store as st

CELL = "init_date int, lead int, lat_idx int, lon_idx int, f double"


def make(spark, tmp_path, n=7, values=("me",)):
    compute = lambda cells: cells.groupBy("init_date", "lead").agg(F.lit("GLO").alias("region"), F.avg("f").alias("me"))
    expected = spark.createDataFrame([(d, 0, n) for d in range(10)], "init_date int, lead int, n_expected long")
    return st.VerificationStore(spark, str(tmp_path / "store"), compute, expected, values=values)


def cells(spark, date, lo, hi, shift=0.0):
    return spark.createDataFrame([(date, 0, k, 0, float(k + shift)) for k in range(lo, hi)], CELL)


def test_late_cells_give_the_statistics_of_all(spark, tmp_path):
    store = make(spark, tmp_path)
    assert store.version() == 0 and store.statistics() is None and store.open_keys() is None
    store.add(cells(spark, 1, 0, 3))
    assert [tuple(r) for r in store.open_keys().collect()] == [(1, 0, 7, 3)]
    assert [(r.me,) for r in store.statistics().collect()] == [(1.0,)]
    store.add(cells(spark, 1, 3, 7).union(cells(spark, 2, 0, 7, 10)))
    assert store.open_keys().isEmpty()
    assert sorted((r.init_date, r.me) for r in store.statistics().collect()) == [(1, 3.0), (2, 13.0)]
    assert [(r.n, r.avg) for r in store.averages().collect()] == [(2, 8.0)]
    # one corrected cell of a whole date: the other cells stay
    store.add(spark.createDataFrame([(1, 0, 6, 0, 13.0)], CELL))
    assert sorted((r.init_date, r.me) for r in store.statistics().collect()) == [(1, 4.0), (2, 13.0)]
    assert [(r.n, r.avg) for r in store.averages().collect()] == [(2, 8.5)]


def test_what_is_not_committed_is_not_read(spark, tmp_path):
    store = make(spark, tmp_path)
    store.add(cells(spark, 1, 0, 7), "a")
    before = store.averages().collect()
    broken = make(spark, tmp_path)
    broken.compute = lambda df: store.compute(df).withColumn("me", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        broken.add(cells(spark, 1, 0, 7, 100), "b")
    assert store.version() == 1 and store.averages().collect() == before
    store.add(cells(spark, 1, 0, 7, 100), "b")
    store.add(cells(spark, 1, 0, 7, 200), "b")
    assert store.version() == 2 and [(r.n, r.avg) for r in store.averages().collect()] == [(1, 103.0)]


def test_sums_forget_what_was_replaced(spark, tmp_path):
    """Large and small values: what is left is exactly the average of the rest."""
    store = make(spark, tmp_path)
    store.add(cells(spark, 1, 0, 7, 1e15).union(cells(spark, 2, 0, 7, 0.1)))
    store.add(cells(spark, 1, 0, 7, 0.3))
    (r,) = store.averages().collect()
    assert r.n == 2 and r.avg == pytest.approx(3.2, abs=1e-15)


def test_missing_dates(spark, tmp_path):
    store = make(spark, tmp_path)
    none = spark.createDataFrame([(1, 0, 0, 0, None)], CELL)
    store.add(none.union(cells(spark, 2, 0, 7)))
    assert [(r.n, r.avg) for r in store.averages().collect()] == [(1, 3.0)]
    assert [r.avg for r in store.averages(strict=True).collect()] == [None]
    store.add(cells(spark, 1, 0, 7))
    assert [(r.n, r.avg) for r in store.averages(strict=True).collect()] == [(2, 3.0)]


def test_stream_of_halves(spark, tmp_path):
    store, source = make(spark, tmp_path), str(tmp_path / "in")
    for lo, hi in ((0, 3), (3, 7)):
        cells(spark, 4, lo, hi).write.mode("append").parquet(source)
        store.follow(source, CELL, str(tmp_path / "checkpoint")).awaitTermination()
        assert store.open_keys().isEmpty() == (hi == 7)
    assert [(r.init_date, r.me) for r in store.statistics().collect()] == [(4, 3.0)]
    assert [(r.n, r.avg) for r in store.averages().collect()] == [(1, 3.0)]


def test_states_of_disjoint_dates_merge(spark):
    keys, schema = ["lead"], "init_date int, lead int, rms double"
    one = st.contribution(spark.createDataFrame([(1, 0, 2.0), (2, 0, 4.0)], schema), keys, ["rms"])
    two = st.contribution(spark.createDataFrame([(3, 0, 9.0)], schema), keys, ["rms"])
    assert [(r.n, r.avg) for r in st.averages(st.merged([one, two], keys), keys, True).collect()] == [(3, 5.0)]
    gone = st.contribution(spark.createDataFrame([(3, 0, 9.0)], schema), keys, ["rms"], -1)
    assert st.merged([two, gone], keys).isEmpty()
