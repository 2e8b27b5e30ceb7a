"""Required variables, sample files, one forecast at a time, collections without files, order by time."""

import pytest
from pyspark.sql import functions as F

from skillgrid.operators import validate
from skillgrid.sources import fields


def test_required_variables_are_named_together(spark):
    f = spark.createDataFrame([(0, 0, "T", 1.0)], "init_idx int, lead int, var string, f double")
    a = spark.createDataFrame([(0, 1.0)], "t_idx int, PS double")
    assert set(validate.loaded({"F": f, "A": a}, required={"F": ["T"], "A": ["PS"]})) == {"F", "A"}
    with pytest.raises(ValueError, match="2 required variables missing: A, Q; F, U"):
        validate.loaded({"F": f, "A": a}, required={"F": ["T", "U"], "A": ["PS", "Q"]})
    many = spark.range(30).select(F.col("id").alias("t"))
    with pytest.raises(ValueError, match="30 times missing: 0; 1; 2$"):
        validate.raise_if_any(many, "times", 3)


def test_one_sample_file_of_each_collection(spark, tmp_path):
    for name, columns in (("a1", "500 AS lev, 1.0 AS T"), ("a2", "850 AS lev, 1.0 AS T, 1.0 AS Q"), ("b1", "1.0 AS Q")):
        spark.sql(f"SELECT {columns}").write.parquet(str(tmp_path / name))
    files = spark.createDataFrame([("a", str(tmp_path / "a1")), ("a", str(tmp_path / "a2")), ("b", str(tmp_path / "b1"))], "collection string, path string")
    got = validate.sample_file_problems(files, ["T", "Q"], [500])
    assert [g.split(" in ")[0] for g in got] == ["a: no variable Q", "b: no variable T", "b: no level 500"]
    assert validate.sample_file_problems(files.where("collection = 'a'"), ["T"], [500]) == []


def test_collections_without_files(spark):
    wanted = spark.createDataFrame([("x",)], "collection string")
    listed = spark.createDataFrame([("y", 0, "/d/f")], "collection string, turn int, path string")
    with pytest.raises(Exception, match="no files of the collection x, and none of a default"):
        fields.collection_files(wanted, listed).collect()
    assert [tuple(r) for r in fields.collection_files(wanted, listed, "null").collect()] == [("x", None)]
    default = listed.union(spark.createDataFrame([("default", 0, "/d/g")], listed.schema))
    assert [r.path for r in fields.collection_files(wanted, default).collect()] == ["/d/g"]


def test_one_forecast_is_cut_and_kept(spark):
    f = spark.createDataFrame([(k, k + 1) for k in range(4)], "init_idx int, t int")
    a = spark.createDataFrame([(k,) for k in range(9)], "t int")
    held = validate.single_forecast({"F": f, "A": a}, 2, times={"A": ["t"]})
    assert [tuple(r) for r in held["F"].collect()] == [(2, 3)] and [tuple(r) for r in held["A"].collect()] == [(3,)]
    assert held["F"].storageLevel.useMemory
    for df in held.values():
        df.unpersist()


def test_order_by_time(spark):
    df = spark.createDataFrame([(3, "b"), (1, "z"), (3, "a"), (2, "y")], "t int, k string")
    assert [tuple(r) for r in validate.in_time_order(df, "t", ("k",)).collect()] == [(1, "z"), (2, "y"), (3, "a"), (3, "b")]
