"""Properties and edge cases of the operators, on small inputs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skillgrid.functions import calendar, catalog, derive
from skillgrid.functions.grid import check_spacing, grid, window_size
from skillgrid.operators import align, compare, regions, regrid, statistics, validate
from skillgrid.sources import fields
from skillgrid.streaming import incremental

CELL = "k int, lat_idx int, lon_idx int, f double, a double, c double, grid_weight double"


def cells(spark, holes=0.0, seed=1, n_lat=5, n_lon=8):
    rnd = random.Random(seed)
    some = lambda: None if rnd.random() < holes else rnd.gauss(10, 3)
    rows = [(0, y, x, some(), some(), some(), math.cos(math.radians(-80 + 40 * y))) for y in range(n_lat) for x in range(n_lon)]
    return spark.createDataFrame(rows, CELL)


def test_parts_of_the_error_add_up(spark):
    r = statistics.regional(cells(spark), ["k"], ("mse", "rms_bar", "rms_ran", "rms_amp", "rms_phz", "rms", "res1", "res2")).first()
    assert math.isclose(r["rms_bar"] ** 2 + r["rms_ran"] ** 2, r["mse"], rel_tol=1e-9)
    assert math.isclose(r["rms_bar"] ** 2 + r["rms_amp"] ** 2 + r["rms_phz"] ** 2, r["mse"], rel_tol=1e-9)
    assert math.isclose(r["rms"] ** 2, r["mse"], rel_tol=1e-9)


def test_perfect_forecast(spark):
    df = cells(spark).withColumn("f", F.col("a"))
    r = statistics.regional(df, ["k"], ("rms", "acorr")).first()
    assert r["rms"] == 0 and math.isclose(r["acorr"], 1, rel_tol=1e-9)


def test_correlation_ignores_constants(spark):
    df = cells(spark, 0.2)
    one = statistics.regional(df, ["k"]).first()["acorr"]
    two = statistics.regional(df.withColumn("f", F.col("f") + 7), ["k"]).first()["acorr"]
    assert math.isclose(one, two, rel_tol=1e-9)


def test_nothing_present_is_missing(spark):
    df = cells(spark).withColumn("a", F.lit(None).cast("double"))
    r = statistics.regional(df, ["k"]).first()
    assert r["rms"] is None and r["acorr"] is None


def test_window_equals_brute_force(spark):
    df = cells(spark, 0.3, 3)
    rows = df.collect()
    for r in statistics.pointwise(df, ["k"], 5, ("rms",)).collect():
        near = [n for n in rows if abs(n["lat_idx"] - r["lat_idx"]) <= 2 and abs(n["lon_idx"] - r["lon_idx"]) <= 2]
        enough = min(sum(n[v] is not None for n in near) for v in "fac") >= 12
        both = [n for n in near if n["f"] is not None and n["a"] is not None]
        want = math.sqrt(sum((n["f"] - n["a"]) ** 2 * n["grid_weight"] for n in both) / sum(n["grid_weight"] for n in both)) if enough and both else None
        assert (r["rms"] is None) == (want is None) and (want is None or math.isclose(r["rms"], want, rel_tol=1e-9))


def test_window_around_the_globe(spark):
    flat = cells(spark, 0, 4)
    turned = flat.withColumn("lon_idx", (F.col("lon_idx") + 3) % 8)
    key = lambda df: sorted((r["lat_idx"], r["lon_idx"], round(r["rms"], 9)) for r in df.where("rms is not null").collect())
    one = statistics.pointwise(flat, ["k"], 5, ("rms",), wrap_lon=8).withColumn("lon_idx", (F.col("lon_idx") + 3) % 8)
    two = statistics.pointwise(turned, ["k"], 5, ("rms",), wrap_lon=8)
    assert key(one) == key(two) and len(key(one)) > 20


def test_regrid_keeps_constants_and_area(spark):
    src = grid(spark, 13, 24).select(F.lit(0).alias("k"), "lat_idx", "lon_idx", F.lit(3.5).alias("v"))
    lat, lon = regrid.overlap_tables(spark, (13, 24), (7, 12))
    got = regrid.conservative(src, (lat, lon), ["k"], ["v"]).collect()
    assert len(got) == 84 and all(math.isclose(r["v"], 3.5) for r in got)
    assert math.isclose(lat.agg(F.sum("lat_w")).first()[0], 2) and math.isclose(lon.agg(F.sum("lon_w")).first()[0], 360)


def test_regrid_batch_and_single_agree_and_missing_spreads(spark):
    src = grid(spark, 13, 24).select(F.lit(0).alias("k"), "lat_idx", "lon_idx", F.col("lat").alias("u"), F.when(F.col("lon_idx") > 0, F.col("lon")).alias("v"))
    tables = regrid.overlap_tables(spark, (13, 24), (7, 12))
    wide = {(r["lat_idx"], r["lon_idx"]): (r["u"], r["v"]) for r in regrid.conservative(src, tables, ["k"], ["u", "v"]).collect()}
    for r in regrid.conservative_per_variable(src, tables, ["k"], ["u", "v"]).collect():
        want = wide[r["lat_idx"], r["lon_idx"]][0 if r["var"] == "u" else 1]
        assert want == r["value"] or math.isclose(want, r["value"])
    assert wide[3, 0][1] is None


def test_month_weights(spark):
    times = ["2024-02-15 12:00:00", "2023-02-15 00:00:00", "2024-01-01 00:00:00", "2024-12-31 18:00:00", "2024-04-16 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("t"))
    got = {str(r["t"]): r for r in df.withColumns(calendar.month_weights(F.col("t"))).collect()}
    for r in got.values():
        assert math.isclose(r["w1"] + r["w2"], 1)
    mid = got["2024-02-15 12:00:00"]  # 14.5 days in, the middle of 29
    assert (mid["m1"], mid["m2"], mid["w1"]) == (2, 2, 0.5)
    assert (got["2024-01-01 00:00:00"]["m1"], got["2024-12-31 18:00:00"]["m2"]) == (12, 1)


def test_templates(spark):
    assert calendar.split_templates("a_{init_YYYY,shift=-3h}.nc, b.nc") == ["a_{init_YYYY,shift=-3h}.nc", "b.nc"]
    t = F.lit("2024-01-01 00:00:00").cast("timestamp")
    path = spark.range(1).select(calendar.template_path("{init_YYYYMMDD,shift=-1d}/{valid_HH}.nc", t, calendar.valid_time(t, F.lit(30)))).first()[0]
    assert path == "20231231/06.nc"
    with pytest.raises(ValueError):
        calendar.template_path("{init_YYYYMMDDHH,shift=-3h}", t, t)
    with pytest.raises(ValueError):
        calendar.uses_valid_time(["{valid_HH}", "{init_HH}"])


def test_matched_files(spark, tmp_path):
    for name in ("x_2024010100.parquet", "y_2024010100.parquet", "y_2024010200.parquet"):
        (tmp_path / name).write_bytes(b"x")
    keys = spark.sql("SELECT explode(sequence(timestamp'2024-01-01', timestamp'2024-01-03', interval 1 day)) AS init_date").withColumn("valid_time", F.col("init_date"))
    files = fields.listed_files(spark, str(tmp_path))
    for templates in (["x_{init_YYYYMMDDHH}.parquet", "y_{init_YYYYMMDDHH}.parquet"], ["x_{init_YYYYMMDDHH}.par*", "y_{init_YYYYMMDDHH}.parquet"]):
        got = [r["path"] and r["path"][-20:-8] for r in fields.matched_files(keys, templates, files, f"{tmp_path}/").orderBy("init_date").collect()]
        assert got == ["x_2024010100", "y_2024010200", None]


def test_derived_variables(spark):
    df = spark.createDataFrame([(0.004, 100000.0, 5.0)], "Q2m double, PS double, h double")
    r = derive.with_derived(df, ["D2m", "Z"]).first()
    assert 270 < r["D2m"] < 280 and math.isclose(r["Z"], 5 * 9.80665)
    with pytest.raises(ValueError):
        derive.with_derived(df, ["PM25"])


def test_seven_digits(spark):
    values = [None, 0.0, 1.0, -12.3456789, 123.456789, 9999.5, 10000.0, 0.0099, -180.0]
    got = [r[0] for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").orderBy("k").select(derive.seven_digits(F.col("v"))).collect()]
    assert got == ["9.9999999E+14", "0.0000000", "1.000000", "-12.34568", "123.4568", "9999.500", "1.000000E+04", "9.900000E-03", "-180.0000"]


def test_t_critical():
    assert math.isclose(compare.t_critical(0.95, 31), 2.042272, abs_tol=1e-6)
    assert math.isclose(compare.t_critical(0.95, 2), 12.7062047, abs_tol=1e-5)
    assert compare.t_critical(0.95, 1) is None


def test_single_date_has_no_interval(spark):
    df = spark.createDataFrame([(0, 1, 0, 0.5), (1, 1, 0, 0.6)], "experiment int, init_day int, lead int, acorr double")
    r = compare.paired_interval(compare.paired(df, 0, ["lead"], "acorr"), ["lead"], (0.95,), True).first()
    assert r["lower"] is None and r["upper"] is None


def test_names_levels_and_grid(spark):
    assert validate.find_column(["TEMP", "t"], "T", ["temp"]) == "t" and validate.find_column(["TEMP"], "T", ["temp"]) == "TEMP"
    with pytest.raises(ValueError, match="Q"):
        validate.select_variables(spark.range(1), ["id"], {"Q": []})
    assert window_size(2.5) == 5 and window_size(1.0) == 15
    check_spacing(13, 24, 15, 15)
    with pytest.raises(ValueError):
        check_spacing(13, 24, 10, 15)
    with pytest.raises(ValueError):
        regions.cells_of_regions(grid(spark, 13, 24), {}, ("GLO", "XXX"))
    assert catalog.unit_of("T", "mse") == "(K)^2" and catalog.unit_of("T", "acorr") == "unitless"


def test_box_over_the_date_line(spark):
    df = spark.createDataFrame([(0.0, 170.0), (0.0, -170.0), (0.0, 0.0)], "lat double, lon double")
    box = [F.lit(x) for x in (10.0, -10.0, -160.0, 160.0)]
    assert [r[0] for r in df.select(regions.in_box(F.col("lat"), F.col("lon"), *box)).collect()] == [True, True, False]


def test_merge_prefers_the_first(spark):
    one = spark.createDataFrame([(1, 1.0), (2, None)], "k int, v double")
    two = spark.createDataFrame([(2, 5.0, 7.0), (3, 6.0, 8.0)], "k int, v double, w double")
    # a variable is one file's, whole: the second's values never fill gaps of the first's
    assert sorted(map(tuple, align.merged([one, two], ["k"]).collect())) == [(1, 1.0, None), (2, None, 7.0), (3, None, 8.0)]
    got = align.combined(two, one, ["k"])
    assert got.columns == ["k", "v", "w"] and sorted(map(tuple, got.collect())) == [(1, 1.0, None), (2, None, 7.0), (3, None, 8.0)]


def test_write_and_increment(spark, tmp_path):
    df = cells(spark, 0.1).withColumns({"init_date": F.lit("2024-05-01"), "lead": F.lit(0)})
    out = str(tmp_path / "stats")
    compute = lambda c: statistics.regional(c, ["init_date", "lead"])
    incremental.append_batch(df, out, compute)
    incremental.append_batch(df.union(df.withColumn("init_date", F.lit("2024-05-02"))), out, compute)
    assert spark.read.parquet(out).count() == 2
    incremental.append_batch(df.withColumn("lead", F.lit(12)), out, compute)  # a later lead of a known date
    assert sorted((str(r["init_date"]), r["lead"]) for r in spark.read.parquet(out).collect()) == [("2024-05-01", 0), ("2024-05-01", 12), ("2024-05-02", 0)]
    fields.write_cells(df, str(tmp_path / "cells"), ["f"], "init_date")
    back = spark.read.parquet(str(tmp_path / "cells"))
    assert back.count() == 40 and dict(back.dtypes)["f"] == "float"
    assert incremental.reusable(df, df, "init_date")


def test_stream_equals_batch(spark, tmp_path):
    df = cells(spark, 0.1, 7).withColumns({"init_date": F.lit("2024-05-01"), "lead": F.lit(0)})
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df.coalesce(1).write.parquet(source)
    compute = lambda c: statistics.regional(c, ["init_date", "lead"])
    follow = lambda: incremental.verification_stream(spark, source, df.schema.simpleString()[7:-1].replace(":", " "), out, str(tmp_path / "ck"), compute).awaitTermination()
    follow()
    got, want = spark.read.parquet(out).first(), compute(df).first()
    assert math.isclose(got["rms"], want["rms"], rel_tol=1e-12)
    df.withColumn("lead", F.lit(12)).coalesce(1).write.mode("append").parquet(source)  # files that come later
    follow()
    assert sorted(r["lead"] for r in spark.read.parquet(out).collect()) == [0, 12]


def test_scorecard_files(spark, tmp_path):
    lines = spark.sql("SELECT timestamp'2024-05-01' AS init_date, '0.0|x|' AS line")
    fields.write_scorecards(lines, str(tmp_path / "sc"))
    text = spark.read.text(str(tmp_path / "sc")).orderBy("value").collect()
    assert {r["value"] for r in text} == {"0.0|x|", catalog.SCORECARD_HEADER}


def test_names_of_outputs(spark):
    name = fields.output_name("fcst", "default", "m", "20240501", "20240531", 7, 12, 1, 2, 91, 144)
    assert name == "fcst_default_m_20240501-20240531_len7d_int12h_spc1d_excl2_91x144"
    r = spark.createDataFrame([("reg_M_A_C_len7d_int12h_excl2",)], "n string").select(*(c.alias(k) for k, c in fields.name_metadata(F.col("n")).items())).first()
    assert (r["fcst"], r["length_days"], r["interval"], r["spacing"], r["excluded"]) == ("M", 7, 12, 1, 2)


def test_a_missing_value_makes_intervals_missing(spark):
    rows = [(e, d, 0, None if (e, d) == (1, 3) else 0.5 + 0.01 * d * (e + 1)) for e in (0, 1, 2) for d in range(7)]
    df = spark.createDataFrame(rows, "experiment int, init_day int, lead int, rms double")
    got = {r["experiment"]: r for r in compare.paired_interval(compare.paired(df, 0, ["lead"], "rms"), ["lead"], (0.95,), False).collect()}
    assert got[1]["lower"] is None and got[1]["n"] == 7 and got[2]["lower"] is not None
    sig = {r["experiment"]: r for r in compare.significance(compare.paired(df, 0, ["lead"], "rms"), ["lead"], 0.9).collect()}
    assert sig[1]["t_stat"] is None and sig[2]["t_stat"] is not None
    assert compare.synoptic_interval(df, 0, ["lead"], "rms", (0.95,), False).first()["lower"] is None


def test_units_do_not_matter(spark):
    df = cells(spark, 0.1)
    tiny = df.withColumns({v: F.col(v) * 1e-9 for v in "fac"})
    one, two = (statistics.regional(d, ["k"], ("acorr", "rms_dsp")).first() for d in (df, tiny))
    assert math.isclose(one["acorr"], two["acorr"], rel_tol=1e-9) and math.isclose(one["rms_dsp"] * 1e-18, two["rms_dsp"], rel_tol=1e-6)
    flat = statistics.regional(df.withColumns({"f": F.lit(0.1), "a": F.lit(0.1)}), ["k"], ("rms_dsp",)).first()
    assert flat["rms_dsp"] is None
    pairs = spark.createDataFrame([(1, d, 0.5 + 1e-6 * d, 0.5) for d in range(5)] + [(2, d, 0.3 + 0.1, 0.1) for d in range(5)], "experiment int, init_day int, x_model double, x_ctl double")
    got = {r["experiment"]: r["t_stat"] for r in compare.significance(pairs, [], 0.9).collect()}
    assert got[1] is not None and got[2] is None


def test_loading_names_what_is_missing(spark):
    f = spark.createDataFrame([(k, lead, lev, 1.0) for k in range(3) for lead in (0, 12) for lev in (1000, 850)], "init_idx int, lead int, lev int, f double")
    a = spark.createDataFrame([(0, 1.0), (1, 1.0)], "init_idx int, a double")
    assert validate.loaded({"F": f, "A": a}, [850], [0], (0, 1), {"A": ["init_idx"]})["F"].count() == 2
    for args, what in ((([700],), "levels"), ((None, [6]), "leads"), ((None, None, None, {"A": ["init_idx"]}), "times of A")):
        with pytest.raises(ValueError, match=what):
            validate.loaded({"F": f, "A": a}, *args)


def test_chunks(spark):
    one, two = (spark.createDataFrame([(d, 0, float(d), 10 * d) for d in ds], "init_idx int, lead int, v double, s int") for ds in ((0, 1), (2, 3)))
    got = validate.chunks_merged([two, one], ["init_idx", "lead"], "init_idx", ("s",)).collect()
    assert [(r["init_idx"], r["s"]) for r in got] == [(0, 0), (1, 0), (2, 0), (3, 0)]
    for bad, what in (([], "no chunks"), ([one, one], "several"), ([one, two.where("false")], "no rows")):
        with pytest.raises(ValueError, match=what):
            validate.chunks_merged(bad, ["init_idx", "lead"], "init_idx")


def test_experiment_files(spark, tmp_path):
    for k in (1, 2):
        spark.createDataFrame([(k, 0.5, 0.6)], "init_date int, T_rms double, T_rms_avg double").write.parquet(str(tmp_path / f"f{k}"))
    assert fields.file_list("a, b,,a") == ["a", "b"]
    for given in (f"{tmp_path}/f1,{tmp_path}/f2", [f"{tmp_path}/f1", f"{tmp_path}/f2"], f"{tmp_path}/f*"):
        got = fields.read_experiment(spark, given, "e")
        assert got.count() == 2 and "T_rms_avg" not in got.columns
    spark.createDataFrame([(2, 0.5)], "init_date int, T_rms double").write.parquet(str(tmp_path / "f3"))
    with pytest.raises(ValueError, match="several files"):
        fields.read_experiment(spark, f"{tmp_path}/f*", "e")


def test_written_statistics_and_metadata(spark, tmp_path):
    stats = spark.createDataFrame([(1, "T", "rms", 0.5), (1, "T", "acorr", 0.9)], "init_date int, var string, stat string, value double")
    fields.write_statistics(stats, str(tmp_path / "s"))
    got = {r["stat"]: r["units"] for r in spark.read.parquet(str(tmp_path / "s")).collect()}
    assert got == {"rms": "K", "acorr": "unitless"}
    r = fields.run_metadata(spark, ["20240503"], note="x").first()
    assert (r["excluded_dates"], r["n_excluded"], r["note"]) == ("20240503", 1, "x")
    back = fields.read_cells(spark, [str(tmp_path / "s")], ["stat"], ["value"])
    assert back.count() == 2 and back.columns == ["stat", "value"]


def test_reuse_of_results(spark):
    stats = spark.createDataFrame([(d, r) for d in (1, 2) for r in ("GLO", "NHE")], "init_date int, region string")
    assert incremental.shape_mismatches(stats, 2, ["NHE", "GLO"]) == []
    assert len(incremental.shape_mismatches(stats, 3, ["GLO"])) == 2
    assert incremental.shape_mismatches(cells(spark), 1, shape=(5, 9), date="k") == ["grid 5x8 instead of 5x9"]


def test_regridding_drops_what_is_no_number(spark):
    df = cells(spark, n_lat=13, n_lon=24).withColumn("note", F.lit("x"))
    tables = regrid.overlap_tables(spark, (13, 24), (7, 12))
    got, gone = regrid.regridded(df, tables, ["k"], ["f", "note", "none"])
    assert got.count() == 84 and gone == ["note", "none"]
    with pytest.raises(ValueError, match="note"):
        regrid.regridded(df, tables, ["k"], ["f", "note"], ("note",))


def test_dependencies_in_other_collections(spark):
    one, two = spark.createDataFrame([(1, 0.004)], "k int, Q2m double"), spark.createDataFrame([(1, 1e5)], "k int, ps double")
    assert derive.across_collections([one, two], ["k"], ["D2m"]).first()["D2m"] > 270
    with pytest.raises(ValueError, match="PS"):
        derive.across_collections([one], ["k"], ["D2m"])


def test_work_that_is_not_there(spark):
    df = spark.createDataFrame([(0, "GLO")], "experiment int, region string")
    assert validate.wanted_work(df, experiment=[0]).count() == 1
    with pytest.raises(ValueError, match="region"):
        validate.wanted_work(df, region=["NHE"])
