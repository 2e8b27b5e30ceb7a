"""Date bitmaps, dates in paths, bucketed cells, quantiles and printed digits."""

import fnmatch
import math
import random
import struct
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skillgrid.functions import calendar, derive, distributions
from skillgrid.operators import compare, datesets
from skillgrid.plans import queries_dates
from skillgrid.sources import fields, layout

SF = "/root/testdata/sf0.001"


def test_date_bitmaps_equal_sets(spark):
    rnd = random.Random(2)
    sets = {e: {rnd.randrange(-200, 400) for _ in range(300)} for e in "abc"}
    sets["b"] |= {-1, 0, 62, 63}
    rows = [(e, d) for e, days in sets.items() for d in days for _ in range(2)] + [("a", None)]
    df = spark.createDataFrame(rows, "e string, d int")
    words = datesets.date_words(df, "d", ("e",))
    days = lambda w: {r.d for r in datesets.dates_of(w, "d").collect()}
    assert days(words.where("e = 'b'")) == sets["b"]
    assert days(datesets.common(words, "e")) == sets["a"] & sets["b"] & sets["c"]
    assert days(datesets.union(words)) == sets["a"] | sets["b"] | sets["c"]
    one, two = (datesets.date_words(df.where(F.col("e") == e), "d") for e in "ab")
    assert days(datesets.minus(one, two)) == sets["a"] - sets["b"]
    assert days(datesets.not_in_all(words, "e")) == (sets["a"] | sets["b"] | sets["c"]) - (sets["a"] & sets["b"] & sets["c"])
    assert tuple(datesets.counted(one, two).first()) == (len(sets["a"]), len(sets["a"] & sets["b"]), len(sets["a"] - sets["b"]))
    got = {r.e: r.step for r in datesets.steps(words, "e", "step").collect()}
    assert got == {e: min(b - a for a, b in zip(sorted(s), sorted(s)[1:])) for e, s in sets.items()}
    none = datesets.date_words(df.where("false"), "d")
    assert tuple(datesets.counted(none, one).first()) == (0, 0, 0)
    lone = datesets.steps(datesets.date_words(df.where("d = 0").limit(1), "d", ("e",)), "e", "step").first()
    assert lone is None or lone.step is None
    # rows meet in one aggregation with partial results before the shuffle
    plan = words._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2


TEMPLATES = [
    "/d/{init_YYYY}/f_{init_MM}{init_DD}.nc", "/d/f*_{valid_YYYYMMDD}_{init_HH}.nc", "/d/?a+({init_YYYYMMDDHH}).x", "/d/{init_YYYY}*{init_MM,shift=-3h}{init_DD,shift=-3h}.nc",
    "/d/*{init_YYYYMMDD}*.nc", "/*/{init_YYYYMMDD}/*.nc", "/d/plain.nc",
]


def test_paths_are_read_as_they_are_written(spark):
    """Every template against plain pattern matching of every key with every file."""
    rnd, start = random.Random(4), datetime(2023, 12, 30)
    keys = [(start + timedelta(hours=6 * k), start + timedelta(hours=6 * k + 12)) for k in range(24)]
    df = spark.createDataFrame(keys, "init_date timestamp, valid_time timestamp")
    assert [calendar.one_reading(t) for t in TEMPLATES] == [True] * 4 + [False, True, True]
    for template in TEMPLATES:
        filled = [r.p for r in df.orderBy("init_date").select(calendar.template_path(template, F.col("init_date"), F.col("valid_time")).alias("p")).collect()]
        some = lambda: "".join(rnd.choice("0123_ab") for _ in range(rnd.randrange(0, 9)))
        paths = {"".join(some() if c == "*" else rnd.choice("xy0") if c == "?" else c for c in p) for p in filled for _ in range(2)}
        paths |= {p.replace("d", "e") for p in list(paths)[:5]} | {p + "x" for p in list(paths)[:5]}
        files = spark.createDataFrame([(p,) for p in paths], "path string")
        got = {(r.init_date, r.path, r.n_matches) for r in fields.matched_files(df, [template], files).collect()}
        want = set()
        for (init, _), pattern in zip(keys, filled, strict=True):
            hits = [p for p in paths if fnmatch.fnmatchcase(p, pattern.replace("[", "[[]")) and p.count("/") == pattern.count("/")]
            want.add((init, min(hits, default=None), len(hits) or None))
        assert got == want, template


def test_no_pattern_joins_files_and_keys(spark):
    keys = spark.sql("SELECT explode(sequence(timestamp'2024-01-01', timestamp'2024-03-01', interval 1 day)) AS init_date").withColumn("valid_time", F.col("init_date"))
    files = keys.select(F.concat(F.lit("/flat/a"), F.date_format("init_date", "yyyyMMdd"), F.lit(".nc")).alias("path"))
    plan = fields.matched_files(keys, ["?{init_YYYYMMDD}.nc"], files, "/flat/")._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Join" in line and "RLIKE" in line for line in plan.splitlines())


def test_times_out_of_paths(spark):
    template = "/x{init_YYYYMMDD}/{valid_YYYY,shift=1d}{valid_MM,shift=1d}{valid_DD,shift=1d}.nc"
    df = spark.createDataFrame([("/x20240229/20240302.nc",), ("/x20240229/2024030.nc",), ("/x20240231/20240302.nc",)], "path string")
    got = [tuple(r) for r in df.select(calendar.read_time(template, F.col("path"), "init"), calendar.read_time(template, F.col("path"), "valid")).collect()]
    assert got[0] == (datetime(2024, 2, 29), datetime(2024, 3, 1)) and got[1] == (None, None) and got[2][0] is None
    assert df.select(calendar.read_time("/a/{init_HH}.nc", F.col("path"), "init").alias("t")).first().t is None


@pytest.mark.parametrize("level", compare.LEVELS)
def test_quantiles(spark, level):
    """Closed forms for 1, 2 and 4 degrees of freedom; the table and the expansion join; up to 10,000 dates."""
    assert math.isclose(distributions.t_quantile(level, 2), level * math.sqrt(2 / (1 - level**2)), rel_tol=1e-12)
    t = distributions.t_quantile(level, 4)
    x = t / math.sqrt(4 + t * t)
    assert math.isclose(0.5 * x * (3 - x * x), level, rel_tol=1e-12)
    numbers = [2, 3, 31, 200, 201, 202, 365, 3650, 10_000]
    df = spark.createDataFrame([(n,) for n in [1, *numbers]], "n long")
    got = {r.n: r.t for r in compare.with_critical(df, (level,)).collect()}
    assert got[1] is None
    for n in numbers:
        assert abs(got[n] - distributions.t_quantile(level, n - 1)) < 1e-8, n


def in_c(x):
    """The same number as C's printf writes it."""
    size = abs(x)
    if x == 0:
        return "0.0000000"
    if size < 0.01 or size >= 10000:
        return "%.6E" % x
    return f"%.{next((7 - d for d in (1, 2, 3) if size < 10**d), 3)}f" % x


def test_digits_equal_those_of_c(spark):
    rnd = random.Random(8)
    values = [struct.unpack("<d", rnd.randbytes(8))[0] for _ in range(20_000)]
    values += [rnd.choice([1, -1]) * rnd.random() * 10 ** rnd.randrange(-4, 8) for _ in range(20_000)]
    # ties that doubles hold exactly, and such as they do not
    values += [k / 2**s for k in range(1, 3000) for s in (3, 7, 9, 12)] + [round(k * 1e-3 + 5e-7, 7) for k in range(1, 3000)] + [9999.9995, 9999.9994999, 0.01, 0.0099999999, 1e22]
    values = [v for v in values if math.isfinite(v) and not 0 < abs(v) < 2.3e-308]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    wrong = [(values[r.k], r.s, in_c(values[r.k])) for r in df.select("k", derive.seven_digits(F.col("v")).alias("s")).collect() if r.s != in_c(values[r.k])]
    assert not wrong, (len(wrong), wrong[:5])


def test_bucketed_cells_join_without_an_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        names = queries_dates.bucketed_tables(spark, SF, 4)
        f, a, c = (layout.read_bucketed(spark, n) for n in names)
        got = layout.cell_sums(layout.aligned_in_place(f, a, c, queries_dates.CELL_KEYS), queries_dates.CELL_KEYS)
        assert layout.exchanges_under_joins(got) == 0
        assert got.agg(F.sum("n")).first()[0] == f.count()
        other = f.hint("merge").join(a.withColumnRenamed("lat_idx", "y"), F.col("y") == f["lat_idx"])
        assert layout.exchanges_under_joins(other) > 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [layout.bucket_count(n) for n in (0, 1_000_000, 1_000_001, 9_000_000)] == [1, 1, 2, 16]
