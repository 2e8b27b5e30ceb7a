"""Registered queries: regridding, calendars, sources and checks, comparison, scorecards, increments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, derive
from ..functions.catalog import BOX_REGIONS, MASK_REGIONS, MODEL_LEVELS, SCORECARD_STATS
from ..functions.grid import with_cyclic_point
from ..operators import align, compare, regions, regrid, scorecard, statistics, validate
from ..streaming import incremental
from . import fixtures as fx
from .queries import r6, query, rounded

# --- masks and regridding ----------------------------------------------------------------------

NEAREST_SQL = "SELECT g.lat_idx, g.lon_idx, CAST(coalesce(max(m.land), 0) AS INT) AS mask FROM grid g LEFT JOIN mask_src m ON g.lon_idx > 0 AND m.lat_idx = 2*g.lat_idx AND m.lon_idx = CASE WHEN g.lon_idx >= 12 THEN 2*(g.lon_idx - 12) ELSE 2*g.lon_idx + 24 END GROUP BY 1, 2"


@query("mask_nearest", fx.with_sql("mask_src", fx.GRID_SQL) + NEAREST_SQL)
def mask_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """A mask from the nearest source points."""
    return regrid.nearest_mask(fx.view(spark, sf, "mask_src"), (25, 48), (13, 24), "land")


@query("mask_majority", fx.with_sql("mask_src", fx.GRID_SQL, "pts AS (SELECT -90 + 7.5*lat_idx AS y, CASE WHEN 7.5*lon_idx > 180 THEN 7.5*lon_idx - 360 ELSE 7.5*lon_idx END AS x, land FROM mask_src)") + "SELECT g.lat_idx, g.lon_idx, CAST(CASE WHEN count(*) FILTER (land = 1) > count(*) FILTER (land = 0) THEN 1 ELSE 0 END AS INT) AS mask FROM grid g LEFT JOIN pts ON abs(y - lat) <= 7.5 AND abs(x - lon) <= 7.5 GROUP BY 1, 2")
def mask_majority(spark: SparkSession, sf: str) -> DataFrame:
    """A mask by majority; the dispatch takes it, as the target is coarser."""
    return regrid.regridded_mask(fx.view(spark, sf, "mask_src"), (25, 48), (13, 24), "land")


TARGET = (7, 12)
OVERLAP_SQL = (
    "lat_ov AS (SELECT s, t, sin(radians(least(s1, t1))) - sin(radians(greatest(s0, t0))) AS w FROM (SELECT CAST(s AS INT) AS s, greatest(-90, -90 + (s-0.5)*15.0) AS s0, least(90, -90 + (s+0.5)*15.0) AS s1 FROM range(13) a(s)), (SELECT CAST(t AS INT) AS t, greatest(-90, -90 + (t-0.5)*30.0) AS t0, least(90, -90 + (t+0.5)*30.0) AS t1 FROM range(7) b(t)) WHERE least(s1, t1) > greatest(s0, t0))",
    "lon_ov AS (SELECT s, t, least(s1, t1) - greatest(s0, t0) AS w FROM (SELECT CAST(s AS INT) AS s, -180 + (s-0.5)*15.0 + k AS s0, -180 + (s+0.5)*15.0 + k AS s1 FROM range(24) a(s), (VALUES (-360.0), (0.0), (360.0)) z(k)), (SELECT CAST(t AS INT) AS t, -180 + (t-0.5)*30.0 AS t0, -180 + (t+0.5)*30.0 AS t1 FROM range(12) b(t)) WHERE least(s1, t1) - greatest(s0, t0) > 1e-12)",
)


@query("regrid_conservative", fx.with_sql("clim_raw", fx.GRID_SQL, *OVERLAP_SQL, "dense AS (SELECT k.cycle, k.month, g.lat_idx, g.lon_idx, c.c FROM (SELECT DISTINCT cycle, month FROM clim_raw) k CROSS JOIN grid g LEFT JOIN clim_raw c ON c.cycle = k.cycle AND c.month = k.month AND c.lat_idx = g.lat_idx AND c.lon_idx = g.lon_idx)") + "SELECT cycle, month, a.t AS lat_idx, b.t AS lon_idx, round(CASE WHEN count(c) = count(*) THEN sum(c*a.w*b.w)/sum(a.w*b.w) END, 6) + 0.0 AS c FROM dense JOIN lat_ov a ON a.s = lat_idx JOIN lon_ov b ON b.s = lon_idx GROUP BY 1, 2, 3, 4")
def regrid_conservative(spark: SparkSession, sf: str) -> DataFrame:
    """Climatology on a coarser grid; a missing source makes its targets missing."""
    cells = statistics.dense(fx.view(spark, sf, "clim_raw"), ["cycle", "month"], fx.grid(spark).select("lat_idx", "lon_idx"), ["c"])
    got = regrid.conservative(cells, regrid.overlap_tables(spark, (13, 24), TARGET), ["cycle", "month"], ["c"])
    return rounded(got, ["cycle", "month", "lat_idx", "lon_idx"], ["c"])


REGRID_PAIR = (
    "fcst", "ana", "clim_raw", fx.GRID_SQL, fx.cells_sql(), *OVERLAP_SQL,
    "dense AS (SELECT k.init_idx, k.lead, g.lat_idx, g.lon_idx, x.f, x.a FROM (SELECT DISTINCT init_idx, lead FROM cells) k CROSS JOIN grid g LEFT JOIN cells x ON x.init_idx = k.init_idx AND x.lead = k.lead AND x.lat_idx = g.lat_idx AND x.lon_idx = g.lon_idx)",
    "long AS (SELECT init_idx, lead, lat_idx, lon_idx, 'f' AS var, f AS v FROM dense UNION ALL SELECT init_idx, lead, lat_idx, lon_idx, 'a', a FROM dense)",
)


@query("regrid_batch_equals_pervar", fx.with_sql(*REGRID_PAIR) + "SELECT init_idx, lead, x.t AS lat_idx, y.t AS lon_idx, var, round(CASE WHEN count(v) = count(*) THEN sum(v*x.w*y.w)/sum(x.w*y.w) END, 6) + 0.0 AS value, TRUE AS same FROM long JOIN lat_ov x ON x.s = lat_idx JOIN lon_ov y ON y.s = lon_idx GROUP BY 1, 2, 3, 4, 5")
def regrid_batch_equals_pervar(spark: SparkSession, sf: str) -> DataFrame:
    """Regridded values of all variables in one aggregation, and whether each alone gives the same."""
    cells = statistics.dense(fx.trio(spark, sf).drop("grid_weight"), ["init_idx", "lead"], fx.grid(spark).select("lat_idx", "lon_idx"), ["f", "a"])
    tables, keys = regrid.overlap_tables(spark, (13, 24), TARGET), ["init_idx", "lead"]
    batch = regrid.conservative(cells, tables, keys, ["f", "a"]).unpivot([*keys, "lat_idx", "lon_idx"], ["f", "a"], "var", "value")
    each = regrid.conservative_per_variable(cells, tables, keys, ["f", "a"]).withColumnRenamed("value", "other")
    both = batch.join(each, [*keys, "lat_idx", "lon_idx", "var"], "full")
    return both.select(*keys, "lat_idx", "lon_idx", "var", r6("value").alias("value"), r6("value").eqNullSafe(r6("other")).alias("same"))


@query("cyclic_point", fx.with_sql("fcst", fx.GRID_SQL, "x AS (SELECT f.init_idx, f.lead, f.lat_idx, f.lon_idx, g.lon, f.f FROM fcst f JOIN grid g USING (lat_idx, lon_idx))") + "SELECT init_idx, lead, lat_idx, lon_idx, CAST(lon AS DOUBLE) AS lon, f FROM x UNION ALL SELECT init_idx, lead, lat_idx, CAST(24 AS INT), CAST(lon + 360 AS DOUBLE), f FROM x WHERE lon_idx = 0")
def cyclic_point(spark: SparkSession, sf: str) -> DataFrame:
    """Maps with the first longitude repeated at the end."""
    g = F.broadcast(fx.grid(spark).select("lat_idx", "lon_idx", "lon"))
    cells = fx.view(spark, sf, "fcst").join(g, ["lat_idx", "lon_idx"]).select("init_idx", "lead", "lat_idx", "lon_idx", "lon", "f")
    return with_cyclic_point(cells, 24)


# --- calendar and climatology ------------------------------------------------------------------

WEIGHTS_SQL = """w AS (SELECT DISTINCT o_orderdate + INTERVAL 6 HOUR AS t FROM orders),
p AS (SELECT t, day(last_day(t)) / 2.0 AS centre, day(t) - 1 + hour(t)/24.0 AS pos, month(t) AS m, day(last_day(t)) AS days,
  day(last_day(t - INTERVAL 1 MONTH)) / 2.0 AS last, day(last_day(CAST(date_trunc('month', t) AS TIMESTAMP) + INTERVAL 1 MONTH)) / 2.0 AS nxt, day(last_day(CAST(date_trunc('month', t) AS TIMESTAMP) - INTERVAL 1 MONTH)) / 2.0 AS lst FROM w),
mw AS (SELECT t, CAST(CASE WHEN pos < centre THEN (m + 10) % 12 + 1 ELSE m END AS INT) AS m1, CASE WHEN pos < centre THEN (centre - pos)/(centre + lst) WHEN pos > centre THEN (nxt + days - pos)/(nxt + days - centre) ELSE 0.5 END AS w1,
  CAST(CASE WHEN pos > centre THEN m % 12 + 1 ELSE m END AS INT) AS m2, CASE WHEN pos < centre THEN (pos + lst)/(centre + lst) WHEN pos > centre THEN (pos - centre)/(nxt + days - centre) ELSE 0.5 END AS w2 FROM p)"""


def _order_times(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=F.lit(6))
    return fx.table(spark, sf, "orders").select(t.alias("valid_time")).distinct()


@query("clim_month_weights", "WITH " + WEIGHTS_SQL + " SELECT strftime(t, '%Y%m%d%H') AS valid_time, m1, round(w1, 6) + 0.0 AS w1, m2, round(w2, 6) + 0.0 AS w2 FROM mw")
def clim_month_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Months and weights of every order date at six."""
    got = _order_times(spark, sf).withColumns(calendar.month_weights(F.col("valid_time")))
    return got.select(calendar.date_labels(F.col("valid_time"))["hour"].alias("valid_time"), "m1", r6("w1").alias("w1"), "m2", r6("w2").alias("w2"))


@query("clim_interpolated", fx.with_sql("clim_raw", WEIGHTS_SQL, "tt AS (SELECT t, CAST(12*(day(t) % 2) AS INT) AS cycle, m1, w1, m2, w2 FROM mw)") + "SELECT strftime(t, '%Y%m%d%H') AS valid_time, lat_idx, lon_idx, round(CASE WHEN count(c) = 2 THEN sum(w*c) END, 9) + 0.0 AS c FROM (SELECT t, cycle, m1 AS month, w1 AS w FROM tt UNION ALL SELECT t, cycle, m2, w2 FROM tt) JOIN clim_raw USING (cycle, month) GROUP BY t, lat_idx, lon_idx")
def clim_interpolated(spark: SparkSession, sf: str) -> DataFrame:
    """Climatology at valid times from monthly means of their cycle."""
    t = F.col("valid_time")
    times = _order_times(spark, sf).withColumn("cycle", (12 * (F.day(t) % 2)).cast("int")).withColumns(calendar.month_weights(t))
    got = align.interpolated_climatology(times, fx.view(spark, sf, "clim_raw"))
    return got.select(F.date_format(t, "yyyyMMddHH").alias("valid_time"), "lat_idx", "lon_idx", r6("c", 9).alias("c"))


@query("valid_times", "SELECT DISTINCT strftime(d + INTERVAL (l) HOUR, '%Y%m%d%H') AS valid_time FROM (SELECT DISTINCT date_trunc('day', o_orderdate) AS d FROM orders), (SELECT unnest([0, 12, 24]) AS l)")
def valid_times(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct valid times of all init dates and leads."""
    dates = fx.table(spark, sf, "orders").select(F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("init_date")).distinct()
    got = calendar.valid_times(dates, calendar.leads(spark, 1, 12))
    return got.select(F.date_format("valid_time", "yyyyMMddHH").alias("valid_time"))


@query("date_sequence", "SELECT strftime(d, '%Y%m%d') AS init_date, count(o_orderkey) AS n_orders FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '1995-03-31', INTERVAL 3 DAY)) AS d) LEFT JOIN orders ON date_trunc('day', o_orderdate) = d WHERE strftime(d, '%Y%m%d') <> '19950104' GROUP BY d")
def date_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """Init dates by spacing without an excluded one, with the orders of each (G1, P10)."""
    out = spark.sql("SELECT TIMESTAMP '1995-01-04 00:00:00' AS init_date")
    dates = calendar.init_dates(spark, "1995-01-01", "1995-03-31", 3, out)
    orders = fx.table(spark, sf, "orders").select("o_orderkey", F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("init_date"))
    got = dates.join(orders, "init_date", "left").groupBy("init_date").agg(F.count("o_orderkey").alias("n_orders"))
    return got.select(F.date_format("init_date", "yyyyMMdd").alias("init_date"), "n_orders")


@query("template_paths", "SELECT DISTINCT 'run_' || strftime(o_orderdate, '%Y%m%d') || '/f' || strftime(o_orderdate - INTERVAL 3 HOUR, '%m%d') || '_' || strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d%H') || '.nc' AS path FROM orders")
def template_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Paths from a template with shifted dates."""
    t = F.col("o_orderdate").cast("timestamp")
    template = calendar.split_templates("run_{init_YYYYMMDD}/f{init_MM,shift=-3h}{init_DD,shift=-3h}_{valid_YYYYMMDDHH}.nc")[0]
    path = calendar.template_path(template, t, calendar.valid_time(t, F.lit(24)))
    return fx.table(spark, sf, "orders").select(path.alias("path")).distinct()


@query("lead_from_first_time", fx.with_sql("multilead") + "SELECT init_idx, CAST(date_diff('hour', min(valid_time) OVER (PARTITION BY init_idx), valid_time) AS INT) AS lead, v FROM multilead")
def lead_from_first_time(spark: SparkSession, sf: str) -> DataFrame:
    """Leads from the first time of each run."""
    return align.lead_from_first_time(fx.view(spark, sf, "multilead")).select("init_idx", "lead", "v")


# --- checks and matching -----------------------------------------------------------------------

NEEDED_SQL = "needed AS (SELECT DISTINCT f.init_idx, f.lead, CAST(c AS INT) AS coll FROM fcst f, range(2) r(c)), found AS (SELECT DISTINCT CAST(l_orderkey % 5 AS INT) AS init_idx, CAST(12*(l_linenumber % 3) AS INT) AS lead, CAST(l_partkey % 2 AS INT) AS coll FROM lineitem WHERE l_quantity > 49 AND l_returnflag = 'R' AND l_discount > 0.09)"


def _needed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    needed = fx.view(spark, sf, "fcst").select("init_idx", "lead").distinct().select("init_idx", "lead", F.explode(F.array(F.lit(0), F.lit(1))).alias("coll"))
    some = fx.table(spark, sf, "lineitem").where("l_quantity > 49 AND l_returnflag = 'R' AND l_discount > 0.09")
    found = some.select((F.col("l_orderkey") % 5).cast("int").alias("init_idx"), (12 * (F.col("l_linenumber") % 3)).cast("int").alias("lead"), (F.col("l_partkey") % 2).cast("int").alias("coll")).distinct()
    return needed, found


@query("availability_missing", fx.with_sql("fcst", NEEDED_SQL) + "SELECT n.* FROM needed n LEFT JOIN found f USING (init_idx, lead, coll) WHERE f.lead IS NULL ORDER BY init_idx, lead, coll LIMIT 10")
def availability_missing(spark: SparkSession, sf: str) -> DataFrame:
    """The first ten files that are needed and absent."""
    needed, found = _needed(spark, sf)
    return validate.first_missing(needed, found, ["init_idx", "lead", "coll"])


@query("availability_counts", fx.with_sql("fcst", NEEDED_SQL) + "SELECT (SELECT count(*) FROM needed) AS n_expected, count(*) AS n_found, (SELECT count(*) FROM needed) - count(*) AS n_missing FROM needed JOIN found USING (init_idx, lead, coll)")
def availability_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Expected and found files."""
    needed, found = _needed(spark, sf)
    return validate.completeness(needed, found, ["init_idx", "lead", "coll"])


@query("required_elements_missing", fx.with_sql("fcst3", "req(kind, name) AS (VALUES ('lev','1000'),('lev','850'),('lev','700'),('lev','500'),('lead','0'),('lead','12'),('lead','36'),('init','4'),('init','7'))", "have AS (SELECT 'lev' AS kind, CAST(lev AS VARCHAR) AS name FROM fcst3 UNION SELECT 'lead', CAST(lead AS VARCHAR) FROM fcst3 UNION SELECT 'init', CAST(init_idx AS VARCHAR) FROM fcst3)") + "SELECT kind, name FROM req WHERE (kind, name) NOT IN (SELECT (kind, name) FROM have)")
def required_elements_missing(spark: SparkSession, sf: str) -> DataFrame:
    """All required levels, leads and dates that a field lacks, at once."""
    required = spark.createDataFrame([("lev", "1000"), ("lev", "850"), ("lev", "700"), ("lev", "500"), ("lead", "0"), ("lead", "12"), ("lead", "36"), ("init", "4"), ("init", "7")], "kind string, name string")
    # one pass over the field for all kinds
    cells = fx.view(spark, sf, "fcst3")
    have = cells.select(F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("name")) for k, c in (("lev", "lev"), ("lead", "lead"), ("init", "init_idx"))))).alias("x")).select("x.*")
    return validate.missing_elements(required, have)


@query("alias_resolution", "WITH have AS (SELECT DISTINCT p_brand AS name FROM part), want(var) AS (VALUES ('BRAND#11'), ('T'), ('Q'), ('Z')), al(var, name, priority) AS (VALUES ('T','temp',0),('T','Brand#12',1),('T','Brand#13',2),('Q','shum',0),('Z','BRAND#21',0),('Z','Brand#22',1)), hit AS (SELECT a.var, h.name, a.priority FROM (SELECT var, var AS name, -1 AS priority FROM want UNION ALL SELECT * FROM al) a JOIN have h ON lower(h.name) = lower(a.name)) SELECT w.var, arg_min(h.name, h.priority) AS found FROM want w LEFT JOIN hit h USING (var) GROUP BY w.var")
def alias_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Which name supplies each variable: its own in any case, then aliases in order."""
    have = fx.table(spark, sf, "part").select(F.col("p_brand").alias("name")).distinct()
    wanted = spark.createDataFrame([("BRAND#11",), ("T",), ("Q",), ("Z",)], "var string")
    aliases = spark.createDataFrame([("T", "temp", 0), ("T", "Brand#12", 1), ("T", "Brand#13", 2), ("Q", "shum", 0), ("Z", "BRAND#21", 0), ("Z", "Brand#22", 1)], "var string, name string, priority int")
    return validate.resolved_names(wanted, aliases, have)


REQUESTED = (1000, 980, 925, 850, 700, 500, 300, 250, 200, 100, 10)


@query("nearest_levels", fx.with_sql("fcst3", "lv(pos, model_level, pressure) AS (VALUES " + ", ".join(f"({k},{m},{p})" for k, (m, p) in enumerate(MODEL_LEVELS)) + ")", "rq(turn, requested) AS (VALUES " + ", ".join(f"({k},{p})" for k, p in enumerate(REQUESTED)) + ")", "best AS (SELECT turn, requested, model_level, pressure, abs(pressure - requested) AS off FROM rq, lv QUALIFY row_number() OVER (PARTITION BY turn ORDER BY abs(pressure - requested), pos) = 1)", "kept AS (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY model_level ORDER BY turn) = 1)") + "SELECT CAST(requested AS INT) AS requested, CAST(model_level AS INT) AS model_level, CAST(pressure AS INT) AS pressure, CAST(off AS INT) AS off, count(f.f) AS n_values FROM kept LEFT JOIN fcst3 f ON f.lev = requested GROUP BY ALL")
def nearest_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Model levels for requested pressures, with the values a field has there (P5)."""
    levels = validate.nearest_levels(spark, list(REQUESTED))
    n = fx.view(spark, sf, "fcst3").groupBy(F.col("lev").alias("requested")).agg(F.count("f").alias("n_values"))
    return levels.join(n, "requested", "left").select("requested", "model_level", "pressure", "off", F.coalesce("n_values", F.lit(0)).alias("n_values"))


# --- variables and collections -----------------------------------------------------------------

RAW = "SELECT l_orderkey, l_linenumber, l_discount/10 AS q2m, 90000 + l_quantity*100 AS ps, l_tax AS aod, l_extendedprice/10 AS h FROM lineitem"


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (c("l_discount") / 10).alias("q2m"), (90000 + c("l_quantity") * 100).alias("ps"), c("l_tax").alias("aod"), (c("l_extendedprice") / 10).alias("h"))


@query("derived_variables", f"WITH r AS ({RAW}), e AS (SELECT *, CASE WHEN q2m > 0 THEN ln(ps/100*q2m/(0.622 + 0.378*q2m)/6.112) END AS lg FROM r) SELECT l_orderkey, l_linenumber, round(243.5*lg/nullif(17.67 - lg, 0) + 273.15, 6) + 0.0 AS d2m, round(ln(aod + 0.01), 6) + 0.0 AS logaod, round(9.80665*h, 9) + 0.0 AS z FROM e")
def derived_variables(spark: SparkSession, sf: str) -> DataFrame:
    """Dew point, logarithm of optical depth, geopotential."""
    got = derive.with_derived(_raw(spark, sf).withColumn("q2m", F.when(F.col("q2m") > 0, F.col("q2m"))), ["D2m", "LOGAOD", "Z"])
    return got.select("l_orderkey", "l_linenumber", r6("D2m").alias("d2m"), r6("LOGAOD").alias("logaod"), r6("Z", 9).alias("z"))


@query("scaled_variables", f"WITH r AS ({RAW}) SELECT l_orderkey, l_linenumber, 'Q2m' AS var, round(q2m*1000, 6) + 0.0 AS value FROM r UNION ALL SELECT l_orderkey, l_linenumber, 'PS', round(ps*0.01, 6) + 0.0 FROM r UNION ALL SELECT l_orderkey, l_linenumber, 'AOD', round(aod, 6) + 0.0 FROM r")
def scaled_variables(spark: SparkSession, sf: str) -> DataFrame:
    """Values in display units by variable, in long form with normal names."""
    long = align.long_form(_raw(spark, sf).select("l_orderkey", "l_linenumber", F.col("q2m").alias("q2M"), F.col("ps").alias("ps"), F.col("aod").alias("Aod")), ["l_orderkey", "l_linenumber"], ["q2M", "ps", "Aod"])
    named = long.withColumn("var", derive.normal_name(F.col("var")))
    return named.select("l_orderkey", "l_linenumber", "var", r6(derive.scaled(F.col("value"), F.col("var"))).alias("value"))


@query("collection_merge", fx.with_sql("fcst", "fcst2", "ana", "one AS (SELECT * FROM fcst WHERE lead <= 12)", "two AS (SELECT init_idx, lead, lat_idx, lon_idx, f, f + 1 AS g FROM fcst2 WHERE lead >= 12)") + "SELECT init_idx, lead, lat_idx, lon_idx, round(o.f, 6) + 0.0 AS f, round(g, 6) + 0.0 AS g FROM one o FULL JOIN two t USING (init_idx, lead, lat_idx, lon_idx)")
def collection_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two collections in one frame; a variable that both have is the first's, whole."""
    keys = ["init_idx", "lead", "lat_idx", "lon_idx"]
    one = validate.select_leads(fx.view(spark, sf, "fcst"), [0, 12])
    two = fx.view(spark, sf, "fcst2").where("lead >= 12").withColumn("g", F.col("f") + 1)
    return rounded(align.merged([one, two], keys), keys, ["f", "g"])


# --- comparison --------------------------------------------------------------------------------


def _experiments(spark: SparkSession, sf: str) -> DataFrame:
    return fx.view(spark, sf, "exp_stats")


COMMON_SQL = "common AS (SELECT init_day FROM (SELECT DISTINCT experiment, init_day FROM exp_stats) GROUP BY 1 HAVING count(*) = 3)"


@query("experiment_common_dates", fx.with_sql("exp_stats", COMMON_SQL) + "SELECT init_day FROM common WHERE init_day NOT IN (5, 17)")
def experiment_common_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates that all experiments have, without excluded ones."""
    return compare.common_dates(_experiments(spark, sf), spark.createDataFrame([(5,), (17,)], "init_day int"))


@query("experiment_date_mismatches", fx.with_sql("exp_stats", "e AS (SELECT CAST(d AS INT) AS init_day FROM range(1, 32) r(d))", "f AS (SELECT DISTINCT init_day FROM exp_stats)") + "SELECT init_day, 'missing' AS problem FROM e WHERE init_day NOT IN (SELECT init_day FROM f) UNION ALL SELECT init_day, 'unexpected' FROM f WHERE init_day NOT IN (SELECT init_day FROM e)")
def experiment_date_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """Dates that are missing or unexpected."""
    expected = spark.range(1, 32).select(F.col("id").cast("int").alias("init_day"))
    return compare.date_mismatches(expected, _experiments(spark, sf))


@query("experiment_overlap", "WITH e AS (SELECT DISTINCT CAST(user_id % 3 AS INT) AS experiment, CAST(EXTRACT(day FROM ts) AS INT) AS init_day, CAST(event_id % 2 AS INT) AS file FROM events) SELECT experiment, init_day, count(*) AS n_files FROM e GROUP BY 1, 2 HAVING count(*) > 1")
def experiment_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Dates that several files of an experiment hold."""
    c = F.col
    files = fx.table(spark, sf, "events").select((c("user_id") % 3).cast("int").alias("experiment"), F.day("ts").alias("init_day"), (c("event_id") % 2).cast("int").alias("file"))
    return compare.overlaps(files)


@query("experiment_timing_check", fx.with_sql("exp_stats") + "SELECT experiment, CAST(floor(max(lead)/24) AS INT) AS length_days, CAST(list_sort(list(DISTINCT lead))[2] - list_sort(list(DISTINCT lead))[1] AS INT) AS interval FROM exp_stats GROUP BY 1 HAVING floor(max(lead)/24) < 2 OR coalesce(list_sort(list(DISTINCT lead))[2] - list_sort(list(DISTINCT lead))[1], 99) > 12")
def experiment_timing_check(spark: SparkSession, sf: str) -> DataFrame:
    """Experiments that are too short or too coarse for a comparison."""
    return compare.incompatible(compare.timing(_experiments(spark, sf)), 2, 12)


@query("experiment_avg", fx.with_sql("exp_stats", COMMON_SQL) + "SELECT experiment, lead, round(CASE WHEN count(acorr) = count(*) THEN avg(acorr) END, 6) + 0.0 AS acorr, round(CASE WHEN count(rms) = count(*) THEN avg(rms) END, 6) + 0.0 AS rms FROM exp_stats JOIN common USING (init_day) GROUP BY 1, 2")
def experiment_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Averages over common dates; missing if any value is."""
    e = _experiments(spark, sf)
    got = e.join(compare.common_dates(e), "init_day").groupBy("experiment", "lead").agg(*(statistics.strict_mean(F.col(v)).alias(v) for v in ("acorr", "rms")))
    return rounded(got, ["experiment", "lead"], ["acorr", "rms"])


@query("weighted_file_avg", fx.with_sql("exp_stats", "f AS (SELECT experiment, lead, init_day % 4 AS file, avg(rms) AS rms, count(*) AS n FROM exp_stats GROUP BY ALL)") + "SELECT experiment, lead, round(sum(rms*n)/sum(n), 6) + 0.0 AS rms FROM f GROUP BY 1, 2")
def weighted_file_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Average of per-file averages by numbers of dates."""
    files = _experiments(spark, sf).groupBy("experiment", "lead", (F.col("init_day") % 4).alias("file")).agg(F.avg("rms").alias("rms"), F.count("*").alias("n"))
    return rounded(statistics.weighted_file_average(files, ["experiment", "lead"], "rms", "n"), ["experiment", "lead"], ["rms"])


PAIR_SQL = "pr AS (SELECT m.experiment, m.lead, m.init_day, c.rms AS rc, m.rms AS rm, c.acorr AS ac, m.acorr AS am FROM exp_stats m JOIN exp_stats c ON c.experiment = 0 AND m.experiment <> 0 AND c.init_day = m.init_day AND c.lead = m.lead)"


@query("diff_from_control", fx.with_sql("exp_stats", PAIR_SQL) + "SELECT experiment, lead, init_day, round(rm - rc, 6) + 0.0 AS diff FROM pr")
def diff_from_control(spark: SparkSession, sf: str) -> DataFrame:
    """Differences from the control by date."""
    got = compare.paired(_experiments(spark, sf), 0, ["lead"], "rms")
    return got.select("experiment", "lead", "init_day", r6(F.col("x_model") - F.col("x_ctl")).alias("diff"))


def _t_sql(levels: tuple[float, ...]) -> str:
    """Critical values for up to 31 dates as literals: rational numbers that both sides share."""
    rows = [f"({lv}, {n}, {compare.t_critical(lv, n)!r})" for lv in levels for n in range(2, 32)]
    return "tt(level, n, t) AS (SELECT CAST(a AS DOUBLE), b, CAST(c AS DOUBLE) FROM (VALUES " + ", ".join(rows) + ") v(a, b, c))"


FISHER = "atanh(greatest(least({x}, 0.999995), -0.999995))"


def _ci_sql(ctl: str, model: str, back: str, levels: tuple[float, ...]) -> tuple[str, ...]:
    d = PAIR_SQL, f"g AS (SELECT experiment, lead, avg({ctl}) AS mu, var_samp({model} - {ctl}) AS v, count(*) AS n, avg({'am - ac' if 'ac' in ctl else 'rm - rc'}) AS diff FROM pr GROUP BY 1, 2)", _t_sql(levels)
    dx = "t*sqrt(v/g.n)"
    return (*d, f"ci AS (SELECT experiment, lead, level, g.n, diff, {back.format(x=f'mu - {dx}')} - {back.format(x='mu')} AS lower, {back.format(x=f'mu + {dx}')} - {back.format(x='mu')} AS upper FROM g LEFT JOIN tt ON tt.n = g.n)")


CORR_SQL = _ci_sql(FISHER.format(x="ac"), FISHER.format(x="am"), "tanh({x})", compare.LEVELS)
RMS_SQL = _ci_sql("rc*rc", "rm*rm", "sqrt(greatest(0, {x}))", compare.LEVELS)
CI_OUT = "SELECT experiment, lead, level, n, round(diff, 6) + 0.0 AS diff, round(lower, 6) + 0.0 AS lower, round(upper, 6) + 0.0 AS upper FROM ci"
CI_KEYS = ["experiment", "lead", "level", "n"]


@query("paired_ci_corr", fx.with_sql("exp_stats", *CORR_SQL) + CI_OUT)
def paired_ci_corr(spark: SparkSession, sf: str) -> DataFrame:
    """Paired intervals of correlations."""
    got = compare.paired_interval(compare.paired(_experiments(spark, sf), 0, ["lead"], "acorr"), ["lead"], compare.LEVELS, True)
    return rounded(got, CI_KEYS, ["diff", "lower", "upper"])


@query("paired_ci_rms", fx.with_sql("exp_stats", *RMS_SQL) + CI_OUT)
def paired_ci_rms(spark: SparkSession, sf: str) -> DataFrame:
    """Paired intervals of RMS errors."""
    got = compare.paired_interval(compare.paired(_experiments(spark, sf), 0, ["lead"], "rms"), ["lead"], compare.LEVELS, False)
    return rounded(got, CI_KEYS, ["diff", "lower", "upper"])


@query("synoptic_ci", fx.with_sql("exp_stats", "g AS (SELECT experiment, lead, var_samp(rms*rms) AS v, avg(rms*rms) AS mu, avg(rms) AS plain, count(*) AS n FROM exp_stats GROUP BY 1, 2)", "h AS (SELECT lead, max(v) FILTER (experiment = 0) AS vc, avg(v) FILTER (experiment <> 0) AS vo, max(mu) FILTER (experiment = 0) AS mu, max(plain) FILTER (experiment = 0) AS plain, max(n) FILTER (experiment = 0) AS n FROM g GROUP BY 1)", _t_sql(compare.LEVELS)) + "SELECT lead, level, round(sqrt(greatest(0, mu - t*sqrt((vc + vo)/2/h.n))) - sqrt(greatest(0, mu)) + plain, 6) + 0.0 AS lower, round(sqrt(greatest(0, mu + t*sqrt((vc + vo)/2/h.n))) - sqrt(greatest(0, mu)) + plain, 6) + 0.0 AS upper FROM h LEFT JOIN tt ON tt.n = h.n")
def synoptic_ci(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals around the control from the spread of dates (I4)."""
    got = compare.synoptic_interval(_experiments(spark, sf), 0, ["lead"], "rms", compare.LEVELS, False)
    return rounded(got, ["lead", "level"], ["lower", "upper"])


MAP_PAIR = "mp AS (SELECT m.lead, m.lat_idx, m.lon_idx, m.init_idx, c.f AS fc, m.f AS fm FROM fcst2 m JOIN fcst c USING (init_idx, lead, lat_idx, lon_idx))"
SIG_SQL = ("sg AS (SELECT lead, lat_idx, lon_idx, avg(fc - fm) * sqrt(count(*) - 1) / CASE WHEN sqrt(var_samp(fc - fm)) > 1e-14*max(greatest(abs(fc), abs(fm))) THEN sqrt(var_samp(fc - fm)) END AS t_stat, count(*) AS n FROM mp GROUP BY 1, 2, 3)", _t_sql(compare.MAP_LEVELS))


def _maps(spark: SparkSession, sf: str) -> DataFrame:
    one = fx.view(spark, sf, "fcst").withColumn("experiment", F.lit(0))
    return one.unionByName(fx.view(spark, sf, "fcst2").withColumn("experiment", F.lit(1)))


def _significance(spark: SparkSession, sf: str) -> DataFrame:
    pairs = compare.paired(_maps(spark, sf), 0, ["lead", "lat_idx", "lon_idx"], "f", "init_idx")
    return compare.significance(pairs, ["lead", "lat_idx", "lon_idx"], compare.MAP_LEVELS[0], "init_idx")


@query("significance_mask", fx.with_sql("fcst", "fcst2", MAP_PAIR, *SIG_SQL) + "SELECT lead, lat_idx, lon_idx, round(t_stat, 6) + 0.0 AS t_stat, abs(t_stat) >= t AS significant FROM sg LEFT JOIN tt ON tt.n = sg.n")
def significance_mask(spark: SparkSession, sf: str) -> DataFrame:
    """Where a paired difference of maps is significant."""
    return _significance(spark, sf).select("lead", "lat_idx", "lon_idx", r6("t_stat").alias("t_stat"), "significant")


TIER = "ti AS (SELECT experiment, lead, max(CASE WHEN diff < lower OR diff > upper THEN level END) AS tier, max(diff) AS diff FROM ci GROUP BY 1, 2)"
TIERS = (0.95, 0.99, 0.9999)


def _tiers(spark: SparkSession, sf: str) -> DataFrame:
    pairs = compare.paired(_experiments(spark, sf), 0, ["lead"], "rms")
    return compare.strongest_tier(compare.paired_interval(pairs, ["lead"], TIERS, False), ["lead"])


@query("significance_tier", fx.with_sql("exp_stats", *_ci_sql("rc*rc", "rm*rm", "sqrt(greatest(0, {x}))", TIERS), TIER) + "SELECT experiment, lead, tier, round(diff, 6) + 0.0 AS diff FROM ti")
def significance_tier(spark: SparkSession, sf: str) -> DataFrame:
    """The strongest level at which a difference is significant."""
    return _tiers(spark, sf).select("experiment", "lead", "tier", r6("diff").alias("diff"))


@query("zonal_mean", fx.with_sql("fcst", "fcst2", MAP_PAIR, *SIG_SQL) + "SELECT lead, lat_idx, round(avg(t_stat), 6) + 0.0 AS t_stat, round(avg(CAST(abs(t_stat) >= t AS DOUBLE)), 6) + 0.0 AS significant FROM sg LEFT JOIN tt ON tt.n = sg.n GROUP BY 1, 2")
def zonal_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Means over longitude of maps and masks."""
    return rounded(compare.zonal_mean(_significance(spark, sf), ["lead"], ["t_stat", "significant"]), ["lead", "lat_idx"], ["t_stat", "significant"])


@query("range_summary", fx.with_sql("fcst", "ana", "clim_raw", fx.cells_sql()) + "SELECT lead, round(min(f - c), 8) + 0.0 AS low, round(max(f - c), 8) + 0.0 AS high, CAST(CASE WHEN max(abs(f - c)) IS NULL OR max(abs(f - c)) <= 0 THEN 0 WHEN max(abs(f - c)) <= 0.1 THEN 0.1 WHEN max(abs(f - c)) <= 1 THEN 1 WHEN max(abs(f - c)) <= 5 THEN 5 WHEN max(abs(f - c)) <= 10 THEN 10 ELSE floor(max(abs(f - c))/10)*10 END AS DOUBLE) AS bound FROM cells GROUP BY 1")
def range_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of forecast minus climatology."""
    got = compare.range_summary(fx.trio(spark, sf).withColumn("x", F.col("f") - F.col("c")), ["lead"], "x")
    return got.select("lead", r6("low", 8).alias("low"), r6("high", 8).alias("high"), "bound")


CURVE_SQL = "cv AS (SELECT experiment, lead, avg(rms) AS rms FROM exp_stats GROUP BY 1, 2)"


def _curves(spark: SparkSession, sf: str) -> DataFrame:
    return _experiments(spark, sf).groupBy("experiment", "lead").agg(F.avg("rms").alias("rms"))


@query("final_lead", fx.with_sql("exp_stats", CURVE_SQL) + "SELECT experiment, max(lead) AS lead, round(arg_max(rms, lead), 6) + 0.0 AS rms FROM cv GROUP BY 1")
def final_lead(spark: SparkSession, sf: str) -> DataFrame:
    """Values at the last lead."""
    return rounded(compare.final_lead(_curves(spark, sf), ["experiment"], "rms"), ["experiment", "lead"], ["rms"])


@query("dieoff_table", fx.with_sql("exp_stats", *_ci_sql("rc*rc", "rm*rm", "sqrt(greatest(0, {x}))", TIERS), TIER, CURVE_SQL) + "SELECT c.experiment, c.lead, c.lead/24.0::DOUBLE AS day, round(c.rms, 6) + 0.0 AS rms, round(c.rms - k.rms, 6) + 0.0 AS diff, tier FROM cv c LEFT JOIN cv k ON k.experiment = 0 AND k.lead = c.lead LEFT JOIN ti ON ti.experiment = c.experiment AND ti.lead = c.lead")
def dieoff_table(spark: SparkSession, sf: str) -> DataFrame:
    """Curves with differences from the control and their tiers."""
    got = compare.die_off(_curves(spark, sf), _tiers(spark, sf), 0, ["lead"], "rms")
    return got.select("experiment", "lead", calendar.forecast_day(F.col("lead")).alias("day"), r6("rms").alias("rms"), r6("diff").alias("diff"), "tier")


# --- scorecards and increments -----------------------------------------------------------------

F7 = "CASE WHEN {x} IS NULL THEN '9.9999999E+14' WHEN {x} = 0 THEN '0.0000000' WHEN abs({x}) < 0.01 OR abs({x}) >= 10000 THEN printf('%.6E', {x}) WHEN abs({x}) < 10 THEN printf('%.6f', {x}) WHEN abs({x}) < 100 THEN printf('%.5f', {x}) WHEN abs({x}) < 1000 THEN printf('%.4f', {x}) ELSE printf('%.3f', {x}) END"
SC_REGIONS = "sr(region, domain_name, north, south, east, west) AS (SELECT a, b, c::DOUBLE, d::DOUBLE, e::DOUBLE, f::DOUBLE FROM (VALUES " + ", ".join(f"('{b[0]}','{b[1]}',{b[2]},{b[3]},{b[4]},{b[5]})" for b in BOX_REGIONS + MASK_REGIONS) + ") v(a, b, c, d, e, f))"
SC_STATS = "st(stat, nm) AS (VALUES " + ", ".join(f"('{k}','{v}')" for k, v in SCORECARD_STATS.items()) + ")"
SC_ROWS = """sc AS (SELECT TIMESTAMP '2024-05-01' + INTERVAL (init_day - 1) DAY AS init_date, lead, region, v.var, v.stat, CASE WHEN v.var = 'T' THEN 850.0 ELSE 1000.0 END AS level, v.value
 FROM exp_stats, (VALUES ('NHE'), ('CUS')) r(region), LATERAL (SELECT * FROM (VALUES ('T', 'acorr', acorr), ('Q', 'rms', rms), ('Q', 'rms_dis', rms*0.001), ('PM25', 'rms', acorr), ('T', 'mse', rms)) x(var, stat, value)) v WHERE experiment = 0)"""
UNSCALED = "CASE WHEN stat = 'acorr' THEN value WHEN var IN ('Q','Q2M') THEN value * CASE WHEN stat IN ('rms_dis','rms_dsp') THEN 1e-6 ELSE 1e-3 END WHEN var = 'PM25' THEN value * CASE WHEN stat IN ('rms_dis','rms_dsp') THEN 1e-12 ELSE 1e-6 END ELSE value END"


@query("scorecard_lines", fx.with_sql("exp_stats", SC_REGIONS, SC_STATS, SC_ROWS, f"u AS (SELECT *, {UNSCALED} AS x FROM sc)") + "SELECT strftime(init_date, '%Y%m%d%H') AS init_date, '0.0|' || strftime(init_date, '%Y%m%d%H') || '|' || domain_name || '|' || " + F7.format(x="east") + " || '|model|exp1|' || " + F7.format(x="level::DOUBLE") + " || '|pl|' || " + F7.format(x="north") + " || '|' || lower(var) || '|exp1|' || " + F7.format(x="south") + " || '|' || nm || '|' || lead || '|fc|' || " + F7.format(x="x") + " || '|ana|' || " + F7.format(x="west") + " || '|' AS line FROM u JOIN sr USING (region) JOIN st USING (stat)")
def scorecard_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Scorecard lines of a control's statistics."""
    c = F.col
    rows = F.array(*(F.struct(F.lit(v).alias("var"), F.lit(s).alias("stat"), x.cast("double").alias("value")) for v, s, x in (("T", "acorr", c("acorr")), ("Q", "rms", c("rms")), ("Q", "rms_dis", c("rms") * 0.001), ("PM25", "rms", c("acorr")), ("T", "mse", c("rms")))))
    ctl = _experiments(spark, sf).where("experiment = 0")
    date = F.lit("2024-05-01 00:00:00").cast("timestamp") + F.make_dt_interval(days=c("init_day") - 1)
    stats = ctl.select(date.alias("init_date"), "lead", F.explode(F.array(F.lit("NHE"), F.lit("CUS"))).alias("region"), rows.alias("rows"))
    stats = stats.select("init_date", "lead", "region", F.explode("rows").alias("r")).select("init_date", "lead", "region", "r.*").withColumn("level", F.when(c("var") == "T", 850.0).otherwise(1000.0))
    got = scorecard.scorecard_lines(stats, regions.region_catalog(spark), "model", "ana", "exp1")
    return got.select(F.date_format("init_date", "yyyyMMddHH").alias("init_date"), "line")


STORED = "stored AS (SELECT DISTINCT init_idx FROM fcst WHERE init_idx < 3)"


@query("dataset_status", fx.with_sql("fcst", "ana") + "SELECT 'fcst' AS dataset, count(*) AS n_needed, count(*) FILTER (init_idx < 3) AS n_reused, count(*) FILTER (init_idx >= 3) AS n_missing FROM (SELECT DISTINCT init_idx FROM fcst) UNION ALL SELECT 'ana', count(*), count(*) FILTER (t_idx % 2 = 0), count(*) FILTER (t_idx % 2 <> 0) FROM (SELECT DISTINCT t_idx FROM ana)")
def dataset_status(spark: SparkSession, sf: str) -> DataFrame:
    """What is needed, reused and missing of each field."""
    f = fx.view(spark, sf, "fcst").select(F.col("init_idx").alias("init_date"))
    a = fx.view(spark, sf, "ana").select(F.col("t_idx").alias("init_date"))
    return incremental.status_report({"fcst": (f, f.where("init_date < 3")), "ana": (a, a.where("init_date % 2 = 0"))})


@query("incremental_dates", fx.with_sql("fcst", STORED) + "SELECT init_idx, count(*) AS n_cells FROM fcst WHERE init_idx NOT IN (SELECT init_idx FROM stored) GROUP BY 1")
def incremental_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of dates whose statistics are not stored yet."""
    f = fx.view(spark, sf, "fcst")
    fresh = incremental.new_dates(f, f.where("init_idx < 3"), "init_idx")
    return f.join(F.broadcast(fresh), "init_idx").groupBy("init_idx").agg(F.count("*").alias("n_cells"))


@query("stat_names", fx.with_sql("exp_stats") + "SELECT regexp_extract(name, '^([^_]+)_', 1) AS var, regexp_extract(regexp_replace(name, '_(avg|glo)$', ''), '^[^_]+_(.*)$', 1) AS stat, CASE WHEN name LIKE '%_avg' THEN 'avg' WHEN name LIKE '%_glo' THEN 'glo' ELSE 'each' END AS kind, count(*) AS n, round(max(value), 6) + 0.0 AS top FROM (SELECT acorr AS \"T2m_acorr\", rms AS \"T_rms_bar_avg\", rms*acorr AS \"Q_mse_glo\" FROM exp_stats) UNPIVOT (value FOR name IN (\"T2m_acorr\", \"T_rms_bar_avg\", \"Q_mse_glo\")) GROUP BY 1, 2, 3")
def stat_names(spark: SparkSession, sf: str) -> DataFrame:
    """Wide statistics by the parts of their array names."""
    wide = _experiments(spark, sf).select(F.col("acorr").alias("T2m_acorr"), F.col("rms").alias("T_rms_bar_avg"), (F.col("rms") * F.col("acorr")).alias("Q_mse_glo"))
    long = wide.unpivot([], wide.columns, "name", "value")
    return long.groupBy(*(v.alias(k) for k, v in derive.split_stat_name(F.col("name")).items())).agg(F.count("value").alias("n"), r6(F.max("value")).alias("top"))
