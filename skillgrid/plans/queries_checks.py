"""Registered queries: loading, file sets, gaps, merges, missing values, order, work filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import calendar, catalog, derive
from ..functions.grid import grid as make_grid
from ..functions.grid import wrapped_longitude
from ..operators import align, atoms, compare, regions, regrid, statistics, validate
from ..sources import fields
from ..streaming import incremental
from . import fixtures as fx
from .queries import BOX_SQL, REGION_SQL, REGIONAL, RKEYS, STAT_SQL, query, r6, rounded, s6, two_pass
from .queries_more import CI_KEYS, PAIR_SQL, TARGET, _t_sql

# --- loading and file sets ---------------------------------------------------------------------


@query("loaded_levels", fx.with_sql("fcst3") + "SELECT lev, lead, count(f) AS n_values, round(max(f), 6) + 0.0 AS top FROM fcst3 WHERE lev IN (1000, 500) AND lead IN (0, 12) AND init_idx BETWEEN 1 AND 3 GROUP BY 1, 2")
def loaded_levels(spark: SparkSession, sf: str) -> DataFrame:
    """A forecast cut to levels, leads and dates before anything is computed, each of which must be there."""
    got = validate.loaded({"F": fx.view(spark, sf, "fcst3"), "A": fx.view(spark, sf, "ana")}, [1000, 500], [0, 12], (1, 3))["F"]
    return got.groupBy("lev", "lead").agg(F.count("f").alias("n_values"), r6(F.max("f")).alias("top"))


LISTED_SQL = "listed AS (SELECT DISTINCT CASE p_type WHEN 'ECONOMY' THEN 'default' ELSE p_type END AS collection, CAST(p_size % 3 AS INT) AS turn, '/d' || CAST(p_size % 3 AS INT) || '/' || p_brand AS path FROM part), wanted AS (SELECT DISTINCT p_type AS collection FROM part)"


@query("collection_files", "WITH " + LISTED_SQL + ", src AS (SELECT collection, CASE WHEN collection IN (SELECT collection FROM listed) THEN collection ELSE 'default' END AS source FROM wanted) SELECT s.collection, arg_min(l.path, l.turn) AS path FROM src s LEFT JOIN listed l ON l.collection = s.source GROUP BY s.collection, split_part(l.path, '/', 3)")
def collection_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of each collection or of the default, none listed twice."""
    c = F.col
    part, turn = fx.table(spark, sf, "part"), (c("p_size") % 3).cast("int")
    name = F.when(c("p_type") == "ECONOMY", "default").otherwise(c("p_type"))
    listed = part.select(name.alias("collection"), turn.alias("turn"), F.concat(F.lit("/d"), turn.cast("string"), F.lit("/"), "p_brand").alias("path")).distinct()
    return fields.collection_files(part.select(c("p_type").alias("collection")), listed)


@query("wildcard_files", "WITH k AS (SELECT DISTINCT o_orderdate AS d FROM orders), f AS (SELECT '/a+b/' || strftime(d, '%Y') || '/run' || (day(d) % 3) || '_' || strftime(d, '%m%d') || '.nc' AS path FROM k), h AS (SELECT k.d, f.path FROM k JOIN f ON substr(f.path, 6, 4) = strftime(k.d, '%Y') AND regexp_matches(f.path, '^/a\\+b/[0-9]{4}/run._' || strftime(k.d, '%m%d') || '.nc$')) SELECT strftime(d, '%Y%m%d') AS init_date, min(path) AS path, count(*) AS n_matches FROM h GROUP BY d")
def wildcard_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files found by templates with wildcards, by a hash join on the folders before them."""
    t = F.col("o_orderdate").cast("timestamp")
    keys = fx.table(spark, sf, "orders").select(t.alias("init_date")).distinct().withColumn("valid_time", F.col("init_date"))
    d = F.col("init_date")
    path = F.concat(F.lit("/a+b/"), F.date_format(d, "yyyy"), F.lit("/run"), (F.day(d) % 3).cast("string"), F.lit("_"), F.date_format(d, "MMdd"), F.lit(".nc"))
    got = fields.matched_files(keys, ["{init_YYYY}/run?_{init_MM}{init_DD}.nc"], keys.select(path.alias("path")), "/a+b/")
    return got.select(F.date_format("init_date", "yyyyMMdd").alias("init_date"), "path", "n_matches")


@query("time_keys", "SELECT DISTINCT strftime(o_orderdate, '%Y%m%d%H') AS init_date, CAST(o_orderkey % 2 AS INT) AS form FROM orders")
def time_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Time keys written in different formats."""
    t, form = F.col("o_orderdate").cast("timestamp"), (F.col("o_orderkey") % 2).cast("int")
    text = F.when(form == 0, F.date_format(t, "yyyyMMddHH")).otherwise(F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
    found = fx.table(spark, sf, "orders").select(calendar.parse_time(text).alias("t"), form.alias("form"))
    return found.select(F.date_format("t", "yyyyMMddHH").alias("init_date"), "form").distinct()


NAMED_SQL = "'stats_m' || (user_id % 3) || '_ana_clm_len' || (1 + event_id % 4) || 'd_int12h' || CASE WHEN event_id % 2 = 0 THEN '_spc2d' ELSE '' END || '_excl' || (user_id % 2)"


@query("name_metadata", f"SELECT 'm' || (user_id % 3) AS fcst, CAST(1 + event_id % 4 AS INT) AS length_days, CAST(12 AS INT) AS interval, CAST(CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END AS INT) AS spacing, CAST(user_id % 2 AS INT) AS excluded, count(*) AS n FROM events WHERE {NAMED_SQL} IS NOT NULL GROUP BY ALL")
def name_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Models and timing from the names of statistics files."""
    name = F.expr(NAMED_SQL.replace("(user_id % 3)", "CAST(user_id % 3 AS INT)").replace("(1 + event_id % 4)", "CAST(1 + event_id % 4 AS INT)").replace("(user_id % 2)", "CAST(user_id % 2 AS INT)"))
    about = fields.name_metadata(F.col("name"))
    keys = [about[k].alias(k) for k in ("fcst", "length_days", "interval", "spacing", "excluded")]
    return fx.table(spark, sf, "events").select(name.alias("name")).groupBy(*keys).agg(F.count("*").alias("n"))


@query("stat_labels", fx.with_sql("exp_stats") + "SELECT v.stat, CASE WHEN v.stat = 'acorr' THEN '1' END AS plain, count(*) AS n FROM exp_stats, (VALUES ('acorr'), ('rms')) v(stat) GROUP BY 1, 2")
def stat_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Long statistics joined to their catalogue of names and units (K2, F16)."""
    long = fx.view(spark, sf, "exp_stats").unpivot(["experiment"], ["acorr", "rms"], "stat", "value").withColumn("var", F.lit("T2M"))
    named = long.join(F.broadcast(fields.stat_catalog(spark, ["T2M"])), ["var", "stat"])
    unitless = F.when(F.col("units") == catalog.unit_of("T2M", "acorr"), "1")
    return named.groupBy("stat", unitless.alias("plain")).agg(F.count("*").alias("n"))


# --- gaps, reuse, compatibility ----------------------------------------------------------------


@query("climatology_gaps", fx.with_sql("clim_raw") + "SELECT t.cycle, CAST(coalesce(n, 0) AS INT) AS n_months FROM (VALUES (CAST(0 AS INT)), (6), (12)) t(cycle) LEFT JOIN (SELECT cycle, count(DISTINCT month) AS n FROM clim_raw WHERE NOT (cycle = 12 AND month = 7) GROUP BY 1) h USING (cycle) WHERE coalesce(n, 0) < 12")
def climatology_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Cycles that are needed and lack months."""
    times = spark.createDataFrame([(0,), (6,), (12,)], "cycle int")
    return align.climatology_gaps(times, fx.view(spark, sf, "clim_raw").where("NOT (cycle = 12 AND month = 7)"))


@query("undeclared_gaps", fx.with_sql("exp_stats") + "SELECT CAST(d AS INT) AS init_day FROM range(1, 36) r(d) WHERE d NOT IN (SELECT init_day FROM exp_stats) AND d NOT IN (31, 33)")
def undeclared_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Dates that are missing without being declared (U4)."""
    expected = spark.range(1, 36).select(F.col("id").cast("int").alias("init_day"))
    return compare.undeclared_gaps(expected, fx.view(spark, sf, "exp_stats"), spark.createDataFrame([(31,), (33,)], "init_day int"))


@query("exclusion_mismatches", "WITH x AS (SELECT DISTINCT CAST(user_id % 3 AS INT) AS experiment, CAST(EXTRACT(day FROM ts) AS INT) AS init_day FROM events WHERE value > 250) SELECT init_day, count(*) AS n_experiments FROM x GROUP BY 1 HAVING count(*) < (SELECT count(DISTINCT experiment) FROM x)")
def exclusion_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """Excluded dates that not all experiments exclude."""
    x = fx.table(spark, sf, "events").where("value > 250").select((F.col("user_id") % 3).cast("int").alias("experiment"), F.day("ts").alias("init_day"))
    return compare.exclusion_mismatches(x)


@query("date_spacing", fx.with_sql("exp_stats") + "SELECT experiment, CAST(min(step) AS INT) AS spacing FROM (SELECT experiment, init_day - lag(init_day) OVER (PARTITION BY experiment ORDER BY init_day) AS step FROM (SELECT DISTINCT experiment, init_day FROM exp_stats WHERE rms > 250)) GROUP BY 1")
def date_spacing(spark: SparkSession, sf: str) -> DataFrame:
    """Steps between the dates of experiments."""
    return compare.date_spacing(fx.view(spark, sf, "exp_stats").where("rms > 250"))


@query("grid_mismatches", fx.with_sql("fcst", "fcst3", "m AS (SELECT DISTINCT 0 AS experiment, lat_idx, lon_idx FROM fcst UNION SELECT 1, lat_idx, lon_idx FROM fcst UNION SELECT 2, lat_idx, lon_idx + 1 FROM fcst3)", "c AS (SELECT * FROM m WHERE experiment = 0)") + "SELECT CAST(m.experiment AS INT) AS experiment, count(*) AS n_cells, (SELECT count(*) FROM c) AS n_control, count(c.lat_idx) AS n_common FROM m LEFT JOIN c ON c.lat_idx = m.lat_idx AND c.lon_idx = m.lon_idx GROUP BY 1 HAVING count(*) <> (SELECT count(*) FROM c) OR count(c.lat_idx) <> (SELECT count(*) FROM c)")
def grid_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """Experiments on another grid than the control."""
    one = fx.view(spark, sf, "fcst").select("lat_idx", "lon_idx")
    two = fx.view(spark, sf, "fcst3").select("lat_idx", (F.col("lon_idx") + 1).alias("lon_idx"))
    maps = one.withColumn("experiment", F.lit(0)).unionByName(one.withColumn("experiment", F.lit(1))).unionByName(two.withColumn("experiment", F.lit(2)))
    return compare.grid_mismatches(maps, 0)


@query("reusable_results", "WITH e AS (SELECT DISTINCT o_orderdate AS d FROM orders WHERE o_orderdate < DATE '1996-01-01'), s AS (SELECT DISTINCT o_orderstatus AS result, o_orderdate AS d FROM orders WHERE o_orderdate < DATE '1996-01-01' OR o_orderstatus = 'P') SELECT result, count(*) AS n_dates, (SELECT count(*) FROM e) - count(*) AS n_lacking FROM s LEFT JOIN e USING (d) GROUP BY 1 HAVING count(*) = count(CASE WHEN d < DATE '1996-01-01' THEN 1 END)")
def reusable_results(spark: SparkSession, sf: str) -> DataFrame:
    """Stored results that hold expected dates only, with the number they lack."""
    orders = fx.table(spark, sf, "orders").select(F.col("o_orderstatus").alias("result"), F.col("o_orderdate").alias("init_date"))
    early = F.col("init_date") < F.lit("1996-01-01").cast("date")
    return incremental.least_excluded(orders.where(early | (F.col("result") == "P")), orders.where(early))


# --- merges ------------------------------------------------------------------------------------


@query("lead_files_combined", fx.with_sql("fcst", "fcst2", "m AS (SELECT init_idx, lead, lat_idx, lon_idx, f FROM fcst2 WHERE init_idx < 3)", "s AS (SELECT init_idx, lead, lat_idx, lon_idx, f, 2*f AS g FROM fcst)") + "SELECT init_idx, lead, lat_idx, lon_idx, round(m.f, 6) + 0.0 AS f, round(s.g, 6) + 0.0 AS g FROM m FULL JOIN s USING (init_idx, lead, lat_idx, lon_idx)")
def lead_files_combined(spark: SparkSession, sf: str) -> DataFrame:
    """Variables of files with several leads replace those of single ones, whole."""
    keys = ["init_idx", "lead", "lat_idx", "lon_idx"]
    single = fx.view(spark, sf, "fcst").withColumn("g", 2 * F.col("f"))
    return rounded(align.combined(single, fx.view(spark, sf, "fcst2").where("init_idx < 3"), keys), keys, ["f", "g"])


@query("static_first", fx.with_sql("fcst", "s AS (SELECT *, 100*init_idx + lat_idx AS height FROM fcst)") + "SELECT init_idx, lead, lat_idx, lon_idx, round(f, 6) + 0.0 AS f, CAST(arg_min(height, init_idx) OVER (PARTITION BY lead, lat_idx, lon_idx) AS INT) AS height FROM s")
def static_first(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks in order, with a static field that is the first date's everywhere."""
    keys = ["init_idx", "lead", "lat_idx", "lon_idx"]
    cells = fx.view(spark, sf, "fcst").withColumn("height", (100 * F.col("init_idx") + F.col("lat_idx")).cast("int"))
    got = validate.chunks_merged([validate.date_range(cells, 0, 1), validate.date_range(cells, 2, 4)], keys, "init_idx", ("height",))
    return got.select(*keys, r6("f").alias("f"), "height")


@query("derived_across", "WITH q AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN l_discount/10 END AS q2m FROM lineitem), p AS (SELECT l_orderkey, l_linenumber, 90000 + l_quantity*100 AS ps FROM lineitem WHERE l_linenumber < 5), e AS (SELECT *, ln(ps/100*q2m/(0.622 + 0.378*q2m)/6.112) AS lg FROM q LEFT JOIN p USING (l_orderkey, l_linenumber)) SELECT l_orderkey, l_linenumber, round(243.5*lg/nullif(17.67 - lg, 0) + 273.15, 6) + 0.0 AS d2m FROM e")
def derived_across(spark: SparkSession, sf: str) -> DataFrame:
    """A variable whose dependencies lie in two collections."""
    keys, c = ["l_orderkey", "l_linenumber"], F.col
    items = fx.table(spark, sf, "lineitem")
    one = items.select(*keys, F.when(c("l_discount") > 0, c("l_discount") / 10).alias("q2m"))
    two = items.where("l_linenumber < 5").select(*keys, (90000 + c("l_quantity") * 100).alias("ps"), "l_tax")
    return derive.across_collections([one, two], keys, ["D2m"]).select(*keys, r6("D2m").alias("d2m"))


@query("particles", "SELECT l_orderkey, l_linenumber, round(7*l_tax + CASE WHEN l_discount > 0.01 THEN l_discount END, 6) + 0.0 AS pm25 FROM lineitem")
def particles(spark: SparkSession, sf: str) -> DataFrame:
    """Fine particles as the sum of masses, missing if one is."""
    c, masses = F.col, catalog.DEPENDENCIES["PM25"]
    first = (c("l_tax") + F.when(c("l_discount") > 0.01, c("l_discount"))).alias(masses[0])
    rest = [c("l_tax").alias(m) for m in masses[1:]]
    got = derive.with_derived(fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", first, *rest), ["PM25"])
    return got.select("l_orderkey", "l_linenumber", r6("PM25").alias("pm25"))


# --- weights, regions, regridding --------------------------------------------------------------


@query("level_weights", fx.with_sql("fcst3") + "SELECT lev, lead, round(sum(f*w)/sum(w), 6) + 0.0 AS f FROM (SELECT *, cos(radians(-90.0 + 15.0*lat_idx)) * lev/1000.0 AS w FROM fcst3 WHERE NOT (lev = 850 AND lat_idx = 6)) GROUP BY 1, 2")
def level_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Means with weights that differ by level."""
    cells = fx.view(spark, sf, "fcst3")
    levels = cells.select("lev").distinct()
    grid = fx.grid(spark).select("lat_idx", "lon_idx", "grid_weight")
    weights = grid.withColumn("lev", F.explode(F.array(*(F.lit(v) for v in (1000, 850, 500))))).join(levels, "lev")
    weights = weights.where("NOT (lev = 850 AND lat_idx = 6)").select("lev", "lat_idx", "lon_idx", (F.col("grid_weight") * F.col("lev") / 1000).alias("weight"))
    got = align.with_weights(cells, weights).groupBy("lev", "lead").agg(statistics.weighted_mean(F.col("f"), F.col("grid_weight")).alias("f"))
    return rounded(got, ["lev", "lead"], ["f"])


@query("mask_region", fx.with_sql("mask_src", "fcst", "cus AS (SELECT g.a AS lat_idx, g.b AS lon_idx FROM (SELECT CAST(y AS INT) AS a, CAST(x AS INT) AS b FROM range(13) s(y), range(24) t(x)) g JOIN mask_src m ON m.lat_idx = 2*g.a AND m.lon_idx = CASE WHEN g.b >= 12 THEN 2*(g.b - 12) ELSE 2*g.b + 24 END WHERE land = 1 AND g.b > 0)") + "SELECT 'CUS' AS region, count(*) AS n_cells, count(f) AS n_values FROM (SELECT c.*, f.f FROM cus c LEFT JOIN fcst f ON f.lat_idx = c.lat_idx AND f.lon_idx = c.lon_idx)")
def mask_region(spark: SparkSession, sf: str) -> DataFrame:
    """A region from a mask file with the values of a field there (M2)."""
    mask = regrid.nearest_mask(fx.view(spark, sf, "mask_src"), (25, 48), (13, 24), "land")
    cells = regions.cells_of_regions(fx.grid(spark), {"CUS": mask}, ("CUS",))
    values = cells.join(fx.view(spark, sf, "fcst"), ["lat_idx", "lon_idx"], "left")
    return values.groupBy("region").agg(F.count("*").alias("n_cells"), F.count("f").alias("n_values"))


@query("regrid_standard_time", fx.with_sql("clim_raw") + "SELECT CAST(month AS INT) AS time, CAST(count(DISTINCT cycle)*84 AS BIGINT) AS n FROM clim_raw GROUP BY 1")
def regrid_standard_time(spark: SparkSession, sf: str) -> DataFrame:
    """Regridded climatology with months as its time; a variable that is no number is dropped."""
    cells = statistics.dense(fx.view(spark, sf, "clim_raw"), ["cycle", "month"], fx.grid(spark).select("lat_idx", "lon_idx"), ["c"]).withColumn("note", F.lit("text"))
    got, _ = regrid.regridded(cells, regrid.overlap_tables(spark, (13, 24), TARGET), ["cycle", "month"], ["c", "note"])
    return regrid.standard_time(got, True).groupBy("time").agg(F.count("*").alias("n"))


@query("mask_longitudes", fx.with_sql("mask_src") + "SELECT CAST(CASE WHEN 7.5*lon_idx > 180 THEN 7.5*lon_idx - 360 ELSE 7.5*lon_idx END AS DOUBLE) AS lon, count(*) AS n, sum(land) AS n_land FROM mask_src GROUP BY 1")
def mask_longitudes(spark: SparkSession, sf: str) -> DataFrame:
    """Longitudes from 0 to 360 in the range from -180 to 180."""
    lon = wrapped_longitude(7.5 * F.col("lon_idx"))
    got = fx.view(spark, sf, "mask_src").groupBy(lon.cast("double").alias("lon")).agg(F.count("*").alias("n"), F.sum("land").alias("n_land"))
    return got.select("lon", "n", "n_land")


@query("stray_dimension", fx.with_sql("fcst3") + "SELECT init_idx, lead, lat_idx, lon_idx, lev, round(f, 6) + 0.0 AS f FROM fcst3 QUALIFY lev = min(lev) OVER (PARTITION BY init_idx, lead, lat_idx, lon_idx)")
def stray_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """The first of a dimension that does not belong."""
    keys = ["init_idx", "lead", "lat_idx", "lon_idx"]
    return rounded(align.first_slice(fx.view(spark, sf, "fcst3"), F.col("lev"), keys), [*keys, "lev"], ["f"])


# --- missing values and small units ------------------------------------------------------------

HOLES = "CASE WHEN init_day = 11 AND lead = 12 AND experiment = 1 OR init_day = 3 AND lead = 24 AND experiment = 0 THEN NULL ELSE {x} END"
HOLES_SQL = ("exp_stats", "holes AS (SELECT experiment, init_day, lead, " + HOLES.format(x="acorr") + " AS acorr, " + HOLES.format(x="rms") + " AS rms FROM exp_stats)")
STRICT = "CASE WHEN count({x}) = count(*) THEN {f}({x}) END"


def _holes(spark: SparkSession, sf: str) -> DataFrame:
    return fx.view(spark, sf, "exp_stats").withColumns({v: F.expr(HOLES.format(x=v)) for v in ("acorr", "rms")})


@query("paired_ci_missing", fx.with_sql(*HOLES_SQL, PAIR_SQL.replace("exp_stats", "holes"), _t_sql((0.95,)), f"g AS (SELECT experiment, lead, {STRICT.format(f='avg', x='rc*rc')} AS mu, {STRICT.format(f='var_samp', x='rm*rm - rc*rc')} AS v, count(*) AS n, {STRICT.format(f='avg', x='rm - rc')} AS diff FROM pr GROUP BY 1, 2)") + "SELECT experiment, lead, level, g.n, round(diff, 6) + 0.0 AS diff, CASE WHEN v IS NOT NULL AND mu IS NOT NULL THEN round(sqrt(greatest(0, mu - t*sqrt(v/g.n))) - sqrt(mu), 6) + 0.0 END AS lower, CASE WHEN v IS NOT NULL AND mu IS NOT NULL THEN round(sqrt(greatest(0, mu + t*sqrt(v/g.n))) - sqrt(mu), 6) + 0.0 END AS upper FROM g LEFT JOIN tt ON tt.n = g.n")
def paired_ci_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals are missing where a date's value is."""
    got = compare.paired_interval(compare.paired(_holes(spark, sf), 0, ["lead"], "rms"), ["lead"], (0.95,), False)
    return rounded(got, CI_KEYS, ["diff", "lower", "upper"])


ATANH = "CASE WHEN experiment = 0 THEN atanh(greatest(least(acorr, 0.999995), -0.999995)) WHEN abs(acorr) < 1 THEN atanh(acorr) END"


@query("synoptic_ci_corr", fx.with_sql(*HOLES_SQL, f"z AS (SELECT *, {ATANH} AS z FROM holes)", f"g AS (SELECT experiment, lead, {STRICT.format(f='var_samp', x='z')} AS v, {STRICT.format(f='avg', x='z')} AS mu, {STRICT.format(f='avg', x='acorr')} AS plain, count(*) AS n FROM z GROUP BY 1, 2)", "h AS (SELECT lead, max(v) FILTER (experiment = 0) AS vc, CASE WHEN count(v) = count(*) THEN avg(v) FILTER (experiment <> 0) END AS vo, max(mu) FILTER (experiment = 0) AS mu, max(plain) FILTER (experiment = 0) AS plain, max(n) FILTER (experiment = 0) AS n FROM g GROUP BY 1)", _t_sql(compare.LEVELS)) + "SELECT lead, level, round(tanh(mu - t*sqrt((vc + vo)/2/h.n)) - tanh(mu) + plain, 6) + 0.0 AS lower, round(tanh(mu + t*sqrt((vc + vo)/2/h.n)) - tanh(mu) + plain, 6) + 0.0 AS upper FROM h LEFT JOIN tt ON tt.n = h.n")
def synoptic_ci_corr(spark: SparkSession, sf: str) -> DataFrame:
    """Intervals of correlations around the control, with missing values."""
    return rounded(compare.synoptic_interval(_holes(spark, sf), 0, ["lead"], "acorr", compare.LEVELS, True), ["lead", "level"], ["lower", "upper"])


TINY = tuple(p.replace("f.f, a.a, c.c,", "f.f*1e-7 AS f, a.a*1e-7 AS a, c.c*1e-7 AS c,") for p in REGIONAL)
TINY_STATS = ("acorr", "rms_dsp")


@query("regional_small_units", fx.with_sql(*TINY, two_pass("init_idx, lead, region", "rc")) + f"SELECT init_idx, lead, region, {s6(STAT_SQL['acorr'], 'acorr')}, round(1e14*dsp, 6) + 0.0 AS rms_dsp FROM z")
def regional_small_units(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of fields in units in which they are tiny, such as humidity in kg/kg."""
    cells = fx.trio(spark, sf).withColumns({v: F.col(v) * 1e-7 for v in "fac"})
    got = statistics.regional(align.by_region(cells, regions.box_cells(fx.grid(spark))), RKEYS, TINY_STATS)
    return rounded(got.withColumn("rms_dsp", F.col("rms_dsp") * 1e14), RKEYS, list(TINY_STATS))


# --- order and work ----------------------------------------------------------------------------


@query("ordered_levels", fx.with_sql("fcst3") + "SELECT CAST(row_number() OVER (ORDER BY lev DESC, lead) AS INT) AS place, lev, lead, n FROM (SELECT lev, lead, count(*) AS n FROM fcst3 GROUP BY 1, 2) ORDER BY lev DESC, lead")
def ordered_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Levels from the ground up and leads in order, each with its place."""
    n = fx.view(spark, sf, "fcst3").groupBy("lev", "lead").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy(F.desc("lev"), "lead"))  # a row a level and lead
    return n.select(place.alias("place"), "lev", "lead", "n").orderBy(F.desc("lev"), "lead")


@query("ordered_times", fx.with_sql("ana") + "SELECT CAST(row_number() OVER (ORDER BY t_idx) AS INT) AS place, t_idx, n, round(top, 6) + 0.0 AS top FROM (SELECT t_idx, count(*) AS n, max(a) AS top FROM ana GROUP BY 1)")
def ordered_times(spark: SparkSession, sf: str) -> DataFrame:
    """An analysis in the order of its times, each with its place (O2)."""
    n = fx.view(spark, sf, "ana").groupBy("t_idx").agg(F.count("*").alias("n"), r6(F.max("a")).alias("top"))
    placed = n.withColumn("place", F.row_number().over(Window.orderBy("t_idx")))  # a row a time
    return validate.in_time_order(placed, "t_idx").select("place", "t_idx", "n", "top")


SINGLE_SQL = tuple(p.replace("FROM fcst f", "FROM (SELECT * FROM fcst WHERE init_idx = 3) f") for p in REGIONAL)


@query("single_forecast", fx.with_sql(*SINGLE_SQL, two_pass("init_idx, lead, region", "rc")) + f"SELECT init_idx, lead, region, {s6(STAT_SQL['rms'], 'rms')}, {s6(STAT_SQL['acorr'], 'acorr')} FROM z")
def single_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Regional statistics of one date, from fields that were cut to it and kept; no averages."""
    f = fx.view(spark, sf, "fcst").withColumns({"t_idx": F.col("init_idx") * 2 + (F.col("lead") / 12).cast("int"), "cycle": F.col("lead") % 24, "month": F.lit(5)})
    held = validate.single_forecast({"F": f, "A": fx.view(spark, sf, "ana"), "C": fx.view(spark, sf, "clim_raw")}, 3, times={"A": ["t_idx"], "C": ["cycle", "month"]})
    cells = align.aligned(held["F"], held["A"], held["C"], ("t_idx",), ("cycle", "month"))
    cells = align.with_weights(cells, fx.grid(spark).select("lat_idx", "lon_idx", "grid_weight"))
    got = atoms.regional_by_atoms(cells, regions.box_cells(fx.grid(spark)), ["init_idx", "lead"], tuple(b[0] for b in catalog.BOX_REGIONS))
    return rounded(got, RKEYS, ["rms", "acorr"])


@query("required_variables", fx.with_sql("mixed", "ana_mixed") + "SELECT kind, name FROM (VALUES ('F', 'T'), ('F', 'T2M'), ('F', 'Q'), ('A', 'T2M'), ('A', 'PS')) w(kind, name) WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT 'F' AS kind, var FROM mixed UNION ALL SELECT DISTINCT 'A', var FROM ana_mixed) h WHERE h.kind = w.kind AND h.var = w.name)")
def required_variables(spark: SparkSession, sf: str) -> DataFrame:
    """Variables that the forecast or the analysis lacks, of those that are required of each."""
    both = {"F": fx.view(spark, sf, "mixed"), "A": fx.view(spark, sf, "ana_mixed")}
    return validate.lacking_variables(both, {"F": ["T", "T2M", "Q"], "A": ["T2M", "PS"]})


@query("wanted_work", fx.with_sql("exp_stats") + "SELECT experiment, lead, count(*) AS n, round(max(rms), 6) + 0.0 AS top FROM exp_stats WHERE experiment IN (0, 2) AND lead IN (12, 36) GROUP BY 1, 2")
def wanted_work(spark: SparkSession, sf: str) -> DataFrame:
    """The part of a comparison that was asked for."""
    got = validate.wanted_work(fx.view(spark, sf, "exp_stats"), experiment=[0, 2], lead=[12, 36])
    return got.groupBy("experiment", "lead").agg(F.count("*").alias("n"), r6(F.max("rms")).alias("top"))


@query("checked_values", fx.with_sql("fcst") + "SELECT init_idx, lead, count(*) AS n_sampled, count(*) FILTER (f IS NULL) AS n_missing, count(*) FILTER (f < 5 OR f > 50.5) AS n_out FROM fcst GROUP BY 1, 2 HAVING count(*) FILTER (f IS NULL) > 0 OR count(*) FILTER (f < 5 OR f > 50.5) > 0")
def checked_values(spark: SparkSession, sf: str) -> DataFrame:
    """Values that are missing or out of range, by date and lead, over all cells."""
    return validate.sampled_problems(fx.view(spark, sf, "fcst"), ["init_idx", "lead"], "f", 5, 50.5, 1)


@query("experiment_names", "SELECT DISTINCT CASE WHEN regexp_full_match(p_name, '[A-Za-z0-9]+') THEN p_name END AS shown, p_name AS name FROM part UNION SELECT DISTINCT CASE WHEN regexp_full_match(p_name, '[A-Za-z0-9]+') THEN p_name END, p_name FROM (SELECT replace(p_brand, '#', '') AS p_name FROM part)")
def experiment_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names that may stand for an experiment."""
    part = fx.table(spark, sf, "part")
    names = part.select(F.col("p_name").alias("name")).union(part.select(F.replace("p_brand", F.lit("#"), F.lit("")))).distinct()
    return names.select(derive.display_name(F.col("name")).alias("shown"), "name")


# --- a grid of 2.5 degrees, whose rows grow with the tables -------------------------------------

FINE_SQL = (
    "fcst_fine", "ana_fine", "clim_fine",
    "grid AS (SELECT CAST(y AS INT) AS lat_idx, CAST(x AS INT) AS lon_idx, -90.0 + 2.0*y AS lat, -180.0 + 2.5*x AS lon FROM range(91) a(y), range(144) b(x))", BOX_SQL, REGION_SQL,
    "cells AS (SELECT f.init_idx, f.lead, f.lat_idx, f.lon_idx, f.f, a.a, c.c, cos(radians(-90.0 + 2.0*f.lat_idx)) AS w FROM fcst_fine f LEFT JOIN ana_fine a ON a.lead = f.lead AND a.lat_idx = f.lat_idx AND a.lon_idx = f.lon_idx LEFT JOIN clim_fine c ON c.lat_idx = f.lat_idx AND c.lon_idx = f.lon_idx)",
    "rc AS (SELECT r.region, x.* FROM cells x JOIN region_cells r ON r.lat_idx = x.lat_idx AND r.lon_idx = x.lon_idx)",
)


@query("regional_fine", fx.with_sql(*FINE_SQL, two_pass("lead, region", "rc")) + f"SELECT lead, region, {s6(STAT_SQL['rms'], 'rms')}, {s6(STAT_SQL['acorr'], 'acorr')} FROM z")
def regional_fine(spark: SparkSession, sf: str) -> DataFrame:
    """Regional statistics on a fine grid."""
    g = make_grid(spark, 91, 144)
    cells = align.aligned(fx.view(spark, sf, "fcst_fine"), fx.view(spark, sf, "ana_fine"), fx.view(spark, sf, "clim_fine"), ("lead",), ())
    cells = align.with_weights(cells, g.select("lat_idx", "lon_idx", "grid_weight"))
    got = atoms.regional_by_atoms(cells, regions.box_cells(g), ["lead"], tuple(b[0] for b in catalog.BOX_REGIONS))
    return rounded(got, ["lead", "region"], ["rms", "acorr"])


@query("selected_variables", "SELECT l_orderkey, l_linenumber, round(l_quantity, 6) + 0.0 AS \"T\", round(l_tax, 6) + 0.0 AS \"Q\" FROM lineitem")
def selected_variables(spark: SparkSession, sf: str) -> DataFrame:
    """The wanted variables under their own names, found by alias in any case; only their columns are read."""
    wanted = {"T": ["temp", "L_QUANTITY"], "Q": ["shum", "l_tax"]}
    got = validate.select_variables(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], wanted)
    return got.select("l_orderkey", "l_linenumber", r6("T").alias("T"), r6("Q").alias("Q"))


@query("date_labels", "SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS day, strftime(o_orderdate, '%Y%m%d_%H') || 'z' AS file, strftime(o_orderdate, '%Y%m%d%H') AS hour FROM orders")
def date_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of dates on files and scorecards."""
    t = F.col("o_orderdate").cast("timestamp")
    return fx.table(spark, sf, "orders").select(*(v.alias(k) for k, v in calendar.date_labels(t).items())).distinct()
