"""Registered queries of the verification engine, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, derive
from ..functions.catalog import BOX_REGIONS, MASK_REGIONS, MODEL_LEVELS, SCORECARD_STATS
from ..functions.grid import window_size, with_cyclic_point
from ..operators import align, compare, regions, regrid, scorecard, statistics, validate
from ..streaming import incremental
from . import fixtures as fx

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
DECOMPOSITION = ("me", "mse", "rms", "rms_bar", "rms_amp", "rms_dis", "rms_dsp", "rms_phz", "rms_ran", "res1", "res2")
POINT_DECOMPOSITION = ("me", "mse", "rms_bar", "rms_amp", "rms_dis", "rms_dsp", "rms_phz", "res1")
#: A root of a difference that is zero but for rounding magnifies it: residuals are reported with fewer digits.
COARSE = {"res1": 4, "res2": 4, "rms_phz": 4, "f_c": 8}


def query(name: str, sql: str):
    def register(f):
        QUERIES[name] = f
        ORACLE[name] = sql
        return f

    return register


def r6(x: Column | str, digits: int = 6) -> Column:
    """Rounded, and never minus zero."""
    return F.round(x, digits) + F.lit(0.0)


def rounded(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    return df.select(*keys, *(r6(v, COARSE.get(v, 6)).alias(v) for v in values))


def s6(x: str, name: str, digits: int | None = None) -> str:
    return f"round({x}, {COARSE.get(name, 6) if digits is None else digits}) + 0.0 AS {name}"


def wm(x: str) -> str:
    return f"(sum(({x})*w) / nullif(sum(CASE WHEN ({x}) IS NOT NULL THEN w END), 0))"


BOX_SQL = "boxes(region, domain_name, north, south, east, west) AS (VALUES " + ", ".join(f"('{b[0]}','{b[1]}',{b[2]},{b[3]},{b[4]},{b[5]})" for b in BOX_REGIONS) + ")"
REGION_SQL = "region_cells AS (SELECT region, lat_idx, lon_idx FROM grid JOIN boxes ON lat BETWEEN south AND north AND (CASE WHEN west <= east THEN lon BETWEEN west AND east ELSE lon >= west OR lon <= east END))"


def two_pass(keys: str, source: str) -> str:
    """Oracle: means first, then the centred terms (two passes where Spark takes one)."""
    on = " AND ".join(f"s.{k} = m.{k}" for k in keys.split(", "))
    return f"""m AS (SELECT {keys}, {wm('f')} AS mf, {wm('a')} AS ma, {wm('c')} AS mc FROM {source} GROUP BY {keys}),
star AS (SELECT s.*, mf, ma, mc, f-mf AS fs, a-ma AS as_, c-mc AS cs FROM {source} s JOIN m ON {on}),
p AS (SELECT {keys}, {wm('f-a')} AS me, {wm('(f-a)*(f-a)')} AS mse, {wm('(fs-cs)*(as_-cs)')} AS cov, {wm('(fs-cs)*(fs-cs)')} AS fv, {wm('(as_-cs)*(as_-cs)')} AS av, {wm('(f-c)*(f-c)')} AS dd, {wm('(a-c)*(a-c)')} AS ee, {wm('f*f')} AS ff, {wm('a*a')} AS aa,
  abs(any_value(mf)-any_value(ma)) AS bar, sqrt({wm('fs*fs')}) AS sf, sqrt({wm('as_*as_')}) AS sa, {wm('fs*as_')} AS fa, sqrt({wm('(fs-as_)*(fs-as_)')}) AS ran, any_value(mf) AS mf FROM star GROUP BY {keys}),
q AS (SELECT *, CASE WHEN fv > 1e-13*dd AND av > 1e-13*ee THEN cov/(sqrt(fv)*sqrt(av)) END AS acorr, abs(sf-sa) AS amp,
  CASE WHEN sf*sf > 1e-13*ff AND sa*sa > 1e-13*aa THEN 2*(1 - fa/(sf*sa))*sf*sa END AS dsp FROM p),
z AS (SELECT *, CASE WHEN dsp >= 0 THEN sqrt(dsp) WHEN dsp > -1e-3 THEN 0.0 END AS phz FROM q)"""


STAT_SQL = {
    "me": "me", "mse": "mse", "rms": "sqrt(mse)", "acorr": "acorr", "rms_bar": "bar", "rms_amp": "amp", "rms_dis": "(sf-sa)*(sf-sa) + bar*bar",
    "rms_dsp": "dsp", "rms_phz": "phz", "rms_ran": "ran", "res1": "sqrt(abs(mse - bar*bar - amp*amp - phz*phz))", "res2": "sqrt(abs(mse - bar*bar - ran*ran))",
}
REGIONAL = ("fcst", "ana", "clim_raw", fx.GRID_SQL, BOX_SQL, REGION_SQL, fx.cells_sql(), "rc AS (SELECT r.region, x.* FROM cells x JOIN region_cells r ON r.lat_idx = x.lat_idx AND r.lon_idx = x.lon_idx)")
RKEYS = ["init_idx", "lead", "region"]


def _regional_sql(stats: tuple[str, ...]) -> str:
    return fx.with_sql(*REGIONAL, two_pass("init_idx, lead, region", "rc")) + "SELECT init_idx, lead, region, " + ", ".join(s6(STAT_SQL[s], s) for s in stats) + " FROM z"


def _regional(spark: SparkSession, sf: str, stats: tuple[str, ...]) -> DataFrame:
    cells = align.by_region(fx.trio(spark, sf), regions.box_cells(fx.grid(spark)))
    return statistics.regional(cells, RKEYS, stats)


@query("regional_rms_acorr", _regional_sql(("rms", "acorr")))
def regional_rms_acorr(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: RMSE and anomaly correlation by date, lead and region."""
    return rounded(_regional(spark, sf, ("rms", "acorr")), RKEYS, ["rms", "acorr"])


@query("regional_decomposition", _regional_sql(DECOMPOSITION))
def regional_decomposition(spark: SparkSession, sf: str) -> DataFrame:
    """The error decomposition by date, lead and region."""
    return rounded(_regional(spark, sf, DECOMPOSITION), RKEYS, list(DECOMPOSITION))


@query("regional_avg", fx.with_sql(*REGIONAL, two_pass("init_idx, lead, region", "rc")) + "SELECT lead, region, round(avg(sqrt(mse)), 6) + 0.0 AS rms_avg, round(avg(acorr), 6) + 0.0 AS acorr_avg FROM z GROUP BY lead, region")
def regional_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Averages over dates."""
    got = statistics.averaged(_regional(spark, sf, ("rms", "acorr")), ["lead", "region"], ["rms", "acorr"])
    return rounded(got, ["lead", "region"], ["rms_avg", "acorr_avg"])


SIZE = window_size(15.0)
PKEYS = ["init_idx", "lead", "lat_idx", "lon_idx"]
POINT = (
    "fcst", "ana", "clim_raw", fx.GRID_SQL, fx.cells_sql(),
    "dense AS (SELECT k.init_idx, k.lead, g.lat_idx, g.lon_idx, g.w, x.f, x.a, x.c FROM (SELECT DISTINCT init_idx, lead FROM cells) k CROSS JOIN grid g LEFT JOIN cells x ON x.init_idx = k.init_idx AND x.lead = k.lead AND x.lat_idx = g.lat_idx AND x.lon_idx = g.lon_idx)",
    f"near AS (SELECT o.init_idx, o.lead, o.lat_idx, o.lon_idx, n.f, n.a, n.c, n.w FROM dense o JOIN dense n ON n.init_idx = o.init_idx AND n.lead = o.lead AND n.lat_idx BETWEEN o.lat_idx - {SIZE // 2} AND o.lat_idx + {SIZE // 2} AND n.lon_idx BETWEEN o.lon_idx - {SIZE // 2} AND o.lon_idx + {SIZE // 2})",
    f"enough AS (SELECT init_idx, lead, lat_idx, lon_idx FROM near GROUP BY ALL HAVING least(count(f), count(a), count(c)) >= {int(SIZE * SIZE * 0.5)})",
    two_pass("init_idx, lead, lat_idx, lon_idx", "near"),
)


def _point_sql(stats: tuple[str, ...]) -> str:
    cols = ", ".join(s6(f"CASE WHEN e.lead IS NOT NULL THEN {STAT_SQL[s]} END", s) for s in stats)
    return fx.with_sql(*POINT) + f"SELECT d.init_idx, d.lead, d.lat_idx, d.lon_idx, round(d.f, 6) + 0.0 AS f, round(d.a, 6) + 0.0 AS a, round(d.f - d.c, 8) + 0.0 AS f_c, {cols} FROM dense d JOIN (SELECT * EXCLUDE (mf) FROM z) z USING (init_idx, lead, lat_idx, lon_idx) LEFT JOIN enough e ON e.init_idx = d.init_idx AND e.lead = d.lead AND e.lat_idx = d.lat_idx AND e.lon_idx = d.lon_idx"


def _dense(spark: SparkSession, sf: str) -> DataFrame:
    g = fx.grid(spark).select("lat_idx", "lon_idx", "grid_weight")
    return statistics.dense(fx.trio(spark, sf).drop("grid_weight"), ["init_idx", "lead"], g, ["f", "a", "c"])


@query("point_window_rms_acorr", _point_sql(("rms", "acorr")))
def point_window_rms_acorr(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics in a moving window around every cell."""
    return rounded(statistics.pointwise(_dense(spark, sf), ["init_idx", "lead"], SIZE), PKEYS, ["f", "a", "f_c", "rms", "acorr"])


@query("point_window_decomposition", _point_sql(POINT_DECOMPOSITION))
def point_window_decomposition(spark: SparkSession, sf: str) -> DataFrame:
    """The error decomposition in a moving window (W7); mse is the mean square error throughout."""
    return rounded(statistics.pointwise(_dense(spark, sf), ["init_idx", "lead"], SIZE, POINT_DECOMPOSITION), PKEYS, ["f", "a", "f_c", *POINT_DECOMPOSITION])


POINT_STATS = fx.with_sql(*POINT, "pt AS (SELECT z.init_idx, z.lead, z.lat_idx, z.lon_idx, CASE WHEN e.lead IS NOT NULL THEN sqrt(mse) END AS rms, CASE WHEN e.lead IS NOT NULL THEN acorr END AS acorr FROM z LEFT JOIN enough e USING (init_idx, lead, lat_idx, lon_idx))", "pavg AS (SELECT lead, lat_idx, lon_idx, avg(rms) AS rms_avg, avg(acorr) AS acorr_avg FROM pt GROUP BY ALL)")
MKEYS = ["lead", "lat_idx", "lon_idx"]


def _point_stats(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.pointwise(_dense(spark, sf), ["init_idx", "lead"], SIZE)


def _point_avg(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.averaged(_point_stats(spark, sf), MKEYS, ["rms", "acorr"])


@query("point_avg", POINT_STATS + "SELECT lead, lat_idx, lon_idx, round(rms_avg, 6) + 0.0 AS rms_avg, round(acorr_avg, 6) + 0.0 AS acorr_avg FROM pavg")
def point_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Averages of maps over dates."""
    return rounded(_point_avg(spark, sf), MKEYS, ["rms_avg", "acorr_avg"])


@query("global_mean_of_avg", POINT_STATS + f"SELECT lead, {s6(wm('rms_avg'), 'rms_glo')}, {s6(wm('acorr_avg'), 'acorr_glo')} FROM pavg JOIN (SELECT lat_idx, lon_idx, cos(radians(-90.0 + 15.0*lat_idx)) AS w FROM (SELECT DISTINCT lat_idx, lon_idx FROM pt)) USING (lat_idx, lon_idx) GROUP BY lead")
def global_mean_of_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted global means of averaged maps."""
    weights = F.broadcast(fx.grid(spark).select("lat_idx", "lon_idx", F.col("grid_weight").alias("weight")))
    return rounded(statistics.global_mean(_point_avg(spark, sf), weights, ["lead"], ["rms_avg", "acorr_avg"]), ["lead"], ["rms_glo", "acorr_glo"])


@query("enhanced_weights_dataset", fx.with_sql("fcst", "ana", "clim_raw", fx.GRID_SQL, "cc AS (SELECT lat_idx, lon_idx, count(*) AS n FROM clim_raw GROUP BY ALL)", "ff AS (SELECT lat_idx, lon_idx, count(*) AS n FROM fcst GROUP BY ALL)", "aa AS (SELECT lat_idx, lon_idx, count(*) AS n FROM ana GROUP BY ALL)") + "SELECT g.lat_idx, g.lon_idx, round(CASE WHEN ff.n >= (SELECT count(*) FROM (SELECT DISTINCT init_idx, lead FROM fcst)) AND aa.n >= (SELECT count(DISTINCT t_idx) FROM ana) AND cc.n >= (SELECT count(*) FROM (SELECT DISTINCT cycle, month FROM clim_raw)) THEN w END, 6) + 0.0 AS weight FROM grid g LEFT JOIN ff USING (lat_idx, lon_idx) LEFT JOIN aa USING (lat_idx, lon_idx) LEFT JOIN cc USING (lat_idx, lon_idx)")
def enhanced_weights_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Weights without the cells that any field lacks at any time."""
    fields = [(fx.view(spark, sf, "fcst"), ["init_idx", "lead"], "f"), (fx.view(spark, sf, "ana"), ["t_idx"], "a")]
    fields.append((fx.view(spark, sf, "clim_raw"), ["cycle", "month"], "c"))
    return rounded(statistics.dataset_weights(fields, fx.grid(spark)), ["lat_idx", "lon_idx"], ["weight"])


@query("enhanced_weights_statistic", POINT_STATS + "SELECT lead, lat_idx, lon_idx, round(CASE WHEN NOT bool_or(rms IS NULL) THEN cos(radians(-90.0 + 15.0*lat_idx)) END, 6) + 0.0 AS weight FROM pt GROUP BY lead, lat_idx, lon_idx")
def enhanced_weights_statistic(spark: SparkSession, sf: str) -> DataFrame:
    """Weights without the cells where a statistic is missing at any date."""
    got = statistics.statistic_weights(_point_stats(spark, sf), "rms", fx.grid(spark))
    return rounded(got, MKEYS, ["weight"])


@query("chunk_merge", fx.with_sql(*REGIONAL, two_pass("init_idx, lead, region", "rc")) + "SELECT init_idx, lead, region, stat, round(value, 6) + 0.0 AS value FROM (SELECT init_idx, lead, region, sqrt(mse) AS rms, acorr FROM z) UNPIVOT INCLUDE NULLS (value FOR stat IN (rms, acorr))")
def chunk_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of separate date ranges together equal those of all dates."""
    parts = []
    for lo, hi in ((0, 1), (2, 4)):
        cells = validate.date_range(fx.trio(spark, sf), lo, hi)
        parts.append(statistics.regional(align.by_region(cells, regions.box_cells(fx.grid(spark))), RKEYS))
    long = statistics.long_statistics(validate.chunks_merged(parts, RKEYS, "init_idx"), RKEYS, ["rms", "acorr"])
    return rounded(long, [*RKEYS, "stat"], ["value"])


LAND_SQL = "land AS (SELECT g.lat_idx, g.lon_idx FROM grid g JOIN mask_src m ON m.lat_idx = 2*g.lat_idx AND m.lon_idx = CASE WHEN g.lon_idx >= 12 THEN 2*(g.lon_idx - 12) ELSE 2*g.lon_idx + 24 END WHERE land = 1 AND g.lon_idx > 0)"


@query("region_cells", fx.with_sql("mask_src", fx.GRID_SQL, BOX_SQL, REGION_SQL, LAND_SQL, "boxed AS (SELECT region, lat_idx, lon_idx FROM region_cells UNION ALL SELECT 'LND', lat_idx, lon_idx FROM land)") + "SELECT * FROM boxed UNION ALL SELECT n.i, b.lat_idx, b.lon_idx FROM boxed b JOIN (VALUES ('NHL','NHE'),('TRL','TRO'),('SHL','SHE')) n(i, r) ON n.r = b.region JOIN land l ON l.lat_idx = b.lat_idx AND l.lon_idx = b.lon_idx")
def region_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of all regions: boxes, land by the nearest mask, intersections."""
    land = regrid.nearest_mask(fx.view(spark, sf, "mask_src"), (25, 48), (13, 24), "land")
    names = (*(b[0] for b in BOX_REGIONS), "LND", "NHL", "TRL", "SHL")
    return regions.cells_of_regions(fx.grid(spark), {"LND": land}, names)


@query("region_coverage", fx.with_sql("fcst", fx.GRID_SQL, BOX_SQL, REGION_SQL) + "SELECT r.region, count(DISTINCT (r.lat_idx, r.lon_idx)) AS n_cells, round(count(DISTINCT (r.lat_idx, r.lon_idx)) / 312.0, 6) + 0.0 AS fraction, count(f.f) AS n_values FROM region_cells r LEFT JOIN fcst f ON f.lat_idx = r.lat_idx AND f.lon_idx = r.lon_idx GROUP BY r.region")
def region_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Cells, covered fraction, and forecast values of every region (K4)."""
    cells = regions.box_cells(fx.grid(spark))
    values = align.by_region(fx.view(spark, sf, "fcst"), cells).groupBy("region").agg(F.count("f").alias("n_values"))
    got = regions.coverage(cells, fx.grid(spark)).join(values, "region", "left")
    return got.select("region", "n_cells", r6("fraction").alias("fraction"), F.coalesce("n_values", F.lit(0)).alias("n_values"))
