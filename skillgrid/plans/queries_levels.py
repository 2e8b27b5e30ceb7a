"""Registered queries: variables with levels and without through the whole chain, region atoms, tiled windows, SI units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.catalog import BOX_REGIONS
from ..functions.grid import grid as make_grid
from ..functions.grid import window_size
from ..functions.moments import with_shift
from ..operators import align, atoms, regions, statistics, tiles
from . import fixtures as fx
from .queries import BOX_SQL, DECOMPOSITION, REGION_SQL, REGIONAL, RKEYS, SIZE, STAT_SQL, _regional_sql, query, r6, rounded, s6, two_pass, wm
from .queries_checks import FINE_SQL

NAMES = tuple(b[0] for b in BOX_REGIONS)
MIXED = ("mixed", "ana_mixed", "clim_mixed", fx.MIXED_SQL)


@query("mixed_aligned", fx.with_sql(*MIXED) + "SELECT var, lev, lead, count(*) AS n, count(a) AS n_a, count(c) AS n_c, round(sum(f), 6) + 0.0 AS f, round(sum(a), 6) + 0.0 AS a, round(sum(c), 6) + 0.0 AS c FROM mcells GROUP BY 1, 2, 3")
def mixed_aligned(spark: SparkSession, sf: str) -> DataFrame:
    """Variables with levels and without in one frame, each with its analysis and climatology."""
    got = fx.mixed(spark, sf).groupBy("var", "lev", "lead")
    return got.agg(F.count("*").alias("n"), F.count("a").alias("n_a"), F.count("c").alias("n_c"), *(r6(F.sum(x)).alias(x) for x in "fac"))


# levels take part in group keys, null among them
MREG = (*MIXED, fx.GRID_SQL, BOX_SQL, REGION_SQL, "mrc AS (SELECT r.region, x.* EXCLUDE (lev), coalesce(lev, -1) AS lev FROM mcells x JOIN region_cells r ON r.lat_idx = x.lat_idx AND r.lon_idx = x.lon_idx)")


@query("mixed_regional", fx.with_sql(*MREG, two_pass("init_idx, lead, var, lev, region", "mrc")) + f"SELECT init_idx, lead, var, nullif(lev, -1) AS lev, region, {s6(STAT_SQL['rms'], 'rms')}, {s6(STAT_SQL['acorr'], 'acorr')} FROM z")
def mixed_regional(spark: SparkSession, sf: str) -> DataFrame:
    """Regional statistics by variable and level, 2-D variables with a null level (J1-J3, A5), summed by region atoms."""
    keys = ["init_idx", "lead", "var", "lev"]
    got = atoms.regional_by_atoms(fx.mixed(spark, sf), regions.box_cells(fx.grid(spark)), keys, NAMES)
    return rounded(got, [*keys, "region"], ["rms", "acorr"])


MPOINT = (
    *MIXED, fx.GRID_SQL, "mc AS (SELECT * EXCLUDE (lev), coalesce(lev, -1) AS lev FROM mcells)",
    "mdense AS (SELECT k.init_idx, k.lead, k.var, k.lev, g.lat_idx, g.lon_idx, g.w, x.f, x.a, x.c FROM (SELECT DISTINCT init_idx, lead, var, lev FROM mc) k CROSS JOIN grid g LEFT JOIN mc x ON x.init_idx = k.init_idx AND x.lead = k.lead AND x.var = k.var AND x.lev = k.lev AND x.lat_idx = g.lat_idx AND x.lon_idx = g.lon_idx)",
    f"mnear AS (SELECT o.init_idx, o.lead, o.var, o.lev, o.lat_idx, o.lon_idx, n.f, n.a, n.c, n.w FROM (SELECT d.*, d.lat_idx + dy AS ny, d.lon_idx + dx AS nx FROM mdense d, range(-{SIZE // 2}, {SIZE // 2 + 1}) p(dy), range(-{SIZE // 2}, {SIZE // 2 + 1}) q(dx)) o JOIN mdense n ON n.init_idx = o.init_idx AND n.lead = o.lead AND n.var = o.var AND n.lev = o.lev AND n.lat_idx = o.ny AND n.lon_idx = o.nx)",
    f"menough AS (SELECT init_idx, lead, var, lev, lat_idx, lon_idx FROM mnear GROUP BY ALL HAVING least(count(f), count(a), count(c)) >= {int(SIZE * SIZE * 0.5)})",
    two_pass("init_idx, lead, var, lev, lat_idx, lon_idx", "mnear"),
    "mpt AS (SELECT z.init_idx, z.lead, z.var, z.lev, z.lat_idx, z.lon_idx, CASE WHEN e.lead IS NOT NULL THEN sqrt(mse) END AS rms, CASE WHEN e.lead IS NOT NULL THEN acorr END AS acorr FROM z LEFT JOIN menough e USING (init_idx, lead, var, lev, lat_idx, lon_idx))",
)
MPKEYS = ["init_idx", "lead", "var", "lev"]


def _mixed_maps(spark: SparkSession, sf: str) -> DataFrame:
    g = fx.grid(spark).select("lat_idx", "lon_idx", "grid_weight")
    dense = statistics.dense(fx.mixed(spark, sf).drop("grid_weight"), MPKEYS, g, ["f", "a", "c"])
    return tiles.tiled(dense, MPKEYS, SIZE, tile=12)


@query("mixed_point_avg", fx.with_sql(*MPOINT) + "SELECT lead, var, nullif(lev, -1) AS lev, lat_idx, lon_idx, round(avg(rms), 6) + 0.0 AS rms_avg, round(avg(acorr), 6) + 0.0 AS acorr_avg FROM mpt GROUP BY lead, var, lev, lat_idx, lon_idx")
def mixed_point_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Averaged maps by variable and level from tiled windows."""
    keys = ["lead", "var", "lev", "lat_idx", "lon_idx"]
    return rounded(statistics.averaged(_mixed_maps(spark, sf), keys, ["rms", "acorr"]), keys, ["rms_avg", "acorr_avg"])


MW_SQL = "mw AS (SELECT lead, lev, lat_idx, lon_idx, CASE WHEN NOT bool_or(rms IS NULL) THEN cos(radians(-90.0 + 15.0*lat_idx)) END AS w FROM mpt GROUP BY lead, lev, lat_idx, lon_idx)"


@query("mixed_global_mean", fx.with_sql(*MPOINT, MW_SQL, "mavg AS (SELECT lead, var, lev, lat_idx, lon_idx, avg(rms) AS rms, avg(acorr) AS acorr FROM mpt GROUP BY ALL)") + f"SELECT lead, var, nullif(lev, -1) AS lev, {s6(wm('rms'), 'rms_glo')}, {s6(wm('acorr'), 'acorr_glo')} FROM mavg JOIN mw USING (lead, lev, lat_idx, lon_idx) GROUP BY lead, var, lev")
def mixed_global_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Global means by level with enhanced weights by level and by kind, from a 3-D and a 2-D sample."""
    maps = _mixed_maps(spark, sf)
    weights = statistics.statistic_weights(statistics.sample_rows(maps, ("T", "T2M")), "rms", fx.grid(spark))
    averages = statistics.averaged(maps, ["lead", "var", "lev", "lat_idx", "lon_idx"], ["rms", "acorr"])
    got = statistics.global_mean(averages, weights, ["lead", "var", "lev"], ["rms_avg", "acorr_avg"])
    return rounded(got, ["lead", "var", "lev"], ["rms_glo", "acorr_glo"])


_HAVE = "SELECT coalesce(lev, -1) AS lev, lat_idx, lon_idx, count(*) AS n FROM {t} GROUP BY 1, 2, 3"
_ALL = "SELECT coalesce(lev, -1) AS lev, count(DISTINCT ({k})) AS n FROM {t} GROUP BY 1"


@query("mixed_dataset_weights", fx.with_sql("mixed", "ana_mixed", "clim_mixed", fx.GRID_SQL, *(f"h{t[0]} AS ({_HAVE.format(t=t)}), n{t[0]} AS ({_ALL.format(t=t, k=k)})" for t, k in (("mixed", "init_idx, lead"), ("ana_mixed", "t_idx"), ("clim_mixed", "cycle")))) + "SELECT g.lat_idx, g.lon_idx, nullif(l.lev, -1) AS lev, round(CASE WHEN coalesce(hm.n, 0) >= nm.n AND coalesce(ha.n, 0) >= na.n AND coalesce(hc.n, 0) >= nc.n THEN w END, 6) + 0.0 AS weight FROM grid g CROSS JOIN (SELECT DISTINCT lev FROM nm) l JOIN nm USING (lev) JOIN na USING (lev) JOIN nc USING (lev) LEFT JOIN hm USING (lev, lat_idx, lon_idx) LEFT JOIN ha USING (lev, lat_idx, lon_idx) LEFT JOIN hc USING (lev, lat_idx, lon_idx)")
def mixed_dataset_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Weights by level without the cells that a 3-D or a 2-D sample lacks at any time in any field."""
    names, samples = (("mixed", ["init_idx", "lead"], "f"), ("ana_mixed", ["t_idx"], "a"), ("clim_mixed", ["cycle"], "c")), ("T", "T2M")
    found = [(statistics.sample_rows(fx.view(spark, sf, n), samples), times, x) for n, times, x in names]
    return rounded(statistics.dataset_weights(found, fx.grid(spark)), ["lat_idx", "lon_idx", "lev"], ["weight"])


@query("regional_by_atoms", _regional_sql(DECOMPOSITION))
def regional_by_atoms(spark: SparkSession, sf: str) -> DataFrame:
    """The regional decomposition with sums by region atoms: one row a cell before the shuffle."""
    got = atoms.regional_by_atoms(fx.trio(spark, sf), regions.box_cells(fx.grid(spark)), ["init_idx", "lead"], NAMES, DECOMPOSITION)
    return rounded(got, RKEYS, list(DECOMPOSITION))


SI = tuple(p.replace("f.f, a.a, c.c,", "f.f + 101325.0 AS f, a.a + 101325.0 AS a, c.c + 101325.0 AS c,") for p in REGIONAL)
SI_STATS = ("rms", "acorr", "rms_bar", "rms_amp", "rms_dis", "rms_dsp", "rms_ran")


@query("regional_si_units", fx.with_sql(*SI, two_pass("init_idx, lead, region", "rc")) + "SELECT init_idx, lead, region, " + ", ".join(s6(STAT_SQL[s], s, 6) for s in SI_STATS) + " FROM z")
def regional_si_units(spark: SparkSession, sf: str) -> DataFrame:
    """The decomposition of pressures in Pa, whose spread is a ten-thousandth of their size: sums are of values less a constant."""
    cells = fx.trio(spark, sf).withColumns({v: F.col(v) + 101325.0 for v in "fac"})
    got = atoms.regional_by_atoms(with_shift(cells, []), regions.box_cells(fx.grid(spark)), ["init_idx", "lead"], NAMES, SI_STATS, shift=True)
    return got.select(*RKEYS, *(r6(s).alias(s) for s in SI_STATS))


FINE_SIZE = window_size(2.5)
_H = FINE_SIZE // 2
FINE_POINT = (
    *FINE_SQL[:3], "fgrid AS (SELECT CAST(y AS INT) AS lat_idx, CAST(x AS INT) AS lon_idx, cos(radians(-90.0 + 2.0*y)) AS w FROM range(91) a(y), range(144) b(x))",
    "fmax AS (SELECT lead, lat_idx, lon_idx, max(f) AS f FROM fcst_fine GROUP BY 1, 2, 3)",
    "fdense AS (SELECT k.lead, g.lat_idx, g.lon_idx, g.w, x.f, a.a, c.c FROM (SELECT DISTINCT lead FROM fmax) k CROSS JOIN fgrid g LEFT JOIN fmax x ON x.lead = k.lead AND x.lat_idx = g.lat_idx AND x.lon_idx = g.lon_idx LEFT JOIN ana_fine a ON a.lead = x.lead AND a.lat_idx = x.lat_idx AND a.lon_idx = x.lon_idx LEFT JOIN clim_fine c ON c.lat_idx = x.lat_idx AND c.lon_idx = x.lon_idx)",
    f"fnear AS (SELECT o.lead, o.lat_idx, o.lon_idx, n.f, n.a, n.c, n.w FROM (SELECT d.lead, d.lat_idx, d.lon_idx, d.lat_idx + dy AS ny, d.lon_idx + dx AS nx FROM fdense d, range(-{_H}, {_H + 1}) p(dy), range(-{_H}, {_H + 1}) q(dx)) o JOIN fdense n ON n.lead = o.lead AND n.lat_idx = o.ny AND n.lon_idx = o.nx)",
    f"fenough AS (SELECT lead, lat_idx, lon_idx FROM fnear GROUP BY ALL HAVING least(count(f), count(a), count(c)) >= {int(FINE_SIZE * FINE_SIZE * 0.5)})",
    two_pass("lead, lat_idx, lon_idx", "fnear"),
)


@query("point_window_fine", fx.with_sql(*FINE_POINT) + f"SELECT z.lead, z.lat_idx, z.lon_idx, {s6('CASE WHEN e.lead IS NOT NULL THEN sqrt(mse) END', 'rms')}, {s6('CASE WHEN e.lead IS NOT NULL THEN acorr END', 'acorr')} FROM z LEFT JOIN fenough e USING (lead, lat_idx, lon_idx)")
def point_window_fine(spark: SparkSession, sf: str) -> DataFrame:
    """Windows on a grid of 91 x 144 cells by tiles, so that one map is many tasks."""
    g = make_grid(spark, 91, 144).select("lat_idx", "lon_idx", "grid_weight")
    highest = fx.view(spark, sf, "fcst_fine").groupBy("lead", "lat_idx", "lon_idx").agg(F.max("f").alias("f"))
    cells = align.aligned(highest, fx.view(spark, sf, "ana_fine"), fx.view(spark, sf, "clim_fine"), ("lead",), ())
    dense = statistics.dense(cells, ["lead"], g, ["f", "a", "c"])
    keys = ["lead", "lat_idx", "lon_idx"]
    return rounded(tiles.tiled(dense, ["lead"], FINE_SIZE, tile=32), keys, ["rms", "acorr"])
