"""Gridded views over the tables of the driver, for Spark and for SQL alike.

The grid has 13 x 24 cells of 15 degrees. Cell values are maxima and minima, so they do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import grid as make_grid

N_LAT, N_LON = 13, 24
MASK_LAT, MASK_LON = 25, 48

_CELL = "CAST(l_partkey % 13 AS INT) AS lat_idx, CAST(l_suppkey % 24 AS INT) AS lon_idx"
_F = f"SELECT CAST(l_orderkey % 5 AS INT) AS init_idx, CAST(12*(l_linenumber % 3) AS INT) AS lead, {_CELL}"
_LEV = "CAST(CASE CAST(l_quantity AS INT) % 3 WHEN 0 THEN 1000 WHEN 1 THEN 850 ELSE 500 END AS INT)"
#: View name: (table, SQL); the text runs in both engines.
VIEWS = {
    "fcst": ("lineitem", f"{_F}, MAX(l_quantity) + 10*MAX(l_tax) AS f FROM lineitem GROUP BY 1,2,3,4"),
    "fcst2": ("lineitem", f"{_F}, MAX(l_quantity) - 10*MIN(l_tax) AS f FROM lineitem GROUP BY 1,2,3,4"),
    "fcst3": ("lineitem", f"{_F}, CAST(CASE CAST(l_quantity AS INT) % 3 WHEN 0 THEN 1000 WHEN 1 THEN 850 ELSE 500 END AS INT) AS lev, MAX(l_extendedprice)/1000 AS f FROM lineitem GROUP BY 1,2,3,4,5"),
    # on 91 x 144 cells: as many rows as lineitem has, nearly
    "fcst_fine": ("lineitem", "SELECT CAST(l_orderkey % 31 AS INT) AS init_idx, CAST(12*(l_linenumber % 7) AS INT) AS lead, CAST((l_orderkey + l_partkey) % 91 AS INT) AS lat_idx, CAST((7*l_suppkey + l_partkey) % 144 AS INT) AS lon_idx, MAX(l_quantity) + 10*MAX(l_tax) AS f FROM lineitem GROUP BY 1,2,3,4"),
    "ana_fine": ("lineitem", "SELECT CAST(12*(l_linenumber % 7) AS INT) AS lead, CAST((l_orderkey + l_partkey) % 91 AS INT) AS lat_idx, CAST((7*l_suppkey + l_partkey) % 144 AS INT) AS lon_idx, MIN(l_quantity) + 10*MAX(l_discount) AS a FROM lineitem GROUP BY 1,2,3"),
    "clim_fine": ("lineitem", "SELECT CAST((l_orderkey + l_partkey) % 91 AS INT) AS lat_idx, CAST((7*l_suppkey + l_partkey) % 144 AS INT) AS lon_idx, MAX(l_discount)*100 AS c FROM lineitem GROUP BY 1,2"),
    "ana": ("lineitem", f"SELECT CAST(l_orderkey % 11 AS INT) AS t_idx, {_CELL}, MIN(l_quantity) + 10*MAX(l_discount) AS a FROM lineitem GROUP BY 1,2,3"),
    "clim_raw": ("orders", "SELECT CAST(12*(o_orderkey % 2) AS INT) AS cycle, CAST(EXTRACT(month FROM o_orderdate) AS INT) AS month, CAST(o_orderkey % 13 AS INT) AS lat_idx, CAST(o_custkey % 24 AS INT) AS lon_idx, MAX(o_totalprice)/20000 AS c FROM orders GROUP BY 1,2,3,4"),
    "exp_stats": ("events", "SELECT CAST(user_id % 3 AS INT) AS experiment, CAST(EXTRACT(day FROM ts) AS INT) AS init_day, CAST(12*(event_id % 4) AS INT) AS lead, MAX(value)/500 AS acorr, MAX(value) - MIN(value) AS rms FROM events GROUP BY 1,2,3"),
    "mask_src": ("part", "SELECT CAST(p_partkey % 25 AS INT) AS lat_idx, CAST(CAST(floor(p_partkey/25.0) AS BIGINT) % 48 AS INT) AS lon_idx, CAST(MAX(CASE WHEN p_size > 25 THEN 1 ELSE 0 END) AS INT) AS land FROM part GROUP BY 1,2"),
    "multilead": ("orders", "SELECT CAST(o_custkey % 7 AS INT) AS init_idx, o_orderdate AS valid_time, MAX(o_totalprice) AS v FROM orders GROUP BY 1,2"),
    # variables with levels and without in one frame: T at three levels, T2M with lev null
    "mixed": ("lineitem", f"SELECT init_idx, lead, 'T' AS var, lev, lat_idx, lon_idx, f FROM ({_F}, {_LEV} AS lev, MAX(l_extendedprice)/1000 AS f FROM lineitem GROUP BY 1,2,3,4,5) x UNION ALL SELECT init_idx, lead, 'T2M', CAST(NULL AS INT), lat_idx, lon_idx, f FROM ({_F}, MAX(l_quantity) + 10*MAX(l_tax) AS f FROM lineitem GROUP BY 1,2,3,4) y"),
    "ana_mixed": ("lineitem", f"SELECT t_idx, 'T' AS var, lev, lat_idx, lon_idx, a FROM (SELECT CAST(l_orderkey % 11 AS INT) AS t_idx, {_CELL}, {_LEV} AS lev, MIN(l_extendedprice)/1000 AS a FROM lineitem GROUP BY 1,2,3,4) x UNION ALL SELECT t_idx, 'T2M', CAST(NULL AS INT), lat_idx, lon_idx, a FROM (SELECT CAST(l_orderkey % 11 AS INT) AS t_idx, {_CELL}, MIN(l_quantity) + 10*MAX(l_discount) AS a FROM lineitem GROUP BY 1,2,3) y"),
    "clim_mixed": ("lineitem", f"SELECT cycle, 'T' AS var, lev, lat_idx, lon_idx, c FROM (SELECT CAST(12*(l_orderkey % 2) AS INT) AS cycle, {_CELL}, {_LEV} AS lev, MIN(l_tax)*100 + MAX(l_quantity) AS c FROM lineitem GROUP BY 1,2,3,4) x UNION ALL SELECT cycle, 'T2M', CAST(NULL AS INT), lat_idx, lon_idx, c FROM (SELECT CAST(12*(l_orderkey % 2) AS INT) AS cycle, {_CELL}, MAX(l_discount)*300 AS c FROM lineitem GROUP BY 1,2,3) y"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the gridded views."""
    source, sql = VIEWS[name]
    return spark.sql(sql.replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: table(spark, sf_dir, source)})


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned cells (init_idx, lead, var, lev, lat_idx, lon_idx, f, a, c, grid_weight) of variables with levels and without."""
    from ..operators.align import aligned, with_weights

    fcst = view(spark, sf_dir, "mixed").withColumns({"t_idx": F.col("init_idx") * 2 + (F.col("lead") / 12).cast("int"), "cycle": F.col("lead") % 24})
    cells = aligned(fcst, view(spark, sf_dir, "ana_mixed"), view(spark, sf_dir, "clim_mixed"), ("t_idx",), ("cycle",))
    return with_weights(cells, grid(spark).select("lat_idx", "lon_idx", "grid_weight")).drop("t_idx", "cycle")


def grid(spark: SparkSession) -> DataFrame:
    return make_grid(spark, N_LAT, N_LON)


def trio(spark: SparkSession, sf_dir: str, forecast: str = "fcst") -> DataFrame:
    """Aligned cells (init_idx, lead, lat_idx, lon_idx, f, a, c, grid_weight)."""
    return trio_of(spark, sf_dir, view(spark, sf_dir, forecast))


def trio_of(spark: SparkSession, sf_dir: str, fcst: DataFrame) -> DataFrame:
    """The same of any forecast cells (init_idx, lead, lat_idx, lon_idx, f)."""
    from ..operators.align import aligned, with_weights

    fcst = fcst.withColumns({"t_idx": F.col("init_idx") * 2 + (F.col("lead") / 12).cast("int"), "cycle": F.col("lead") % 24, "month": F.lit(5)})
    cells = aligned(fcst, view(spark, sf_dir, "ana"), view(spark, sf_dir, "clim_raw"), ("t_idx",), ("cycle", "month"))
    return with_weights(cells, grid(spark).select("lat_idx", "lon_idx", "grid_weight")).drop("t_idx", "cycle", "month")


# --- the same in SQL ---------------------------------------------------------------------------

GRID_SQL = "grid AS (SELECT CAST(y AS INT) AS lat_idx, CAST(x AS INT) AS lon_idx, -90.0 + 15.0*y AS lat, -180.0 + 15.0*x AS lon, cos(radians(-90.0 + 15.0*y)) AS w FROM range(13) a(y), range(24) b(x))"


def cells_sql(forecast: str = "fcst", name: str = "cells") -> str:
    return f"""{name} AS (SELECT f.init_idx, f.lead, f.lat_idx, f.lon_idx, f.f, a.a, c.c, cos(radians(-90.0 + 15.0*f.lat_idx)) AS w
 FROM {forecast} f LEFT JOIN ana a ON a.t_idx = f.init_idx*2 + CAST(f.lead/12 AS INT) AND a.lat_idx = f.lat_idx AND a.lon_idx = f.lon_idx
 LEFT JOIN clim_raw c ON c.cycle = f.lead % 24 AND c.month = 5 AND c.lat_idx = f.lat_idx AND c.lon_idx = f.lon_idx)"""


MIXED_SQL = """mcells AS (SELECT f.init_idx, f.lead, f.var, f.lev, f.lat_idx, f.lon_idx, f.f, a.a, c.c, cos(radians(-90.0 + 15.0*f.lat_idx)) AS w
 FROM mixed f LEFT JOIN ana_mixed a ON a.t_idx = f.init_idx*2 + CAST(f.lead/12 AS INT) AND a.var = f.var AND a.lev IS NOT DISTINCT FROM f.lev AND a.lat_idx = f.lat_idx AND a.lon_idx = f.lon_idx
 LEFT JOIN clim_mixed c ON c.cycle = f.lead % 24 AND c.var = f.var AND c.lev IS NOT DISTINCT FROM f.lev AND c.lat_idx = f.lat_idx AND c.lon_idx = f.lon_idx)"""


def with_sql(*parts: str) -> str:
    """WITH clause of views by name and of further expressions as they are."""
    return "WITH " + ",\n".join(f"{p} AS ({VIEWS[p][1]})" if p in VIEWS else p for p in parts) + "\n"
