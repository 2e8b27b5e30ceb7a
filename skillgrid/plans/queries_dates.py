"""Registered queries: dates as bitmaps, dates in paths, cells laid out by bucket, digits on scorecards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, derive
from ..operators import datesets
from ..sources import fields, layout
from ..sources.storage import shared_folder
from . import fixtures as fx
from .queries import query, r6

# --- dates as bitmaps: numbers of days since 1992, some thousands -------------------------------

DAYS_SQL = "days AS (SELECT o_orderstatus AS experiment, CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS INT) AS init_day FROM orders)"


def _days(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))
    return fx.table(spark, sf, "orders").select(F.col("o_orderstatus").alias("experiment"), day.alias("init_day"), "o_orderpriority")


def _words(df: DataFrame, *by: str) -> DataFrame:
    return datesets.date_words(df, "init_day", by)


@query("bitmap_common_dates", "WITH " + DAYS_SQL + " SELECT init_day FROM days GROUP BY 1 HAVING count(DISTINCT experiment) = (SELECT count(DISTINCT experiment) FROM days)")
def bitmap_common_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates that all experiments have, by bits."""
    return datesets.dates_of(datesets.common(_words(_days(spark, sf), "experiment"), "experiment"), "init_day")


@query("bitmap_gaps", "WITH " + DAYS_SQL + " SELECT CAST(d AS INT) AS init_day FROM range(0, 2406) r(d) WHERE d NOT IN (SELECT init_day FROM days WHERE experiment = 'F') AND d NOT IN (SELECT init_day FROM days WHERE experiment = 'P')")
def bitmap_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Dates that are missing without being declared, by bits (U4)."""
    days, expected = _days(spark, sf), spark.range(2406).select(F.col("id").cast("int").alias("init_day"))
    found = (_words(days.where(F.col("experiment") == e)) for e in ("F", "P"))
    return datesets.dates_of(datesets.minus(_words(expected), *found), "init_day")


@query("bitmap_mismatches", "WITH " + DAYS_SQL + ", e AS (SELECT DISTINCT init_day FROM days WHERE experiment = 'O'), f AS (SELECT DISTINCT init_day FROM days WHERE experiment = 'F') SELECT init_day, 'missing' AS problem FROM e WHERE init_day NOT IN (SELECT init_day FROM f) UNION ALL SELECT init_day, 'unexpected' FROM f WHERE init_day NOT IN (SELECT init_day FROM e)")
def bitmap_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """Dates that one experiment lacks or has beyond another, by bits."""
    days = _days(spark, sf)
    e, f = (_words(days.where(F.col("experiment") == x)) for x in ("O", "F"))
    return datesets.dates_of(datesets.mismatches(e, f), "init_day", ("problem",)).select("init_day", "problem")


@query("bitmap_exclusions", "WITH " + DAYS_SQL + " SELECT init_day FROM days GROUP BY 1 HAVING count(DISTINCT experiment) < (SELECT count(DISTINCT experiment) FROM days)")
def bitmap_exclusions(spark: SparkSession, sf: str) -> DataFrame:
    """Excluded dates that not all experiments exclude, by bits."""
    return datesets.dates_of(datesets.not_in_all(_words(_days(spark, sf), "experiment"), "experiment"), "init_day")


@query("bitmap_counts", "WITH " + DAYS_SQL + ", e AS (SELECT DISTINCT init_day FROM days), f AS (SELECT DISTINCT init_day FROM days WHERE experiment = 'P') SELECT count(*) AS n_expected, CAST(count(f.init_day) AS BIGINT) AS n_found, count(*) - count(f.init_day) AS n_missing FROM e LEFT JOIN f USING (init_day)")
def bitmap_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Expected, found and missing dates, counted as bits."""
    days = _days(spark, sf)
    return datesets.counted(_words(days), _words(days.where("experiment = 'P'")))


@query("bitmap_spacing", "WITH " + DAYS_SQL + ", s AS (SELECT experiment, init_day - lag(init_day) OVER (PARTITION BY experiment ORDER BY init_day) AS step FROM (SELECT DISTINCT experiment, init_day FROM days)) SELECT experiment, CAST(min(step) AS INT) AS spacing FROM s GROUP BY 1")
def bitmap_spacing(spark: SparkSession, sf: str) -> DataFrame:
    """The least step between the dates of each experiment, from bits."""
    return datesets.steps(_words(_days(spark, sf), "experiment"), "experiment", "spacing")


# --- dates in paths -----------------------------------------------------------------------------

_NAME = "'/flat/x' || (day(d) % 4) || '_' || strftime(d, '%Y') || '.' || strftime(d - INTERVAL 6 HOUR, '%m%d_%H') || '+.nc'"


@query("flat_folder_files", f"WITH k AS (SELECT DISTINCT CAST(o_orderdate AS TIMESTAMP) AS d FROM orders), f AS (SELECT {_NAME} AS path FROM k), h AS (SELECT k.d, f.path FROM k JOIN f ON substr(f.path, 9) = '_' || strftime(k.d, '%Y') || '.' || strftime(k.d - INTERVAL 6 HOUR, '%m%d_%H') || '+.nc') SELECT strftime(d, '%Y%m%d') AS init_date, min(path) AS path, count(*) AS n_matches FROM h GROUP BY d")
def flat_folder_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of one flat folder found by the dates in their names: keys and files meet by equality."""
    d = F.col("init_date")
    keys = fx.table(spark, sf, "orders").select(F.col("o_orderdate").cast("timestamp").alias("init_date")).distinct().withColumn("valid_time", d)
    early = d - F.make_dt_interval(hours=F.lit(6))
    path = F.concat(F.lit("/flat/x"), (F.day(d) % 4).cast("string"), F.lit("_"), F.date_format(d, "yyyy"), F.lit("."), F.date_format(early, "MMdd_HH"), F.lit("+.nc"))
    got = fields.matched_files(keys, ["x?_{init_YYYY}.{init_MM,shift=-6h}{init_DD,shift=-6}_{init_HH,shift=-6h}+.nc"], keys.select(path.alias("path")), "/flat/")
    return got.select(F.date_format("init_date", "yyyyMMdd").alias("init_date"), "path", "n_matches")


@query("path_times", "WITH k AS (SELECT DISTINCT CAST(o_orderdate AS TIMESTAMP) AS d FROM orders) SELECT strftime(d, '%Y%m%d%H') AS init, strftime(d + INTERVAL 36 HOUR, '%Y%m%d%H') AS valid FROM k")
def path_times(spark: SparkSession, sf: str) -> DataFrame:
    """Both times of a file read back out of its path, shifts undone."""
    d, template = F.col("d"), "/a/{init_YYYYMMDDHH}/f*_{valid_YYYYMMDD,shift=-12h}_{valid_HH,shift=-12h}.nc"
    dates = fx.table(spark, sf, "orders").select(F.col("o_orderdate").cast("timestamp").alias("d")).distinct()
    path = F.replace(calendar.template_path(template, d, calendar.valid_time(d, F.lit(36))), F.lit("*"), F.lit("_x_"))
    files = dates.select(path.alias("path"))
    return files.select(*(F.date_format(calendar.read_time(template, F.col("path"), w), "yyyyMMddHH").alias(w) for w in ("init", "valid")))


# --- layout and digits --------------------------------------------------------------------------


def bucketed_tables(spark: SparkSession, sf: str, buckets: int = 8) -> list[str]:
    """Forecast, analysis and climatology bucketed and sorted by time and cell, as tables of names of their own."""
    fcst = fx.view(spark, sf, "fcst").withColumn("t_idx", F.col("init_idx") * 2 + (F.col("lead") / 12).cast("int"))
    ana = fx.view(spark, sf, "ana")
    times = ana.select("t_idx").distinct().withColumn("cycle", F.col("t_idx") % 2 * 12)  # a row a time
    clim = fx.view(spark, sf, "clim_raw").where("month = 5").join(F.broadcast(times), "cycle").select("t_idx", "lat_idx", "lon_idx", "c")
    names = []
    for df in (fcst, ana, clim):
        path = shared_folder(spark, "cells")
        names.append("cells_" + path[-32:])
        layout.write_bucketed(df, names[-1], path, buckets, CELL_KEYS)
    return names


CELL_KEYS = ("t_idx", "lat_idx", "lon_idx")


@query("bucketed_alignment", fx.with_sql("fcst", "ana", "clim_raw", fx.cells_sql()) + "SELECT CAST(init_idx*2 + CAST(lead/12 AS INT) AS INT) AS t_idx, lat_idx, lon_idx, count(f) AS n, round(sum(f - a), 8) + 0.0 AS error, round(sum(f - c), 8) + 0.0 AS anomaly FROM cells GROUP BY 1, 2, 3")
def bucketed_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast, analysis and climatology joined as their buckets lie, and summed by time and cell, without an exchange."""
    f, a, c = (layout.read_bucketed(spark, n) for n in bucketed_tables(spark, sf))
    got = layout.cell_sums(layout.aligned_in_place(f, a, c, CELL_KEYS), CELL_KEYS)
    return got.select(*CELL_KEYS, "n", r6("error", 8).alias("error"), r6("anomaly", 8).alias("anomaly"))


_SIZE = "CASE WHEN x = 0 THEN '0.0000000' WHEN abs(x) < 0.01 OR abs(x) >= 10000 THEN printf('%.6E', x) WHEN abs(x) < 10 THEN printf('%.6f', x) WHEN abs(x) < 100 THEN printf('%.5f', x) WHEN abs(x) < 1000 THEN printf('%.4f', x) ELSE printf('%.3f', x) END"


@query("scorecard_digits", f"SELECT l_orderkey, l_linenumber, {_SIZE} AS shown FROM (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) * CASE WHEN l_linenumber % 7 = 0 THEN 0 WHEN l_linenumber % 2 = 0 THEN -0.001 ELSE 1024 END / CAST(1 + (l_orderkey % 23) * (l_orderkey % 23) * (l_orderkey % 23) * (l_orderkey % 23) AS DOUBLE) AS x FROM lineitem)")
def scorecard_digits(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of many sizes with seven digits, as C prints them (F8)."""
    c = F.col
    power = F.lit(1).cast("long")
    for _ in range(4):
        power = power * (c("l_orderkey") % 23)
    factor = F.when(c("l_linenumber") % 7 == 0, 0.0).when(c("l_linenumber") % 2 == 0, -0.001).otherwise(1024.0)
    x = c("l_extendedprice").cast("double") * factor / (1 + power).cast("double")
    return fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", derive.seven_digits(x).alias("shown"))
