"""Reading and writing cells, statistics and scorecards."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import one_reading, read_stamp, template_path, written_stamp
from ..functions.catalog import SCORECARD_HEADER, STAT_LONG, long_name_of, unit_of
from ..operators.align import without_nan


def read_cells(spark: SparkSession, paths: list[str], keys: list[str], variables: list[str], fmt: str = "parquet") -> DataFrame:
    """Cells of files with the wanted columns only; NaN becomes null."""
    options = {"header": "true", "inferSchema": "true"} if fmt == "csv" else {}
    df = spark.read.format(fmt).options(**options).load(paths)
    return without_nan(df.select(*keys, *variables), variables)


def listed_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path) of the files under a folder, found by Spark and so in any store it reads; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return found.select("path")


def matched_files(keys: DataFrame, templates: list[str], files: DataFrame, base: str = "") -> DataFrame:
    """(keys, path, n_matches): of each key (init_date, valid_time) the file of the first template that has one.

    Templates may hold * and ?, every other sign stands for itself. The dates are read out of each path, as its template would have written them,
    and files meet keys in a hash join on these digits, wherever the files lie. Where a path can be read in several ways (a date
    between two stars of one name), the join is on the folders before the first wildcard instead. Keys without a file keep a null path.
    """
    path = F.regexp_replace("path", "^file:/*", "/")
    have = files.select(path.alias("path"))
    init, valid = F.col("init_date"), F.col("valid_time")
    hits = None
    for k, t in enumerate(templates):
        whole = base + t
        if one_reading(whole):
            wanted = keys.select(*keys.columns, written_stamp(whole, init, valid).alias("__stamp"))
            found = have.select("path", read_stamp(whole, F.col("path")).alias("__stamp")).where(F.col("__stamp").isNotNull())
            here = wanted.join(found, "__stamp")
        else:
            here = _folder_matches(keys.select(*keys.columns, F.concat(F.lit(base), template_path(t, init, valid)).alias("wanted")), have, re.split("[*?]", base + re.sub("{.*?}", "", t))[0].count("/"))
        here = here.select(*keys.columns, "path", F.lit(k).alias("priority"))
        hits = here if hits is None else hits.unionByName(here)
    best = hits.groupBy(*keys.columns).agg(F.min_by("path", F.struct("priority", "path")).alias("path"), F.count("*").alias("n_matches"))
    return keys.join(best, keys.columns, "left")


def _folder_matches(wanted: DataFrame, have: DataFrame, depth: int) -> DataFrame:
    """Keys with the paths that match their own pattern ``wanted``, which are compared within equal first folders."""
    folder = lambda p: F.array_join(F.slice(F.split(p, "/"), F.lit(1), F.lit(depth)), "/")
    literal = F.concat(F.lit(r"^\Q"), F.replace(F.replace("wanted", F.lit("*"), F.lit(r"\E[^/]*\Q")), F.lit("?"), F.lit(r"\E[^/]\Q")), F.lit(r"\E$"))
    both = wanted.withColumn("folder", folder("wanted")).join(have.withColumn("folder", folder("path")), "folder")
    return both.where(F.regexp_like("path", literal))


def collection_files(wanted: DataFrame, listed: DataFrame, absent: str = "error") -> DataFrame:
    """(collection, path): the files of each wanted collection, or the default's if it lists none.

    ``listed`` has (collection, turn, path), folders in their order by ``turn``. A file that a collection listed in
    an earlier folder is not listed again. A collection without files and without a default is an error when the result is read, or has a null
    path with ``absent="null"``.
    """
    names = wanted.select("collection").distinct()
    own = names.join(listed.select("collection").distinct().withColumn("__own", F.lit(True)), "collection", "left")
    source = own.select("collection", F.when(F.col("__own"), F.col("collection")).otherwise("default").alias("source"))
    found = source.join(listed.withColumnRenamed("collection", "source"), "source", "left")
    if absent == "error":
        lacking = F.raise_error(F.concat(F.lit("no files of the collection "), F.col("collection"), F.lit(", and none of a default"))).cast("boolean")
        found = found.where(F.when(F.col("path").isNotNull(), F.lit(True)).otherwise(lacking))
    name = F.substring_index("path", "/", -1)
    return found.groupBy("collection", name.alias("name")).agg(F.min_by("path", F.struct("turn", "path")).alias("path")).select("collection", "path")


def name_metadata(name: Column) -> dict[str, Column]:
    """Models, grid and timing from the name of a statistics file (S13); spacing is 1 unless named."""
    number = lambda p: F.nullif(F.regexp_extract(name, p, 1), F.lit("")).cast("int")
    return {
        "kind": F.regexp_extract(name, "^([^_]+)_", 1),
        "fcst": F.get(F.split(name, "_"), F.lit(1)),
        "ana": F.get(F.split(name, "_"), F.lit(2)),
        "clim": F.get(F.split(name, "_"), F.lit(3)),
        "length_days": number("_len([0-9]+)d"),
        "interval": number("_int([0-9]+)h"),
        "spacing": F.coalesce(number("_spc([0-9]+)d"), F.lit(1)),
        "excluded": F.coalesce(number("_excl([0-9]+)"), F.lit(0)),
    }


def output_name(kind: str, collection: str, model: str, start: str, end: str, days: int, step: int, spacing: int, n_excluded: int, n_lat: int, n_lon: int) -> str:
    """Name of an output (K5)."""
    excluded = f"_excl{n_excluded}" if n_excluded else ""
    return f"{kind}_{collection}_{model}_{start}-{end}_len{days}d_int{step}h_spc{spacing}d{excluded}_{n_lat}x{n_lon}"


def write_cells(df: DataFrame, path: str, variables: list[str], partition: str) -> None:
    """Cells as single-precision Parquet, a folder for every date (K1); names and units go with the columns."""
    from ..functions.catalog import VARIABLES

    about = {v: {"long_name": VARIABLES.get(v.upper(), (v, "", 1.0))[0], "units": VARIABLES.get(v.upper(), (v, "", 1.0))[1]} for v in variables}
    rest = [c for c in df.columns if c not in variables]
    out = df.select(*rest, *(F.col(v).cast("float").alias(v, metadata=about[v]) for v in variables))
    # a date may be more than one task's work: its rows of the grid are dealt, too
    out.repartition(partition, *(c for c in ("lat_idx",) if c in out.columns)).write.mode("overwrite").partitionBy(partition).parquet(path)


def stat_catalog(spark: SparkSession, variables: list[str]) -> DataFrame:
    """(var, stat, long_name, units) of all statistics (K2, F16)."""
    rows = [(v, s, long_name_of(v, s), unit_of(v, s)) for v in variables for s in STAT_LONG]
    return spark.createDataFrame(rows, "var string, stat string, long_name string, units string")


def write_statistics(stats: DataFrame, path: str) -> None:
    """Long statistics (init_date, ..., var, stat, value) with names and units (K2)."""
    variables = [r["var"] for r in stats.select("var").distinct().collect()]
    named = stats.withColumn("value", F.col("value").cast("float")).join(F.broadcast(stat_catalog(stats.sparkSession, variables)), ["var", "stat"], "left")
    named.write.mode("overwrite").partitionBy("init_date").parquet(path)


def write_scorecards(lines: DataFrame, path: str) -> None:
    """Scorecards as text, a folder for every date; each file begins with the header (K3)."""
    head = lines.select("init_date").distinct().select("init_date", F.lit(SCORECARD_HEADER).alias("line"), F.lit(0).alias("__k"))
    every = head.unionByName(lines.withColumn("__k", F.lit(1)))
    dated = every.withColumn("date", F.date_format("init_date", "yyyyMMdd_HH"))
    dated.repartition("date").sortWithinPartitions("date", "__k", "line").select("date", "line").write.mode("overwrite").partitionBy("date").text(path)


def run_metadata(spark: SparkSession, excluded: list[str], **about: str) -> DataFrame:
    """One row about a run, with the excluded dates (K6)."""
    row = {"excluded_dates": ",".join(excluded), "n_excluded": len(excluded), **about}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in row.items()))


def file_list(given: str | list[str]) -> list[str]:
    """Paths of a file specification: a list, or one text with commas between; patterns stay for Spark's reader."""
    parts = given.split(",") if isinstance(given, str) else given
    return list(dict.fromkeys(p.strip() for p in parts if p.strip()))


def read_experiment(spark: SparkSession, given: str | list[str], experiment: str) -> DataFrame:
    """Statistics of an experiment's files, with the file of each row.

    Files are given as a list, with commas between, or by patterns; averages (columns that end in _avg) are
    left out, as they are not of one date. The same date in two files is an error.
    """
    df = spark.read.parquet(*file_list(given))
    df = df.drop(*(c for c in df.columns if c.endswith("_avg"))).withColumns({"experiment": F.lit(experiment), "file": F.input_file_name()})
    twice = df.select("file", "init_date").distinct().groupBy("init_date").agg(F.count("*").alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"{experiment}: dates in several files, such as {twice.first()['init_date']}")
    return df
