"""Checks that name everything that is missing, and name and level matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.catalog import MODEL_LEVELS


def missing_elements(required: DataFrame, available: DataFrame) -> DataFrame:
    """Required (kind, name) that are not available, all at once."""
    return required.join(available.select("kind", "name").distinct(), ["kind", "name"], "left_anti")


def raise_if_any(missing: DataFrame, what: str, shown: int = 10) -> None:
    """Raises with the number of missing rows and the first few."""
    some = missing.orderBy(*missing.columns).limit(shown + 1).collect()
    if some:
        n = len(some) if len(some) <= shown else missing.count()
        raise ValueError(f"{n} {what} missing: " + "; ".join(", ".join(str(v) for v in r) for r in some[:shown]))


def first_missing(needed: DataFrame, found: DataFrame, keys: list[str], shown: int = 10) -> DataFrame:
    """The first missing keys in order (S8, O6); a top-k, not a sort of all."""
    return needed.join(found.select(*keys).distinct(), keys, "left_anti").orderBy(*keys).limit(shown)


def resolved_names(wanted: DataFrame, aliases: DataFrame, available: DataFrame) -> DataFrame:
    """(var, found): the column that supplies each variable.

    The variable's own name, in any case, comes first, then its aliases in their order; null if none is there.
    """
    options = wanted.select("var", F.col("var").alias("name"), F.lit(-1).alias("priority")).union(aliases.select("var", "name", "priority"))
    have = available.select(F.lower("name").alias("__low"), F.col("name").alias("found"))
    hits = options.join(have, F.lower("name") == F.col("__low")).groupBy("var").agg(F.min_by("found", F.struct("priority", "found")).alias("found"))
    return wanted.join(hits, "var", "left").select("var", "found")


def find_column(columns: list[str], var: str, aliases: list[str]) -> str | None:
    """The same for the columns of a frame."""
    low = {c.lower(): c for c in reversed(columns)}
    return next((low[n.lower()] for n in (var, *aliases) if n.lower() in low), None)


def select_variables(df: DataFrame, keys: list[str], wanted: dict[str, list[str]]) -> DataFrame:
    """``df`` with the wanted variables under their own names (P1, P3, P6); raises with all that are missing."""
    found = {v: find_column(df.columns, v.split("#")[0].strip(), a) for v, a in wanted.items()}
    if missing := [v for v, c in found.items() if c is None]:
        raise ValueError(f"missing variables: {', '.join(missing)}")
    return df.select(*keys, *(F.col(c).alias(v) for v, c in found.items()))


def nearest_levels(spark: SparkSession, requested: list[int], table: tuple = MODEL_LEVELS) -> DataFrame:
    """(requested, model_level, pressure, off) of requested pressures (P5).

    Each takes the nearest table entry, of equals the first; a model level that
    an earlier request took is not taken again, and the later request is dropped.
    """
    levels = F.array(*(F.struct(F.lit(k).alias("at"), F.lit(lv).alias("model_level"), F.lit(p).alias("pressure")) for k, (lv, p) in enumerate(table)))
    asked = spark.createDataFrame(list(enumerate(requested)), "turn int, requested int")
    near = F.array_min(F.transform(levels, lambda x: F.struct(F.abs(x["pressure"] - F.col("requested")).alias("off"), x["at"].alias("at"), x["model_level"].alias("model_level"), x["pressure"].alias("pressure"))))
    best = asked.withColumn("near", near).select("turn", "requested", "near.model_level", "near.pressure", "near.off")
    first = F.row_number().over(Window.partitionBy("model_level").orderBy("turn"))
    return best.withColumn("__k", first).where("__k = 1").select("requested", "model_level", "pressure", "off")


def select_levels(df: DataFrame, levels: list[int]) -> DataFrame:
    """Rows of the requested levels (P4); the predicate reaches the scan. A level that is not there is an error."""
    found = df.where(F.col("lev").isin(*levels))
    wanted = df.sparkSession.createDataFrame([("lev", str(v)) for v in levels], "kind string, name string")
    have = found.select(F.lit("lev").alias("kind"), F.col("lev").cast("string").alias("name"))
    raise_if_any(missing_elements(wanted, have), "levels")
    return found


def lacking_variables(fields: dict[str, DataFrame], required: dict[str, list[str]]) -> DataFrame:
    """(kind, name) of the variables that fields lack: columns of wide frames, values of ``var`` in long ones."""
    spark = next(iter(fields.values())).sparkSession
    wanted = spark.createDataFrame([(k, v) for k, names in required.items() for v in names], "kind string, name string")
    have = spark.createDataFrame([(k, c) for k, df in fields.items() for c in df.columns], "kind string, name string")
    for k, df in fields.items():
        if "var" in df.columns:
            have = have.unionByName(df.select(F.lit(k).alias("kind"), F.col("var").alias("name")).distinct())
    return missing_elements(wanted, have)


def sample_file_problems(files: DataFrame, variables: list[str], levels: list[int] | None = None, fmt: str = "parquet") -> list[str]:
    """What one sample file of each collection (collection, path) lacks of variables and levels.

    The sample is the first path; of its data only the level column is read. Collections are a handful, so they are gone through here.
    """
    out = []
    for r in files.groupBy("collection").agg(F.min("path").alias("path")).orderBy("collection").collect():
        sample = files.sparkSession.read.format(fmt).load(r["path"])
        out += [f"{r['collection']}: no variable {v} in {r['path']}" for v in variables if v not in sample.columns]
        if levels is not None:
            have = {x["lev"] for x in sample.where(F.col("lev").isin(*levels)).select("lev").distinct().collect()} if "lev" in sample.columns else set()
            out += [f"{r['collection']}: no level {v} in {r['path']}" for v in levels if v not in have]
    return out


def in_time_order(df: DataFrame, time: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows in the order of their time (O2), dealt by its ranges; where times are equal, by ``keys``."""
    return df.orderBy(time, *keys)


def single_forecast(fields: dict[str, DataFrame], date: int, column: str = "init_idx", times: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """F, A and C of one initial date, kept in memory for the statistics that follow.

    No stored result is looked for. The analysis and climatology are cut to the times (``times`` has the columns
    that they share with the forecast) that the date needs. The caller unpersists them.
    """
    out = {"F": fields["F"].where(F.col(column) == date).persist()}
    for name, df in fields.items():
        if name != "F":
            at = (times or {}).get(name)
            out[name] = (df.join(F.broadcast(out["F"].select(*at).distinct()), at, "left_semi") if at else df).persist()
    return out


def loaded(fields: dict[str, DataFrame], levels: list[int] | None = None, leads: list[int] | None = None, dates: tuple[int, int] | None = None, times: dict[str, list[str]] | None = None, required: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """Forecast F, analysis and climatology cut to levels, leads and dates before any statistic.

    Required variables that a field lacks are an error that names them all, for all fields: columns, or values of ``var`` in long frames.

    A level or lead that is not there, and a time of the forecast that another field lacks (``times`` has the
    columns it shares with the forecast), is an error that names the first of them.
    """
    out = dict(fields)
    if required:
        raise_if_any(lacking_variables({k: out[k] for k in required}, required), "required variables")
    if dates is not None:
        out["F"] = date_range(out["F"], *dates)
    if leads is not None:
        wanted = out["F"].sparkSession.createDataFrame([(v,) for v in leads], "lead int")
        raise_if_any(wanted.join(out["F"].select("lead").distinct(), "lead", "left_anti"), "leads of F")
        out["F"] = select_leads(out["F"], leads)
    for name, df in out.items():
        if levels is not None and "lev" in df.columns:
            out[name] = select_levels(df, levels)
    for name, columns in (times or {}).items():
        lacking = out["F"].select(*columns).distinct().join(out[name].select(*columns).distinct(), columns, "left_anti")
        raise_if_any(lacking, f"times of {name}")
    return out


def sampled_problems(cells: DataFrame, keys: list[str], value: str, low: float, high: float, parts: int = 100) -> DataFrame:
    """(keys, n_sampled, n_missing, n_out): a check of one cell in ``parts`` of each key (P16); the sample is the feature.

    The draw is by place on the grid, so it is the same at every run and in every key.
    """
    drawn = cells.where(F.pmod(F.col("lat_idx") * 7919 + F.col("lon_idx") * 104729, F.lit(parts)) == 0)
    x = F.col(value)
    found = drawn.groupBy(*keys).agg(F.count("*").alias("n_sampled"), F.count_if(x.isNull()).alias("n_missing"), F.count_if((x < low) | (x > high)).alias("n_out"))
    return found.where("n_missing > 0 OR n_out > 0")


def chunks_merged(chunks: list[DataFrame], keys: list[str], date: str, static: tuple[str, ...] = ()) -> DataFrame:
    """Results of date ranges in one frame, ordered by date and keys.

    Chunks must hold rows and be disjoint in their dates, or it is an error. Static columns take their value at the
    first date everywhere (U9).
    """
    if not chunks:
        raise ValueError("no chunks")
    every = reduce(lambda x, y: x.unionByName(y), (c.withColumn("__chunk", F.lit(k)) for k, c in enumerate(chunks)))
    dates = every.select("__chunk", date).distinct()
    state = dates.groupBy(date).agg(F.count("*").alias("n")).agg(F.max(F.when(F.col("n") > 1, F.col(date))).alias("twice")).first()
    if state["twice"] is not None:
        raise ValueError(f"date {state['twice']} is in several chunks")
    if (filled := dates.select("__chunk").distinct().count()) < len(chunks):
        raise ValueError(f"{len(chunks) - filled} of {len(chunks)} chunks have no rows")
    out = every.drop("__chunk")
    rest = [k for k in keys if k != date]
    if static:
        out = out.drop(*static).join(every.groupBy(*rest).agg(*(F.min_by(s, date).alias(s) for s in static)), rest)
    return out.orderBy(date, *rest)


def wanted_work(stats: DataFrame, **only: list) -> DataFrame:
    """Rows of the named experiments, regions, variables or leads (P15); a name without rows is an error."""
    for column, values in only.items():
        names = stats.sparkSession.createDataFrame([(v,) for v in values], f"{column} {stats.schema[column].dataType.simpleString()}")
        raise_if_any(names.join(stats.select(column).distinct(), column, "left_anti"), column)
        stats = stats.where(F.col(column).isin(*values))
    return stats


def select_leads(df: DataFrame, leads: list[int]) -> DataFrame:
    """Rows of the requested leads."""
    return df.where(F.col("lead").isin(*leads))


def date_range(df: DataFrame, first: int, last: int, column: str = "init_idx") -> DataFrame:
    """Rows of a range of date indices (P11, S14); prunes partitions where the column is one."""
    return df.where(F.col(column).between(first, last))


def completeness(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """(n_expected, n_found, n_missing) over distinct keys."""
    e = expected.select(*keys).distinct().withColumn("__e", F.lit(1))
    f = found.select(*keys).distinct().withColumn("__f", F.lit(1))
    both = e.join(f, keys, "left")
    return both.agg(F.count("__e").alias("n_expected"), F.count("__f").alias("n_found"), (F.count("__e") - F.count("__f")).alias("n_missing"))
