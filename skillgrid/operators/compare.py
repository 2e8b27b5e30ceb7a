"""Comparison of experiments: common dates, paired differences, intervals, significance, zonal means."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distributions import critical_values, t_quantile

#: Significance levels of regional comparisons, and of maps.
LEVELS, MAP_LEVELS = (0.68, 0.90, 0.95, 0.99, 0.9999), (0.90,)
CLIP = 1 - 5e-6
#: A spread of differences up to this share of the greatest value is rounding of equal differences.
NO_SPREAD = 1e-14


def t_critical(level: float, n: int) -> float | None:
    """Two-sided critical value for n values, n - 1 degrees of freedom (I7); None under two values."""
    return None if n < 2 else t_quantile(level, n - 1)


def with_critical(got: DataFrame, levels: tuple[float, ...]) -> DataFrame:
    """Aggregates with their number of dates ``n``, a row a level with its critical value ``t``; one row without either under two dates."""
    each = got.withColumn("__c", F.explode_outer(critical_values(levels, F.col("n"))))
    return each.select(*got.columns, F.col("__c.level").alias("level"), F.col("__c.t").alias("t"))


def whole(x: Column, f: Callable[[Column], Column]) -> Column:
    """An aggregate that is missing if any value is."""
    return F.when(F.count(x) == F.count(F.lit(1)), f(x))


def common_dates(stats: DataFrame, excluded: DataFrame | None = None, date: str = "init_day") -> DataFrame:
    """Dates that every experiment has, less those that any excludes.

    Counting experiments a date is one aggregation, whatever their number.
    """
    pairs = stats.select("experiment", date).distinct()
    n = pairs.select("experiment").distinct().count()
    common = pairs.groupBy(date).agg(F.count("*").alias("n")).where(F.col("n") == n).select(date)
    return common if excluded is None else common.join(excluded.select(date), date, "left_anti")


def undeclared_gaps(expected: DataFrame, found: DataFrame, excluded: DataFrame, date: str = "init_day") -> DataFrame:
    """Dates that are missing without being declared as excluded (U4)."""
    return expected.select(date).join(found.select(date), date, "left_anti").join(excluded.select(date), date, "left_anti")


def date_mismatches(expected: DataFrame, found: DataFrame, date: str = "init_day") -> DataFrame:
    """(date, problem): dates that are missing or not expected."""
    e, f = expected.select(date).distinct(), found.select(date).distinct()
    lacking = e.exceptAll(f).withColumn("problem", F.lit("missing"))
    return lacking.union(f.exceptAll(e).withColumn("problem", F.lit("unexpected")))


def overlaps(files: DataFrame, date: str = "init_day") -> DataFrame:
    """Dates of an experiment that several of its files (experiment, file, date) hold."""
    once = files.select("experiment", "file", date).distinct()
    return once.groupBy("experiment", date).agg(F.count("*").alias("n_files")).where("n_files > 1")


def timing(stats: DataFrame) -> DataFrame:
    """(experiment, length_days, interval): what leads say about an experiment."""
    found = stats.groupBy("experiment").agg(F.array_sort(F.collect_set("lead")).alias("leads"), F.max("lead").alias("top"))
    interval = F.when(F.size("leads") > 1, F.get("leads", F.lit(1)) - F.get("leads", F.lit(0)))
    return found.select("experiment", F.floor(F.col("top") / 24).cast("int").alias("length_days"), interval.cast("int").alias("interval"))


def incompatible(times: DataFrame, length_days: int, interval: int) -> DataFrame:
    """Experiments that are too short or too coarse in time."""
    return times.where((F.col("length_days") < length_days) | (F.col("interval") > interval) | F.col("interval").isNull())


def date_spacing(stats: DataFrame, date: str = "init_day") -> DataFrame:
    """(experiment, spacing): the least step between an experiment's dates."""
    dates = stats.select("experiment", date).distinct()
    before = F.lag(date).over(Window.partitionBy("experiment").orderBy(date))
    return dates.withColumn("step", F.col(date) - before).groupBy("experiment").agg(F.min("step").cast("int").alias("spacing"))


def grid_mismatches(maps: DataFrame, control: int) -> DataFrame:
    """(experiment, n_cells, n_control, n_common): experiments whose cells are not those of the control."""
    cells = maps.select("experiment", "lat_idx", "lon_idx").distinct()
    ctl = cells.where(F.col("experiment") == control).select("lat_idx", "lon_idx", F.lit(1).alias("__c"))
    found = cells.join(ctl, ["lat_idx", "lon_idx"], "left").groupBy("experiment").agg(F.count("*").alias("n_cells"), F.count("__c").alias("n_common"))
    found = found.crossJoin(F.broadcast(ctl.agg(F.count("*").alias("n_control"))))
    return found.where("n_cells <> n_control OR n_common <> n_control").select("experiment", "n_cells", "n_control", "n_common")


def exclusion_mismatches(excluded: DataFrame, date: str = "init_day") -> DataFrame:
    """(date, n_experiments): excluded dates that not all experiments exclude."""
    pairs = excluded.select("experiment", date).distinct()
    n = pairs.select("experiment").distinct().agg(F.count("*").alias("n"))
    return pairs.groupBy(date).agg(F.count("*").alias("n_experiments")).crossJoin(F.broadcast(n)).where("n_experiments < n").drop("n")


def paired(stats: DataFrame, control: int, keys: list[str], value: str, date: str = "init_day") -> DataFrame:
    """(experiment, keys, date, x_ctl, x_model): every other experiment with the control's values."""
    ctl = stats.where(F.col("experiment") == control).select(*keys, date, F.col(value).alias("x_ctl"))
    return stats.where(F.col("experiment") != control).select("experiment", *keys, date, F.col(value).alias("x_model")).join(ctl, [*keys, date])


def fisher(x: Column) -> Column:
    """Fisher's z of a clipped correlation."""
    return F.atanh(F.when(x > CLIP, CLIP).when(x < -CLIP, -CLIP).otherwise(x))


def root(x: Column) -> Column:
    """Square root, 0 for what is negative; a missing value stays missing."""
    return F.sqrt(F.when(x < 0, 0.0).otherwise(x))


def paired_interval(pairs: DataFrame, keys: list[str], levels: tuple[float, ...], correlation: bool, date: str = "init_day") -> DataFrame:
    """Interval of no difference for paired statistics, by level.

    Correlations are compared as Fisher's z, others as squares; bounds are carried back around the control's
    mean and so are not symmetric. With a single date, and where any date's value is missing, they are null.
    """
    way = fisher if correlation else (lambda x: x * x)
    z = pairs.withColumns({"z_ctl": way(F.col("x_ctl")), "z_d": way(F.col("x_model")) - way(F.col("x_ctl"))})
    got = z.groupBy("experiment", *keys).agg(
        whole(F.col("z_ctl"), F.avg).alias("mean"), whole(F.col("z_d"), F.var_samp).alias("var"), F.count("*").alias("n"), whole(F.col("x_model") - F.col("x_ctl"), F.avg).alias("diff")
    )
    got = with_critical(got, levels)
    dx = F.col("t") * F.sqrt(F.col("var") / F.col("n"))
    back = F.tanh if correlation else root
    mean = F.col("mean")
    return got.select("experiment", *keys, "level", "n", "diff", (back(mean - dx) - back(mean)).alias("lower"), (back(mean + dx) - back(mean)).alias("upper"))


def synoptic_interval(stats: DataFrame, control: int, keys: list[str], value: str, levels: tuple[float, ...], correlation: bool, date: str = "init_day") -> DataFrame:
    """Interval around the control from the spread of dates (I4): half its own variance, half the mean of the others'.

    Correlations of other experiments are not clipped. Missing values make what rests on them missing.
    """
    x = F.col(value)
    is_ctl = F.col("experiment") == control
    if correlation:
        z = F.when(is_ctl, fisher(x)).when(F.abs(x) < 1, F.atanh(x))
    else:
        z = x * x
    each = stats.withColumn("z", z).groupBy("experiment", *keys).agg(whole(F.col("z"), F.var_samp).alias("var"), whole(F.col("z"), F.avg).alias("mean"), whole(x, F.avg).alias("plain"), F.count("*").alias("n"))
    got = each.groupBy(*keys).agg(
        F.max(F.when(is_ctl, F.col("var"))).alias("var_ctl"), F.when(F.count("var") == F.count(F.lit(1)), F.avg(F.when(~is_ctl, F.col("var")))).alias("var_other"),
        F.max(F.when(is_ctl, F.col("mean"))).alias("mean"), F.max(F.when(is_ctl, F.col("plain"))).alias("plain"), F.max(F.when(is_ctl, F.col("n"))).alias("n"),
    )
    got = with_critical(got, levels)
    dx = F.col("t") * F.sqrt((F.col("var_ctl") + F.col("var_other")) / 2 / F.col("n"))
    back = F.tanh if correlation else root
    mean = F.col("mean")
    return got.select(*keys, "level", (back(mean - dx) - back(mean) + F.col("plain")).alias("lower"), (back(mean + dx) - back(mean) + F.col("plain")).alias("upper"))


def significance(pairs: DataFrame, keys: list[str], level: float, date: str = "init_day") -> DataFrame:
    """t of the paired difference control minus model, and whether it is significant (I5); null without variance or with missing values."""
    d = F.col("x_ctl") - F.col("x_model")
    got = pairs.groupBy("experiment", *keys).agg(
        whole(d, F.avg).alias("mean"), whole(d, F.var_samp).alias("var"), F.count("*").alias("n"), F.max(F.greatest(F.abs("x_ctl"), F.abs("x_model"))).alias("top")
    )
    got = with_critical(got, (level,))
    spread = F.sqrt("var")
    t = F.try_divide(F.col("mean") * F.sqrt(F.col("n") - F.lit(1)), F.when(spread > NO_SPREAD * F.col("top"), spread))
    return got.withColumn("t_stat", t).select("experiment", *keys, "t_stat", (F.abs("t_stat") >= F.col("t")).alias("significant"))


def strongest_tier(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """The highest level whose interval excludes the difference (I6); null if none does."""
    out = F.col("diff").isNotNull() & ((F.col("diff") < F.col("lower")) | (F.col("diff") > F.col("upper")))
    return intervals.groupBy("experiment", *keys).agg(F.max(F.when(out, F.col("level"))).alias("tier"), F.max("diff").alias("diff"))


def zonal_mean(maps: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Means over longitude, skipping what is missing (A20); masks count as 0 and 1."""
    return maps.groupBy(*keys, "lat_idx").agg(*(F.avg(F.col(v).cast("double")).alias(v) for v in values))


def rounded_down(top: Column) -> Column:
    """A magnitude rounded down to a plain bound."""
    return (
        F.when(top.isNull() | (top <= 0), 0.0).when(top <= 0.1, 0.1).when(top <= 1, 1.0).when(top <= 5, 5.0)
        .when(top <= 10, 10.0).otherwise(F.floor(top / 10) * F.lit(10.0))
    )


def range_summary(maps: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Least, greatest and rounded magnitude of values."""
    v = F.col(value)
    return maps.groupBy(*keys).agg(F.min(v).alias("low"), F.max(v).alias("high"), rounded_down(F.max(F.abs(v))).alias("bound"))


def final_lead(curves: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Value at the last lead of each curve."""
    return curves.groupBy(*keys).agg(F.max("lead").alias("lead"), F.max_by(value, "lead").alias(value))


def die_off(curves: DataFrame, tiers: DataFrame, control: int, keys: list[str], value: str) -> DataFrame:
    """Curves of all experiments with the difference from the control and the tier of its significance."""
    ctl = curves.where(F.col("experiment") == control).select(*keys, F.col(value).alias("x_ctl"))
    joined = curves.join(ctl, keys, "left").join(tiers.select("experiment", *keys, "tier"), ["experiment", *keys], "left")
    return joined.select("experiment", *keys, value, (F.col(value) - F.col("x_ctl")).alias("diff"), "tier")
