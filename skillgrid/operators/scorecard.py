"""Scorecard lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.catalog import SCORECARD_STATS
from ..functions.derive import seven_digits, unscaled_for_scorecard


def two_dimensional_level(collection: Column) -> Column:
    """The level that scorecards give to variables without levels."""
    return F.when(collection == "default", 1000.0).otherwise(0.0)


def scorecard_lines(stats: DataFrame, regions: DataFrame, model: str, verify: str, expver: str) -> DataFrame:
    """(init_date, line): one line for every statistic on scorecards (K3).

    ``stats`` is (init_date, lead, region, var, level, stat, value). The source column repeats the
    experiment, the count is 0.0 and lines end with a bar, as readers of these files expect.
    """
    names = F.create_map(*(F.lit(x) for pair in SCORECARD_STATS.items() for x in pair))
    joined = stats.where(F.col("stat").isin(*SCORECARD_STATS)).join(F.broadcast(regions), "region")
    value = unscaled_for_scorecard(F.col("value"), F.col("var"), F.col("stat"))
    line = F.concat_ws(
        "|", F.lit("0.0"), F.date_format("init_date", "yyyyMMddHH"), "domain_name", seven_digits(F.col("east")), F.lit(model), F.lit(expver),
        seven_digits(F.col("level")), F.lit("pl"), seven_digits(F.col("north")), F.lower("var"), F.lit(expver), seven_digits(F.col("south")),
        names[F.col("stat")], F.col("lead").cast("string"), F.lit("fc"), seven_digits(value), F.lit(verify), seven_digits(F.col("west")),
    )
    return joined.select("init_date", F.concat(line, F.lit("|")).alias("line"))
