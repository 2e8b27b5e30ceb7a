"""Sets of dates as bitmaps: intersections, unions, gaps and counts by bit operations.

A date is a bit of a word of 63 days (or hours); a set of dates is a row a word. One aggregation with partial results in every task turns rows of
any number into words, a row an experiment and 63 days; all that follows is on these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Dates of a word.
WORD = 63


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(WORD)).cast("int"))


def date_words(rows: DataFrame, number: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, word, bits): the set of day numbers of each group; null numbers are in no set."""
    at = F.col(number).cast("long")
    return rows.where(at.isNotNull()).groupBy(*by, F.floor(at / WORD).alias("word")).agg(F.bit_or(_bit(at)).alias("bits"))


def dates_of(words: DataFrame, number: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The sets as rows again (keep, number)."""
    days = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda k: F.getbit(F.col("bits"), k) == 1)
    return words.select(*keep, "word", F.explode(days).alias("__k")).select(*keep, (F.col("word") * WORD + F.col("__k")).cast("int").alias(number))


def common(words: DataFrame, by: str, members: DataFrame | None = None) -> DataFrame:
    """(word, bits) of the dates that every group has (U3); groups are those of ``words``, or of ``members``."""
    n = (words if members is None else members).select(by).distinct().agg(F.count("*").alias("__n"))
    got = words.groupBy("word").agg(F.bit_and("bits").alias("bits"), F.count("*").alias("__k")).crossJoin(F.broadcast(n))
    return got.where("__k = __n AND bits <> 0").select("word", "bits")


def union(words: DataFrame) -> DataFrame:
    """(word, bits) of the dates that any group has."""
    return words.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def minus(one: DataFrame, *others: DataFrame) -> DataFrame:
    """(word, bits) of the dates of the first that none of the others has (U4)."""
    for other in others:
        one = one.join(other.select("word", F.col("bits").alias("__o")), "word", "left")
        one = one.withColumn("bits", F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("__o", F.lit(0).cast("long"))))).drop("__o")
    return one.where("bits <> 0")


def mismatches(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(word, bits, problem): dates that are missing, and such as are not expected."""
    return minus(expected, found).withColumn("problem", F.lit("missing")).unionByName(minus(found, expected).withColumn("problem", F.lit("unexpected")))


def not_in_all(words: DataFrame, by: str) -> DataFrame:
    """(word, bits) of the dates that some groups have and others lack."""
    return minus(union(words), common(words, by))


def counted(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(n_expected, n_found, n_missing) of two sets of words."""
    both = expected.join(found.select("word", F.col("bits").alias("__f")), "word", "left")
    hit = F.bit_count(F.col("bits").bitwiseAND(F.coalesce("__f", F.lit(0).cast("long"))))
    n, f = F.sum(F.bit_count("bits")), F.sum(hit)
    zero = lambda x: F.coalesce(x, F.lit(0)).cast("long")
    return both.agg(zero(n).alias("n_expected"), zero(f).alias("n_found"), zero(n - f).alias("n_missing"))


def steps(words: DataFrame, by: str, number: str) -> DataFrame:
    """(by, spacing): the least step between the dates of each group.

    Within a word, steps are those of its bits; between words, from the last bit of one to the first of the next.
    """
    days = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda k: F.getbit(F.col("bits"), k) == 1)
    at = words.select(by, "word", F.transform(days, lambda k: F.col("word") * WORD + k).alias("d"))
    # a row a word: a group's words of a thousand years are 6,000
    every = at.groupBy(by).agg(F.array_sort(F.flatten(F.collect_list("d"))).alias("d"))
    gaps = F.zip_with(F.slice("d", F.lit(2), F.greatest(F.size("d") - 1, F.lit(0))), F.slice("d", F.lit(1), F.greatest(F.size("d") - 1, F.lit(0))), lambda b, a: b - a)
    return every.select(by, F.array_min(gaps).cast("int").alias(number))
