"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Documents fall into cells (source, language, topic); a cell's weight starts as
its tokens. First the targets of each dimension are made feasible: a value gets at most the tokens that it has, and what
that takes away is shared among the others. Each pass then rakes the weights to the goals of one dimension
after another, and caps them at a cell's own tokens, as no document can be drawn more
than once: the calibrated chances themselves meet the margins. Passes go on until every margin is met within a tolerance, or
a bound on passes is reached; ``margins`` reports what is left. A document's chance is the ratio of its cell's weight to the cell's tokens. Documents are
drawn by a hash of their id, so the sample is repeatable and needs no state.

Only cells are shuffled and raked. They are as many as there are combinations of
values, and they are joined to the documents by broadcast only if a count shows
that they are few.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, table

#: Share of all tokens that is wanted.
TOKEN_SHARE = 0.5
#: Relative error of a margin at which raking ends, passes between two looks at it, and passes at most.
TOLERANCE, ROUND, PASSES = 2e-3, 4, 32
#: Target weights of a dimension's values: fixed ones by value, or in proportion to a power of the tokens.
TARGETS: dict[str, dict[str, float] | float] = {"source": 0.5, "lang": 0.5, "topic": 0.7}
#: Cells up to this number are broadcast; more are joined by a shuffle.
BROADCAST_CELLS = 100_000


def token_count(text: Column) -> Column:
    """Space-separated tokens of a text; 0 for null and empty texts."""
    n = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(0)).otherwise(n).cast("double")


def topic(text: Column) -> Column:
    """A coarse topic by form: tables, pages with addresses, notices, shouting, prose; null: none."""
    return (
        F.when(text.isNull(), "none")
        .when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("@")), "contact")
        .when(F.contains(text, F.lit("icense")), "notice")
        .when(F.contains(text, F.lit("!!")), "shout")
        .otherwise("prose")
    )


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the MD5 of a key."""
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 48))


def goals(cells: DataFrame, name: str, target: dict[str, float] | float, share: float) -> DataFrame:
    """(name, goal): the tokens wanted of each value of a dimension that has any, ``share`` of all in total.

    Fixed weights need not add up to one; values without a weight get none. No goal exceeds what its value has: the others share
    the rest in proportion to their weights. If all values with a weight have less than is wanted, all of it is.
    """
    sums = cells.groupBy(name).agg(F.sum("tokens").alias("tokens"))
    if isinstance(target, dict):
        known = F.create_map(*(F.lit(x) for value, w in target.items() for x in (value, float(w)))) if target else F.create_map(F.lit(""), F.lit(0.0))
        weight = F.when(F.col("tokens") > 0, F.coalesce(F.try_element_at(known, F.col(name)), F.lit(0.0))).otherwise(0.0)
    else:
        weight = F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(float(target)))).otherwise(0.0)
    weighted = sums.withColumn("w", weight)
    wanted = weighted.agg((F.sum("tokens") * F.lit(float(share))).alias("wanted"))
    # values by what they have for their weight: those before some place are taken whole. A row a value
    by = Window.orderBy(F.col("tokens") / F.col("w"), name)
    before = F.coalesce(F.sum("tokens").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing))
    some = weighted.where("w > 0").crossJoin(F.broadcast(wanted)).withColumn("level", (F.col("wanted") - before) / rest)
    level = some.where(F.col("level") * F.col("w") <= F.col("tokens")).agg(F.max("level").alias("level"))
    got = weighted.crossJoin(F.broadcast(level))  # one row
    goal = F.when(F.col("w") <= 0, 0.0).otherwise(F.least(F.col("tokens"), F.coalesce(F.col("level") * F.col("w"), F.col("tokens"))))
    return got.select(name, goal.alias(f"goal_{name}"))


def margins(raked: DataFrame, names: list[str]) -> DataFrame:
    """(dimension, value, goal, weight): what each value was to have, and has, of cells with their goals and weights."""
    each = [raked.groupBy(F.col(n).alias("value")).agg(F.first(f"goal_{n}").alias("goal"), F.sum("weight").alias("weight")).select(F.lit(n).alias("dimension"), "value", "goal", "weight") for n in names]
    return reduce(lambda a, b: a.unionByName(b), each)


def rake(cells: DataFrame, targets: dict[str, dict[str, float] | float], share: float = TOKEN_SHARE, passes: int = PASSES, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (dimensions, tokens) with the raked ``weight``, the tokens to draw of each, at most what it has, and the goals of its values.

    Cells without tokens keep weight 0. A value over its goal shrinks as a whole; one under it grows in the cells that are not
    capped. Margins are looked at after every ``ROUND`` passes.
    """
    names = list(targets)
    out = cells.withColumn("weight", F.col("tokens") * F.lit(float(share)))
    for name, target in targets.items():
        out = out.join(goals(cells, name, target, share), name)
    out = kept(out, small=True)
    for start in range(0, passes, ROUND):
        for name in names * min(ROUND, passes - start):
            # sums by value over cells only, which are few; a join with their sums would read every earlier step twice
            by = Window.partitionBy(name)
            full = F.col("weight") >= F.col("tokens")
            taken, rest = F.sum(F.when(full, F.col("weight")).otherwise(0.0)).over(by), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).over(by)
            goal, whole = F.col(f"goal_{name}"), F.sum("weight").over(by)
            factor = F.when(whole > goal, F.try_divide(goal, whole)).otherwise(F.when(full, 1.0).otherwise(F.try_divide(goal - taken, rest)))
            out = out.withColumn("factor", F.coalesce(factor, F.lit(1.0)))
            out = out.withColumn("weight", F.least(F.col("tokens"), F.col("weight") * F.col("factor"))).drop("factor")
        out = kept(out, small=True)
        off = F.abs(F.col("weight") / F.col("goal") - 1)
        if (margins(out, names).where("goal > 0").agg(F.max(off)).first()[0] or 0.0) <= tolerance:
            break
    return out


def mixed(
    docs: DataFrame, dimensions: dict[str, Column], targets: dict[str, dict[str, float] | float] = TARGETS, share: float = TOKEN_SHARE,
    text: str = "text", key: str = "doc_id", out: str = "keep_probability",
) -> DataFrame:
    """The drawn rows of ``docs`` with the probability by which each was drawn.

    ``dimensions`` gives the column of each dimension, ``targets`` its target weights: by value, or as a power of the
    tokens. A null value counts as a value of its own (the empty string). Documents without tokens, and those
    without a key, are never drawn. A repeated id is drawn or left out in all its rows. All columns of ``docs`` stay; a column named ``out`` is
    replaced. An empty table gives an empty result.
    """
    names = {n: f"__mix_{n}" for n in dimensions}
    keyed = docs.withColumns({names[n]: F.coalesce(c.cast("string"), F.lit("")) for n, c in dimensions.items()})
    counted = keyed.select(*(F.col(names[n]).alias(n) for n in names), token_count(F.col(text)).alias("tokens"))
    cells = kept(counted.groupBy(*names).agg(F.sum("tokens").alias("tokens")))
    raked = rake(cells, targets, share)
    chance = F.coalesce(F.try_divide(F.col("weight"), F.col("tokens")), F.lit(0.0))
    chances = raked.select(*(F.col(n).alias(names[n]) for n in names), chance.alias("__mix_chance"))
    if cells.count() <= BROADCAST_CELLS:
        chances = F.broadcast(chances)
    drawn = keyed.join(chances, list(names.values())).where(uniform(F.col(key)) < F.col("__mix_chance"))
    return drawn.withColumn(out, F.col("__mix_chance")).drop("__mix_chance", *names.values())


def document_dimensions() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.col("text"))}


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn to mix sources, languages and topics, with their probabilities."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    drawn = mixed(docs, document_dimensions())
    return drawn.select("doc_id", "source", "lang", F.round("keep_probability", 6).alias("keep_probability"))


def _oracle() -> str:
    parts = [f"""
WITH d AS (SELECT doc_id, source, lang, coalesce(source, '') AS s, coalesce(lang, '') AS l,
  CASE WHEN text IS NULL THEN 'none' WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, '@') THEN 'contact'
       WHEN contains(text, 'icense') THEN 'notice' WHEN contains(text, '!!') THEN 'shout' ELSE 'prose' END AS t,
  CASE WHEN coalesce(length(text), 0) = 0 THEN 0.0::DOUBLE ELSE CAST(length(text) - length(replace(text, ' ', '')) + 1 AS DOUBLE) END AS tokens
  FROM documents),
c AS MATERIALIZED (SELECT s, l, t, sum(tokens) AS tokens FROM d GROUP BY s, l, t),
total AS MATERIALIZED (SELECT sum(tokens) * {TOKEN_SHARE}::DOUBLE AS n FROM c)"""]
    for name, power in (("s", TARGETS["source"]), ("l", TARGETS["lang"]), ("t", TARGETS["topic"])):
        parts.append(f"""v_{name} AS MATERIALIZED (SELECT {name}, sum(tokens) AS tokens, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens), {power}) ELSE 0.0 END AS w FROM c GROUP BY {name}),
level_{name} AS MATERIALIZED (SELECT max(level) AS level FROM (SELECT tokens, w, ((SELECT n FROM total) - coalesce(sum(tokens) OVER (ORDER BY tokens / w, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY tokens / w, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM v_{name} WHERE w > 0) WHERE level * w <= tokens),
goal_{name} AS MATERIALIZED (SELECT {name}, CASE WHEN w <= 0 THEN 0.0 ELSE least(tokens, coalesce((SELECT level FROM level_{name}) * w, tokens)) END AS goal FROM v_{name})""")
    parts.append(f"w0 AS MATERIALIZED (SELECT s, l, t, tokens, tokens * {TOKEN_SHARE}::DOUBLE AS weight FROM c)")
    last, looks = "w0", []
    for k in range(1, PASSES + 1):
        for name in "slt":
            new = f"w{k}{name}"
            parts.append(f"""{new}s AS MATERIALIZED (SELECT {name}, sum(weight) AS whole, coalesce(sum(weight) FILTER (weight >= tokens), 0) AS taken, coalesce(sum(weight) FILTER (weight < tokens), 0) AS rest FROM {last} GROUP BY {name}),
{new} AS MATERIALIZED (SELECT w.s, w.l, w.t, tokens, least(tokens, weight * coalesce(CASE WHEN whole > goal THEN goal / whole WHEN weight >= tokens THEN 1.0 ELSE (goal - taken) / nullif(rest, 0) END, 1.0)) AS weight FROM {last} w JOIN goal_{name} g ON g.{name} = w.{name} JOIN {new}s x ON x.{name} = w.{name})""")
            last = new
        if k % ROUND == 0:
            off = " UNION ALL ".join(f"SELECT max(abs(x.weight / g.goal - 1)) AS off FROM (SELECT {n}, sum(weight) AS weight FROM {last} GROUP BY {n}) x JOIN goal_{n} g ON g.{n} = x.{n} WHERE g.goal > 0" for n in "slt")
            parts.append(f"off{k} AS MATERIALIZED (SELECT max(off) AS off FROM ({off}))")
            looks.append((k, last))
    end = " ".join(f"WHEN (SELECT off FROM off{k}) <= {TOLERANCE} THEN {k}" for k, _ in looks)
    parts.append(f"e AS MATERIALIZED (SELECT CASE {end} ELSE {PASSES} END AS k)")
    parts.append("p AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT s, l, t, coalesce(weight / nullif(tokens, 0), 0) AS p FROM {w} WHERE {k} = (SELECT k FROM e)" for k, w in looks) + ")")
    return ",\n".join(parts) + """
SELECT doc_id, source, lang, round(p, 6) AS keep_probability FROM d JOIN p USING (s, l, t)
WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) / 281474976710656.0 < p
"""


QUERIES = {"op10_source_mixing": op10_source_mixing}
ORACLE = {"op10_source_mixing": _oracle()}
