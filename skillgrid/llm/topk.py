"""Exact top-k inner products by norm buckets.

Candidates are grouped by length: classes of lengths, and buckets of bounded size within a class.
Each query gets a threshold, its k-th score among the longest vectors. For a
bucket, the threshold divided by the two lengths is a local cosine threshold.
Above 1 nothing in the bucket can enter the answer, and the query is not sent there.
Otherwise the query prunes the bucket by coordinates if its local threshold is
high (partial products of the query's largest coordinates, and for the rest the product of the
remaining lengths), or by length alone if it is low; what is left is verified by exact products.

Queries travel to buckets, each to those that its own threshold asks for. They are packed
by bucket and in bounded numbers, so a bucket that many queries ask for is
spread over tasks. Buckets move once, in the narrowest type that holds their components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, table

K, QUERY_STEP, SCALE = 20, 20, 64
#: Vectors of a bucket at most, and queries that meet it at once.
BUCKET_ROWS, QUERY_ROWS = 4096, 256
#: Longest vectors of a dimension that give the thresholds, and dimensions (the most frequent) that have such; others are not pruned.
SEED_ROWS, SEED_DIMS = 1024, 64
#: Lengths of a class differ by this factor at most, so all doubles make under 30,000 classes.
CLASS_RATIO = 1.05
#: Local cosine threshold from which coordinates prune, and how many of the query's take part.
COORDINATE_THRESHOLD, FOCUS = 0.6, 12

#: Blocks whose facts are broadcast at most (under 50 MB), and salts of queries beyond.
BROADCAST_BLOCKS, SALTS = 100_000, 64

_TYPES = (np.int8, np.int16, np.float32, np.float64)


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): vectors with an integer id that are neither null nor hold null or non-finite components; v in double."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), v.alias("v"), good.alias("good")).where("good").drop("good")


def narrow(v: np.ndarray) -> bytes:
    """Components in the narrowest type that holds them exactly."""
    for kind in _TYPES:
        with np.errstate(invalid="ignore", over="ignore"):
            small = v.astype(kind)
        if (small.astype(np.float64) == v).all():
            return small.tobytes()
    raise ValueError("components are not finite")


def wide(data: bytes, rows: int, dim: int) -> np.ndarray:
    """What ``narrow`` packed, in double (rows x dim)."""
    size = len(data) // max(1, rows * dim)
    kind = next((t for t in _TYPES if np.dtype(t).itemsize == size), np.float64)
    return np.frombuffer(data, kind).astype(np.float64).reshape(rows, dim)


def in_blocks(rows: int, keys: int, emit: Callable[[list, np.ndarray, np.ndarray, list[np.ndarray], int], pa.RecordBatch]):
    """Packs sorted rows (keys.., id, v, numbers..) into blocks of at most ``rows`` that agree in all keys.

    ``emit`` gets the keys, the ids, the vectors, the numbers, and how many blocks the task has made before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        made = 0
        source = iter(batches)
        while True:
            batch = next(source, None)
            if batch is not None:
                new = pa.Table.from_batches([batch])
                held = new if held is None else pa.concat_tables([held, new])
                if held.num_rows < rows:
                    continue
            if held is None:
                return
            whole = held.combine_chunks()
            n = whole.num_rows
            edge = np.zeros(max(n - 1, 0), bool)
            for k in range(keys):
                column = whole.column(k).to_numpy()
                edge |= column[1:] != column[:-1]
            cuts = [0, *(np.flatnonzero(edge) + 1), n]
            done = 0
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                for lo in range(a, b, rows):
                    hi = min(b, lo + rows)
                    if hi == n and hi - lo < rows and batch is not None:
                        continue
                    part = whole.slice(lo, hi - lo)
                    flat = part.column(keys + 1).combine_chunks().flatten().to_numpy(zero_copy_only=False)
                    yield emit([part.column(k)[0].as_py() for k in range(keys)], part.column(keys).to_numpy(), flat.reshape(hi - lo, -1), [part.column(k).to_numpy() for k in range(keys + 2, part.num_columns)], made)
                    made, done = made + 1, hi
            held = whole.slice(done) if done < n else None
            if batch is None:
                return

    return run


def with_block_names(packed: DataFrame) -> DataFrame:
    """Blocks with a number of their own, from the task that made them and their place there; kept."""
    return kept(packed.withColumn("block", F.shiftleft(F.spark_partition_id().cast("long"), 32) + F.col("part")).drop("part"))


def _bucket(keys: list, ids: np.ndarray, v: np.ndarray, _: list[np.ndarray], made: int) -> pa.RecordBatch:
    longest = float(np.sqrt((v * v).sum(1)).max())
    return pa.RecordBatch.from_arrays(
        [pa.array([keys[0]], pa.int32()), pa.array([keys[1]], pa.int32()), pa.array([made], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([longest]), pa.array([ids.astype(np.int64).tobytes()], pa.binary()), pa.array([narrow(v)], pa.binary())],
        names=["dim", "class", "part", "size", "longest", "ids", "vectors"],
    )


def length_of(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def length_class(length: Column) -> Column:
    """Number of the class of a length; a length of 0 is below all."""
    return F.when(length > 0, F.floor(F.log(length) / float(np.log(CLASS_RATIO)))).otherwise(-(1 << 20)).cast("int")


def buckets_of(vectors: DataFrame, rows: int) -> DataFrame:
    """Buckets (block, dim, class, size, longest, ids, vectors) of rows (id, v): each of one class, the longest first."""
    rows_ = vectors.select(F.size("v").alias("dim"), length_of(F.col("v")).alias("length"), "id", "v")
    # ties in length are dealt by id, so that equal vectors do not share one task
    order = ["dim", F.desc("length"), "id"]
    dealt = rows_.repartitionByRange(*order).sortWithinPartitions(*order).select("dim", length_class(F.col("length")).alias("class"), "id", "v")
    return with_block_names(dealt.mapInArrow(in_blocks(rows, 2, _bucket), "dim int, class int, part int, size int, longest double, ids binary, vectors binary"))


def _pack_queries(keys: list, ids: np.ndarray, v: np.ndarray, more: list[np.ndarray], made: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([keys[0]], pa.int64()), pa.array([v.shape[1]], pa.int32()), pa.array([ids.astype(np.int64).tobytes()], pa.binary()), pa.array([narrow(v)], pa.binary()), pa.array([more[0].astype(np.float64).tobytes()], pa.binary())],
        names=["block", "dim", "q_ids", "q_vectors", "bounds"],
    )


def met(routed: DataFrame, blocks: DataFrame, rows: int = QUERY_ROWS) -> DataFrame:
    """Rows (dim, q_ids, q_vectors, bounds, ids, vectors) of routed queries (block, id, v, bound) and their blocks.

    Queries are dealt by range of block and id, so those of one block spread over tasks, and are packed by
    block before they meet it.
    """
    packs = routed.select("block", "id", "v", "bound").repartitionByRange("block", "id").sortWithinPartitions("block", "id")
    packs = packs.mapInArrow(in_blocks(rows, 1, _pack_queries), "block long, dim int, q_ids binary, q_vectors binary, bounds binary")
    return packs.join(blocks.select("block", "ids", "vectors"), "block").select("dim", "q_ids", "q_vectors", "bounds", "ids", "vectors")


def unpacked(row: dict) -> tuple[np.ndarray, ...]:
    """Query ids, queries, bounds, ids and vectors of a row of ``met``."""
    qi, ci = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
    d = row["dim"]
    return qi, wide(row["q_vectors"], len(qi), d), np.frombuffer(row["bounds"], np.float64), ci, wide(row["vectors"], len(ci), d)


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of batches, of which only one is held as Python values."""
    for batch in batches:
        for r in range(batch.num_rows):
            yield batch.slice(r, 1).to_pylist()[0]


def exact_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of integer-valued rows, exact: in double while that is exact, else in 64-bit integers."""
    if np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(1, q.shape[1]) < 2**53:
        return (q @ c.T).astype(np.int64)
    return q.astype(np.int64) @ c.astype(np.int64).T


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(score) > k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= kth)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def _search(k: int, threshold: float, focus: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of queries and a bucket the k best candidates of each query that reach the query's threshold."""
        for row in one_by_one(batches):
            qi, q, floor, ci, c = unpacked(row)
            ql, cl = np.sqrt((q * q).sum(1)), np.sqrt((c * c).sum(1))
            longest = cl.max(initial=0)
            with np.errstate(divide="ignore", invalid="ignore"):
                local = np.where(ql * longest > 0, floor / (ql * longest), np.where(floor > 0, np.inf, -np.inf))
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

            def add(n: int, at: np.ndarray, score: np.ndarray, out=out, qi=qi, ci=ci, floor=floor) -> None:
                use = (score >= floor[n]) & (ci[at] != qi[n])
                at, score = at[use], score[use]
                best = _best(score, ci[at], k)
                out.append((np.full(len(best), qi[n]), ci[at[best]], score[best]))

            for n in np.flatnonzero((local >= threshold) & (local <= 1 + 1e-9)):
                f = np.argsort(-np.abs(q[n]), kind="stable")[:focus]
                part = c[:, f] @ q[n, f]
                rest = np.sqrt(np.maximum(cl**2 - (c[:, f] ** 2).sum(1), 0)) * np.sqrt(max(ql[n] ** 2 - (q[n, f] ** 2).sum(), 0))
                at = np.flatnonzero(part + rest >= floor[n] - 1e-6 * (1 + abs(floor[n])))
                add(n, at, exact_products(q[n : n + 1], c[at])[0])
            low = np.flatnonzero(local < threshold)
            for lo in range(0, len(low), 64):
                some = low[lo : lo + 64]
                need = np.where(ql[some] > 0, floor[some] / np.maximum(ql[some], 1e-300), -np.inf).min()
                at = np.flatnonzero(cl >= need - 1e-6 * (1 + abs(need))) if need > 0 else np.arange(len(ci))
                scores = exact_products(q[some], c[at])
                for n, score in zip(some, scores, strict=True):
                    add(n, at, score)
            cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in cols], names=["query_id", "vec_id", "score"])

    return run


def _seeds(buckets: DataFrame, seed_rows: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of the longest of each of the most frequent dimensions: a bounded number of rows."""
    about = buckets.groupBy("dim").agg(F.max_by("block", F.struct("longest", "size")).alias("block"), F.sum("size").alias("n"))
    top = [r["block"] for r in about.orderBy(F.desc("n"), "dim").limit(SEED_DIMS).collect()]
    out = {}
    for r in buckets.where(F.col("block").isin(top)).select("dim", "size", "ids", "vectors").toLocalIterator():
        ids, v = np.frombuffer(r["ids"], np.int64), wide(r["vectors"], r["size"], r["dim"])
        out[r["dim"]] = ids[:seed_rows], v[:seed_rows]
    return out


def sent_to(asked: DataFrame, about: DataFrame, keys: list[str]) -> DataFrame:
    """Queries with every block of their ``keys``.

    Keys have few values, so neither side may be dealt by them alone: facts about blocks (a number or two each) are broadcast up to
    ``BROADCAST_BLOCKS``, and beyond that queries are dealt by a salt as well, with a copy of the facts for each.
    """
    if about.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS:
        return asked.join(F.broadcast(about), keys)
    copies = about.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return asked.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(copies, [*keys, "salt"]).drop("salt")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest scores of each query, ties to smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_products(vectors: DataFrame, queries: DataFrame, k: int = K, bucket_rows: int = BUCKET_ROWS, seed_rows: int = SEED_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query (id, v) the k highest inner products among vectors (id, v).

    Components are integers held as doubles, products are exact. A query is not its own
    candidate; ties go to the smaller id; only vectors of the same dimension compare. With fewer than k candidates
    all are returned; empty tables give an empty result. Ids are distinct; a repeated row counts as often as it stands there.
    """
    buckets = buckets_of(vectors, bucket_rows)
    context = vectors.sparkSession.sparkContext
    seeds = context.broadcast(_seeds(buckets, seed_rows))
    # one number a length class: which classes there are is bounded by the range of doubles
    classes: dict[int, list[int]] = {}
    for r in buckets.select("dim", "class").distinct().orderBy("dim", "class").toLocalIterator():
        classes.setdefault(r["dim"], []).append(r["class"])
    known = context.broadcast({d: np.array(c, np.int32) for d, c in classes.items()})

    @F.arrow_udf("struct<bound:double,classes:array<int>>")
    def route(ids: pa.Array, v: pa.Array) -> pa.Array:
        """The threshold of each query, and the length classes that may hold something above it."""
        sizes, flat = np.diff(v.offsets.to_numpy()), v.flatten().to_numpy(zero_copy_only=False)
        ends, qi = np.cumsum(sizes), ids.to_numpy()
        floor, wanted = np.full(len(sizes), -np.inf), [np.zeros(0, np.int32)] * len(sizes)
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            for lo in range(0, len(at), 256):
                some = at[lo : lo + 256]
                q = flat[(ends[some] - d)[:, None] + np.arange(d)]
                if d in seeds.value and len(seeds.value[d][0]) > k:
                    score = exact_products(q, seeds.value[d][1]).astype(np.float64)
                    score[qi[some][:, None] == seeds.value[d][0]] = -np.inf
                    floor[some] = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
                have = known.value.get(int(d), wanted[0])
                top = CLASS_RATIO ** np.minimum(have.astype(float) + 1, np.log(1e300) / np.log(CLASS_RATIO))
                for n, length in zip(some, np.sqrt((q * q).sum(1)), strict=True):
                    wanted[n] = have[top * length * (1 + 1e-9) >= floor[n]]
        offsets = np.cumsum([0] + [len(w) for w in wanted]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(wanted) if wanted else np.zeros(0, np.int32)))
        return pa.StructArray.from_arrays([pa.array(floor), lists], names=["bound", "classes"])

    asked = queries.withColumn("to", route("id", "v")).select("id", "v", F.size("v").alias("dim"), length_of(F.col("v")).alias("length"), F.col("to.bound").alias("bound"), F.explode("to.classes").alias("class"))
    about = buckets.select("block", "dim", "class", "longest")
    routed = sent_to(asked, about, ["dim", "class"]).where(F.col("length") * F.col("longest") * (1 + 1e-9) >= F.col("bound"))
    return ranked(met(routed, buckets).mapInArrow(_search(k, COORDINATE_THRESHOLD, FOCUS), "query_id long, vec_id long, score long"), k)


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer products of every twentieth vector among all others."""
    vectors = usable(table(spark, sf_dir, "embeddings"))
    whole = vectors.select("id", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")).alias("v"))
    return top_products(whole, whole.where(F.col("id") % QUERY_STEP == 0))


ORACLE = {
    "op2_exact_topk": """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
}
QUERIES = {"op2_exact_topk": op2_exact_topk}
