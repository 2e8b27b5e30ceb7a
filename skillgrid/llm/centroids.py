"""Centroid clustering (Lloyd's rounds) over subvector dictionaries, in exact integers.

Vectors are packed once, where they are read, into segments of bounded size. In a segment each block of dimensions is
replaced, without loss, by a dictionary of its distinct subvectors and a code a vector. Blocks begin as single dimensions; neighbours are
joined as long as the joint dictionary stays small against the rows, so every segment gets the widths that suit it.

In a round, the squared distances of each dictionary's subvectors from all centroids are computed once, and a
vector's distance is the sum of the entries that its codes name. New centroids follow from how often each code occurs in
each cluster. Only sums of clusters by dimension leave a segment: centroids x dimensions numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, table

DIMENSIONS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, 1
#: Vectors of a segment at most; neighbouring blocks are joined while their dictionary has at most this share of the rows.
SEGMENT_ROWS, JOIN_SHARE = 1 << 15, 1 / 4
#: Largest size of a component, so that 64 squared differences fit into 64 bits.
LARGEST = 1 << 27


def whole_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(id, v): vectors of the wanted dimensions without null or non-finite components, as integers floor(scale * x).

    An integer beyond ``LARGEST`` is an error, as distances would pass 64 bits.
    """
    v = F.col(vector).cast("array<double>")
    good = (F.size(v) == dimensions) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.lit(float(LARGEST))
    whole = lambda x: F.when(F.abs(F.lit(float(scale)) * x) <= largest, F.floor(F.lit(float(scale)) * x)).otherwise(F.raise_error(F.lit("a component is too large for exact distances")))
    return vectors.select(F.col(key).cast("long").alias("id"), v.alias("v"), F.coalesce(good, F.lit(False)).alias("good")).where("good").select("id", F.transform("v", whole).alias("v"))


def encoded(v: np.ndarray, share: float = JOIN_SHARE) -> list[tuple[np.ndarray, np.ndarray]]:
    """Dictionary (distinct x width) and codes of each block of dimensions; ``dictionary[codes]`` side by side is ``v``."""
    blocks = []
    for k in range(v.shape[1]):
        words, codes = np.unique(v[:, k], return_inverse=True)
        blocks.append((words[:, None], codes.reshape(-1)))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        joined, out, k = False, [], 0
        while k < len(blocks):
            if k + 1 < len(blocks):
                (a, x), (b, y) = blocks[k], blocks[k + 1]
                both, codes = np.unique(x.astype(np.int64) * len(b) + y, return_inverse=True)
                if len(both) <= share * len(v):
                    out.append((np.concatenate([a[both // len(b)], b[both % len(b)]], axis=1), codes.reshape(-1)))
                    joined, k = True, k + 2
                    continue
            out.append(blocks[k])
            k += 1
        done = blocks = out
        if not joined:
            return done


def _pack(ids: pa.Array, v: np.ndarray) -> pa.RecordBatch:
    """A segment: ids, the widths and sizes of its dictionaries, their subvectors, and the codes."""
    blocks = encoded(v)
    kind = next(t for t in (np.int8, np.int16, np.int32) if np.iinfo(t).min <= v.min(initial=0) and v.max(initial=0) <= np.iinfo(t).max)
    shape = np.array([kind().itemsize, *(n for d, _ in blocks for n in d.shape)], np.int32)
    words = b"".join(d.astype(kind).tobytes() for d, _ in blocks)
    codes = b"".join(c.astype(np.uint8 if len(d) <= 256 else np.uint16).tobytes() for d, c in blocks)
    columns = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array([x], pa.binary()) for x in (shape.tobytes(), words, codes))]
    return pa.RecordBatch.from_arrays(columns, names=["ids", "shape", "words", "codes"])


def _unpack(row: dict) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    shape, n = np.frombuffer(row["shape"], np.int32), row["n"]
    kind, blocks, w, c = np.dtype(f"i{shape[0]}"), [], 0, 0
    for size, width in shape[1:].reshape(-1, 2).tolist():
        words = np.frombuffer(row["words"], kind, size * width, w).astype(np.int64).reshape(size, width)
        code = np.dtype(np.uint8 if size <= 256 else np.uint16)
        blocks.append((words, np.frombuffer(row["codes"], code, n, c)))
        w, c = w + size * width * kind.itemsize, c + n * code.itemsize
    return blocks, n


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0

    def emit(t: pa.Table) -> pa.RecordBatch:
        flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return _pack(t.column("id").combine_chunks(), flat.reshape(t.num_rows, -1))

    for batch in batches:
        held, rows = [*held, batch], rows + batch.num_rows
        while rows >= SEGMENT_ROWS:
            whole = pa.Table.from_batches(held)
            yield emit(whole.slice(0, SEGMENT_ROWS).combine_chunks())
            held, rows = whole.slice(SEGMENT_ROWS).to_batches(), rows - SEGMENT_ROWS
    if rows:
        yield emit(pa.Table.from_batches(held).combine_chunks())


def segments_of(vectors: DataFrame) -> DataFrame:
    """Packed segments (ids, shape, words, codes) of rows (id, v), kept; vectors stay where they were read."""
    return kept(vectors.mapInArrow(_segments, "ids array<long>, shape binary, words binary, codes binary"))


def nearest(blocks: list[tuple[np.ndarray, np.ndarray]], n: int, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, ties to the smaller number, and its squared distance."""
    total, at = np.zeros((n, len(centroids)), np.int64), 0
    for words, codes in blocks:
        gap = words[:, None, :] - centroids[None, :, at : at + words.shape[1]]
        total += (gap * gap).sum(2)[codes]
        at += words.shape[1]
    best = total.argmin(1)
    return best, total[np.arange(n), best]


def _each(segments: DataFrame, f, schema: str) -> DataFrame:
    """``f`` of (ids, blocks, n) of every segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column(0)[k].values
                row = {name: batch.column(name)[k].as_py() for name in ("shape", "words", "codes")}
                yield f(ids, *_unpack(row | {"n": len(ids)}))

    return segments.mapInArrow(run, schema)


def moved(segments: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: floor of the mean of what is nearest to each; those without vectors stay."""

    def sums(_: pa.Array, blocks: list[tuple[np.ndarray, np.ndarray]], n: int) -> pa.RecordBatch:
        best, _ = nearest(blocks, n, centroids)
        out = []
        for words, codes in blocks:
            times = np.bincount(best * len(words) + codes, minlength=len(centroids) * len(words)).reshape(len(centroids), -1)
            out.append(times @ words)
        total = np.concatenate(out, axis=1)
        count = np.bincount(best, minlength=len(centroids))
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(centroids)), pa.int32()), pa.array(count, pa.int64()), pa.array(total.tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = _each(segments, sums, "cluster int, n long, sums array<long>")
    exact = lambda x: F.sum(F.col(x).cast("decimal(38,0)")).alias(x)
    found = parts.select("cluster", "n", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at").agg(exact("n"), exact("s"))
    new = centroids.copy()
    for r in found.where("n > 0").collect():
        new[r["cluster"], r["at"]] = int(r["s"]) // int(r["n"])
    return new


def starts(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:id``, in that order; vectors without an id are none."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.where(F.col("id").isNotNull()).select(name.alias("name"), "v").orderBy("name", "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64)


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of rows (id, v) of whole numbers.

    Distances are squared. Fewer vectors than clusters make fewer clusters, and no vector, or none with an id, an empty result. Rows that repeat an
    id are each assigned; if they are among the starts, all of them are, ordered by their vectors. Nothing but ids and vectors is read.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, cluster int, distance long"
    centroids = starts(vectors, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], schema + ", cluster_inertia long, inertia long, centroid_sha256 string")
    segments = segments_of(vectors)
    for _ in range(rounds):
        centroids = moved(segments, centroids)

    def costs(_: pa.Array, blocks: list[tuple[np.ndarray, np.ndarray]], n: int) -> pa.RecordBatch:
        best, far = nearest(blocks, n, centroids)
        use = np.unique(best)
        # a segment's distances are summed in Python's integers
        return pa.RecordBatch.from_arrays([pa.array(use, pa.int32()), pa.array([str(sum(far[best == c].tolist())) for c in use])], names=["cluster", "cost"])

    def assigned(ids: pa.Array, blocks: list[tuple[np.ndarray, np.ndarray]], n: int) -> pa.RecordBatch:
        best, far = nearest(blocks, n, centroids)
        return pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(far)], names=["vec_id", "cluster", "distance"])

    cost = {r["cluster"]: int(r["cost"]) for r in _each(segments, costs, "cluster int, cost string").groupBy("cluster").agg(F.sum(F.col("cost").cast("decimal(38,0)")).alias("cost")).collect()}
    name = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    about = [(k, cost.get(k, 0), sum(cost.values()), name(c)) for k, c in enumerate(centroids)]
    table_ = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return _each(segments, assigned, schema).join(F.broadcast(table_), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 16 clusters after 3 rounds."""
    return clustered(whole_vectors(table(spark, sf_dir, "embeddings")))


def _oracle() -> str:
    """Three rounds, each written out: distances by list arithmetic, then floors of exact means."""
    parts = [
        f"e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS INT) AS cluster, v AS c FROM e ORDER BY cluster LIMIT {CLUSTERS})",
    ]
    distance = "CAST(list_sum(list_transform(list_zip(e.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    for k in range(ROUNDS + 1):
        parts.append(f"a{k} AS (SELECT vec_id, v, min_by(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (SELECT e.vec_id, e.v, c.cluster, {distance} AS d FROM e, c{k} c) GROUP BY vec_id, v)")
        if k < ROUNDS:
            parts += [
                f"s{k} AS (SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range({DIMENSIONS})) AS i FROM a{k}) GROUP BY cluster, i)",
                f"m{k} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM s{k} GROUP BY cluster)",
                f"c{k + 1} AS (SELECT c.cluster, coalesce(m.m, c.c) AS c FROM c{k} c LEFT JOIN m{k} m USING (cluster))",
            ]
    last = f"a{ROUNDS}"
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM {last} a JOIN c{ROUNDS} c ON c.cluster = a.cluster"""


QUERIES = {"op11_centroid_clusters": op11_centroid_clusters}
ORACLE = {"op11_centroid_clusters": _oracle()}
