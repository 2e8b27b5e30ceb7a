"""Approximate nearest neighbours by stable projections and kd-trees.

Vectors are normalised, so that the largest cosine is the smallest distance,
and projected to ``PROJECTED`` dimensions by Gaussian (2-stable) directions: the
squared projected distance of a pair is its squared distance times a chi-square variable. A
kd-tree fitted on a bounded sample of projections cuts space into cells, every
row is indexed in its cell's blocks, and each block has a kd-tree of its own.

A query first searches a block of its own cell and so gets a bound on the distance
of its k-th neighbour. Then it travels to the cells, and in them to the blocks, that lie within the
test for its own bound; blocks stay where they are dealt. In a block it verifies rows in order of projected
distance, until the chi-square test holds: anything nearer than the k-th neighbour found would,
with probability ``CONFIDENCE``, have been projected nearer than the next row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, table
from .topk import in_blocks, met, narrow, one_by_one, ranked, sent_to, unpacked, usable, with_block_names

K, QUERY_STEP = 5, 50
#: Projected dimensions (even, for the closed form of the chi-square distribution).
PROJECTED = 16
#: Probability of the stopping test; the expected recall is at least this.
CONFIDENCE = 0.95
#: Rows the cells are fitted on, at most; the index itself holds every row.
SAMPLE_ROWS = 20_000
BLOCK_ROWS, LEAF_ROWS = 4096, 64
MAX_CELLS = 1 << 14
_EPS = 1e-9


def chi_square(x: float, m: int = PROJECTED) -> float:
    """Distribution function for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 0.0
    for i in range(m // 2):
        total += term
        term *= half / (i + 1)
    return 1 - math.exp(-half) * total


def stop_ratio(confidence: float = CONFIDENCE, m: int = PROJECTED) -> float:
    """The squared projected distance over the squared distance at which the test holds."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(mid, m) < confidence else (lo, mid)
    return hi


def directions(dim: int, m: int = PROJECTED) -> np.ndarray:
    """The fixed Gaussian directions for vectors of one dimension."""
    return np.random.default_rng(1_000_003 * m + dim).standard_normal((dim, m))


def project(v: np.ndarray) -> np.ndarray:
    return (v / np.sqrt((v * v).sum(1, keepdims=True))) @ directions(v.shape[1])


def kd_leaves(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Places of the points in each leaf of a kd-tree: medians along the widest side."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        at = todo.pop()
        if len(at) <= leaf:
            out.append(at)
            continue
        axis = np.ptp(points[at], axis=0).argmax()
        order = at[np.argsort(points[at, axis], kind="stable")]
        todo += [order[: len(order) // 2], order[len(order) // 2 :]]
    return out


def _cell_tree(points: np.ndarray, cells: int) -> list[tuple[int, float]]:
    """Splits (axis, value) of a complete tree in heap order over a sample."""
    depth = max(0, (cells - 1).bit_length())
    splits: list[tuple[int, float]] = []
    level = [np.arange(len(points))]
    for _ in range(depth):
        below = []
        for at in level:
            if len(at):
                axis = int(np.ptp(points[at], axis=0).argmax())
                value = float(np.median(points[at, axis]))
                low = points[at, axis] < value
            else:
                axis, value, low = 0, 0.0, np.zeros(0, bool)
            splits.append((axis, value))
            below += [at[low], at[~low]]
        level = below
    return splits


def _cells_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    axis, value = np.array([s[0] for s in splits] or [0]), np.array([s[1] for s in splits] or [0.0])
    node, row = np.zeros(len(points), np.int64), np.arange(len(points))
    while len(splits) and len(node) and node[0] < len(splits):
        node = 2 * node + 1 + (points[row, axis[node]] >= value[node])
    return node - len(splits)


def _sample_trees(vectors: DataFrame, block_rows: int) -> dict[int, list[tuple[int, float]]]:
    """Cell trees by dimension, fitted on the projections of at most about ``SAMPLE_ROWS`` rows of all dimensions."""
    total = vectors.count()
    share = min(1.0, SAMPLE_ROWS / max(1, total))

    @F.arrow_udf("array<double>")
    def projected(v: pa.Array) -> pa.Array:
        return _by_dim(v, lambda rows, _: project(rows).tolist(), _POINT)

    drawn = vectors.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
    got = drawn.select(F.size("v").alias("dim"), projected("v").alias("p")).toArrow()
    points: dict[int, list] = {}
    for dim, p in zip(got.column("dim").to_pylist(), got.column("p").to_pylist(), strict=True):
        points.setdefault(dim, []).append(p)
    return {d: _cell_tree(np.array(p), min(MAX_CELLS, -(-int(len(p) / share) // block_rows))) for d, p in points.items()}


_POINT = pa.list_(pa.float64())


def _by_dim(v: pa.Array, f: Callable[[np.ndarray, int], list], kind: pa.DataType) -> pa.Array:
    """``f`` of the rows of each dimension and its number, put back in order."""
    sizes, flat = np.diff(v.offsets.to_numpy()), v.flatten().to_numpy(zero_copy_only=False)
    ends, out = np.cumsum(sizes), [None] * len(sizes)
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        for k, value in zip(at, f(flat[(ends[at] - d)[:, None] + np.arange(d)], int(d)), strict=True):
            out[k] = value
    return pa.array(out, kind)


def _regions(splits: list[tuple[int, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest coordinates of each cell of a tree (cells x projected dimensions)."""
    lo, hi = np.full((1, PROJECTED), -np.inf), np.full((1, PROJECTED), np.inf)
    at = 0
    while at < len(splits):
        n = len(lo)
        axis, value = np.array([s[0] for s in splits[at : at + n]]), np.array([s[1] for s in splits[at : at + n]])
        lo, hi = np.repeat(lo, 2, 0), np.repeat(hi, 2, 0)
        left, right = np.arange(0, 2 * n, 2), np.arange(1, 2 * n, 2)
        hi[left, axis], lo[right, axis] = np.minimum(hi[left, axis], value), np.maximum(lo[right, axis], value)
        at += n
    return lo, hi


def _gap(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance of a point from boxes."""
    return (np.maximum(np.maximum(lo - p, p - hi), 0) ** 2).sum(1)


def with_cells(vectors: DataFrame, trees: Broadcast) -> DataFrame:
    """(id, v, dim, cell) of every row (id, v)."""

    @F.arrow_udf("int")
    def cell(v: pa.Array) -> pa.Array:
        return _by_dim(v, lambda rows, d: _cells_of(project(rows), trees.value.get(d, [])).tolist(), pa.int32())

    return vectors.select("id", "v", F.size("v").alias("dim"), cell("v").alias("cell"))


def _block(keys: list, ids: np.ndarray, v: np.ndarray, _: list[np.ndarray], made: int) -> pa.RecordBatch:
    p = project(v)
    return pa.RecordBatch.from_arrays(
        [pa.array([keys[0]], pa.int32()), pa.array([keys[1]], pa.int32()), pa.array([made], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
         pa.array([narrow(v)], pa.binary()), pa.array([p.min(0).tolist()]), pa.array([p.max(0).tolist()])],
        names=["dim", "cell", "part", "size", "ids", "vectors", "lo", "hi"],
    )


def blocks_of(cells: DataFrame, rows: int) -> DataFrame:
    """Packed blocks (block, dim, cell, size, ids, vectors, lo, hi); rows are dealt by cell and id, so that a crowded cell is split."""
    dealt = cells.repartitionByRange("dim", "cell", "id").sortWithinPartitions("dim", "cell", "id").select("dim", "cell", "id", "v")
    return with_block_names(dealt.mapInArrow(in_blocks(rows, 2, _block), "dim int, cell int, part int, size int, ids binary, vectors binary, lo array<double>, hi array<double>"))


def cosines(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Cosines of one vector with rows; each row is summed alike, so that equal rows score alike."""
    return (c * q).sum(1) / (np.sqrt((c * c).sum(1)) * np.sqrt((q * q).sum()))


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def search_block(qi: np.ndarray, q: np.ndarray, far: np.ndarray, ci: np.ndarray, c: np.ndarray, k: int, ratio: float) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Of each query the k nearest rows of a block (ids, cosines) that it verifies before its test holds, and how many it verified.

    Verified rows are ranked by products of unit vectors; cosines are then computed from the vectors
    themselves for those that may be among the k.
    """
    pq, pc = project(q), project(c)
    unit_q, unit_c = (v / np.sqrt((v * v).sum(1, keepdims=True)) for v in (q, c))
    leaves = kd_leaves(pc, LEAF_ROWS)
    lo, hi = np.array([pc[x].min(0) for x in leaves]), np.array([pc[x].max(0) for x in leaves])
    away = np.maximum((pq * pq).sum(1)[:, None] + (pc * pc).sum(1) - 2 * pq @ pc.T, 0)
    for n in range(len(qi)):
        limit, seen, rows_seen, cos_seen = far[n], 0, np.zeros(0, np.int64), np.zeros(0)
        near = np.flatnonzero(_gap(pq[n], lo, hi) <= ratio * limit + _EPS)
        if len(near):
            rows = np.concatenate([leaves[x] for x in near])
            rows = rows[(away[n, rows] <= ratio * limit + _EPS) & (ci[rows] != qi[n])]
            rows = rows[np.argsort(away[n, rows], kind="stable")]
            at, step = 0, 4 * k
            while at < len(rows) and away[n, rows[at]] <= ratio * limit + _EPS:
                some = rows[at : at + step]
                some = some[away[n, some] <= ratio * limit + _EPS]
                rows_seen, cos_seen = np.concatenate([rows_seen, some]), np.concatenate([cos_seen, unit_c[some] @ unit_q[n]])
                if len(cos_seen) >= k:
                    kth = np.partition(cos_seen, len(cos_seen) - k)[len(cos_seen) - k]
                    may = cos_seen >= kth - _EPS
                    rows_seen, cos_seen, limit = rows_seen[may], cos_seen[may], min(limit, max(0.0, 2 - 2 * kth))
                seen, at, step = seen + len(some), at + step, 2 * step
        score, ids = cosines(q[n], c[rows_seen]), ci[rows_seen]
        top = _top(score, ids, k)
        yield ids[top], score[top], seen


def _search(k: int, ratio: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in one_by_one(batches):
            qi, q, far, ci, c = unpacked(row)
            out = [(np.full(len(i), qi[n]), i, s) for n, (i, s, _) in enumerate(search_block(qi, q, far, ci, c, k, ratio))]
            cols = [np.concatenate(x) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2])], names=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, confidence: float = CONFIDENCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors (id, v) found nearest to each query (id, v) by cosine.

    A query is not its own candidate; ties go to the smaller id; only vectors of
    one dimension compare, and vectors of length zero take no part; ``usable`` leaves out nulls and what is not finite
    before, and takes integer ids only (a text that is no number is an error). Of at most k candidates all are
    found. Ids are distinct; a repeated row counts as often as it stands there. Empty tables give an empty result.
    """
    ratio = stop_ratio(confidence)
    context = vectors.sparkSession.sparkContext
    vectors, queries = (df.where(F.exists("v", lambda x: x != 0)) for df in (vectors, queries))
    trees = context.broadcast(_sample_trees(vectors, block_rows))
    blocks = blocks_of(with_cells(vectors, trees), block_rows)
    asked = kept(with_cells(queries, trees))
    home = blocks.groupBy("dim", "cell").agg(F.max_by("block", "size").alias("block"))
    first = asked.join(home, ["dim", "cell"]).withColumn("bound", F.lit(float("inf")))
    schema = "query_id long, vec_id long, score double"
    seed = kept(met(first, blocks).mapInArrow(_search(k, ratio), schema))
    # the squared distance of the k-th found at home bounds where else a query goes
    far = seed.groupBy(F.col("query_id").alias("id")).agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") >= k)
    far = far.select("id", F.greatest(F.lit(0.0), 2 - 2 * F.col("least")).alias("far"))
    bounds = asked.join(far, "id", "left").withColumn("bound", F.coalesce("far", F.lit(float("inf"))))
    regions = context.broadcast({d: _regions(t) for d, t in trees.value.items()})

    @F.arrow_udf("struct<cells:array<int>,p:array<double>>")
    def route(v: pa.Array, bound: pa.Array) -> pa.Array:
        """The cells that lie within each query's test, and its projection."""
        limit = bound.to_numpy()
        p = _by_dim(v, lambda rows, _: project(rows).tolist(), _POINT)
        sizes, cells = np.diff(v.offsets.to_numpy()).tolist(), []
        for n, (d, x) in enumerate(zip(sizes, p.to_pylist(), strict=True)):
            lo, hi = regions.value.get(d, _regions([]))
            cells.append(np.flatnonzero(_gap(np.array(x), lo, hi) <= ratio * limit[n] + _EPS).tolist())
        return pa.StructArray.from_arrays([pa.array(cells, pa.list_(pa.int32())), p], names=["cells", "p"])

    routed = bounds.withColumn("to", route("v", "bound")).select("id", "v", "dim", "bound", F.col("cell").alias("home"), F.col("to.p").alias("p"), F.explode("to.cells").alias("cell"))
    side = F.transform(F.arrays_zip("lo", "hi", "p"), lambda z: F.pow(F.greatest(z["lo"] - z["p"], z["p"] - z["hi"], F.lit(0.0)), 2))
    gap = F.aggregate(side, F.lit(0.0), lambda s, x: s + x)
    about = blocks.select("block", "dim", "cell", "lo", "hi").join(home.select("block", F.lit(True).alias("is_home")), "block", "left")
    new = F.col("is_home").isNull() | (F.col("home") != F.col("cell"))
    routed = sent_to(routed, about, ["dim", "cell"]).where(new & (gap <= F.lit(ratio) * F.col("bound") + _EPS))
    return ranked(seed.union(met(routed, blocks).mapInArrow(_search(k, ratio), schema)), k)


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 vectors found nearest to every fiftieth vector."""
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.where(F.col("id") % QUERY_STEP == 0))


QUERIES = {"op3_nearest_neighbours": op3_nearest_neighbours}
ORACLE: dict[str, str] = {}
