"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

#: Element type of a list of text spans: code points, end exclusive.
SPAN_DDL = "array<struct<kind:string,start:int,end:int>>"
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


#: Rows of a few numbers up to this many are broadcast in rounds that label components; more are joined by a shuffle.
BROADCAST_LABELS = 200_000

#: Rows and bytes of a batch between JVM and Python: texts and sets are long, and both sides hold a batch or two at once.
BATCH_ROWS, BATCH_BYTES = 2048, 4 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the session's Python workers, once a context, as --py-files would.

    Also keeps batches small, unless the session has set their size itself.
    """
    batch = "spark.sql.execution.arrow.max%sPerBatch"
    for name, usual, most in ((batch % "Records", ("10000",), BATCH_ROWS), (batch % "Bytes", ("64MB", "64m", "67108864", "67108864b"), BATCH_BYTES)):
        if spark.conf.get(name) in usual:
            spark.conf.set(name, str(most))
    context = spark.sparkContext
    if getattr(context, "_skillgrid_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="skillgrid-")) / "skillgrid-src.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._skillgrid_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of the folder; any path that Spark reads."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``: which side of a hold-out a row is on."""
    return F.crc32(doc_id.cast("string")) % modulus


def texts_of(array: pa.Array) -> list[str]:
    """A string array as Python strings, null as empty."""
    return [t or "" for t in array.to_pylist()]


def spans_array(rows: list[list[tuple[str, int, int]]]) -> pa.Array:
    """Lists of (kind, start, end) as an Arrow array of ``SPAN_ARROW``."""
    flat = [s for r in rows for s in r]
    offsets = [0]
    for r in rows:
        offsets.append(offsets[-1] + len(r))
    items = pa.StructArray.from_arrays(
        [
            pa.array([s[0] for s in flat], pa.string()),
            pa.array([s[1] for s in flat], pa.int32()),
            pa.array([s[2] for s in flat], pa.int32()),
        ],
        names=["kind", "start", "end"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)


def span_text(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    part = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(part, ",")


def span_count(spans: Column, kind: str) -> Column:
    """Number of spans of one kind, as long."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    """SHA-256 of the text of the spans of the given kinds."""
    return F.sha2(span_text(F.filter(spans, lambda s: s["kind"].isin(*kinds))), 256)


def storage_folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local session that names none, as in tests, gets one of its own."""
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def kept(df: DataFrame, small: bool = False) -> DataFrame:
    """``df`` computed once and read from reliable storage from then on, its lineage cut.

    ``small`` says that rows are few against the input; they are then kept in an eighth as
    many files as shuffles have partitions, which grows with the cluster's setting.
    """
    spark = df.sparkSession
    storage_folder(spark)
    if small:
        df = df.coalesce(max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    return df.checkpoint()


def _local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, root) of every end of a task's links (a, b): the smallest id that the task's own links reach."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        at = root.setdefault(x, x)
        while root[at] != at:
            root[at] = root[root[at]]
            at = root[at]
        return at

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    ids = list(root)
    for lo in range(0, len(ids), 1 << 16):
        some = ids[lo : lo + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([find(x) for x in some], pa.int64())], names=["id", "root"])


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): (id, component), component the smallest id that links reach.

    Every task first replaces its own links by stars. An id has at most one root a task; where it has
    several, these belong together. So only roots are joined further: each round takes the smallest
    label among a root and its neighbours, and the label of that label, so that long chains need
    few rounds. Labels only fall, so their sum tells whether a round changed any.
    """
    stars = links.select("a", "b").mapInArrow(_local_roots, "id long, root long")
    of = kept(stars.groupBy("id").agg(F.min("root").alias("root"), F.collect_set("root").alias("roots")), small=True)
    several = of.where(F.size("roots") > 1).select(F.explode("roots").alias("a"), F.col("root").alias("b"))
    edges = kept(several.where("a <> b").distinct(), small=True)
    if edges.isEmpty():
        return of.select("id", F.col("root").alias("component"))
    ends = edges.union(edges.select("b", "a"))
    label = kept(ends.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")), small=True)
    total = None
    while True:
        seen = label.agg(F.sum(F.col("component").cast("decimal(38,0)")).alias("t"), F.count("*").alias("n")).first()
        was, total = total, seen["t"]
        few = F.broadcast if seen["n"] <= BROADCAST_LABELS else lambda rows: rows
        if total == was:
            break
        met = ends.join(few(label.withColumnRenamed("id", "b")), "b").select("a", "component").union(label)  # and its own
        near = kept(met.groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near")), small=True)
        beyond = near.select(F.col("id").alias("near"), F.col("near").alias("component"))
        label = kept(near.join(few(beyond), "near").select("id", "component"), small=True)
    found = of.join(few(label.withColumnRenamed("id", "root")), "root", "left")
    return kept(found.select("id", F.coalesce("component", "root").alias("component")), small=True)


def give_back() -> None:
    """Gives memory that this process has freed back to the system.

    Workers live on from task to task, and both allocators, Arrow's and C's, keep what the largest one needed.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over the batches of a task, after which the worker gives back what it has freed."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def in_slices(f: Callable[..., pa.Array], *arrays: pa.Array, rows: int = 256) -> pa.Array:
    """``f`` over slices of a batch, put together again: bounds what Python holds beside the batch itself."""
    n = len(arrays[0])
    parts = [f(*(a.slice(lo, rows) for a in arrays)) for lo in range(0, max(n, 1), rows)]
    give_back()
    return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)
