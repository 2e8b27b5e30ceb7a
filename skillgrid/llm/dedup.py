"""Exact dedup over a cuckoo-filter index of live digests.

Digests (SHA-256 of the whole text) are dealt by their first bits to buckets of bounded size. Each bucket
holds the stored keys of its live digests and a cuckoo filter over them: a slot has 16 bits
of a digest and the place of its key, and a digest has two rows of four slots. A digest whose bits are in neither row
is new. A hit is never trusted: it is verified against the keys stored in the bucket. When
inserting pushes slots around for too long, the filter overflows and is made anew, twice as large, from the
stored keys. Deleting takes a digest's slot away once no live document has it.

Copies are counted within a task before they are dealt, so a text that a third of all documents share
reaches its bucket as a few rows a task.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, table

#: Slots of a row, and pushes before the filter counts as full.
SLOTS, MOST_PUSHES = 4, 200
#: Distinct digests of a bucket, about, and rows that a task counts together before it deals them.
BUCKET_ROWS, TASK_ROWS = 1 << 16, 1 << 17
#: Groups above so many rows, or a hundred-thousandth of all, are joined by broadcast: that many there are 100,000 at most.
HOT_ROWS, HOT_GROUPS = 100, 100_000
#: Keeper of a group whose keeper was deleted, until ``resolved`` finds the next; also stands for an id that is null.
UNKNOWN = np.iinfo(np.int64).min
_STATE = ("keys", "live", "count", "keep", "mark", "place")


class CuckooIndex:
    """Live digests (rows of four 64-bit words) with their number of documents and the largest of their ids."""

    def __init__(self, rows: int = 16) -> None:
        self.keys = np.zeros((0, 4), np.uint64)
        self.live = np.zeros(0, bool)
        self.count, self.keep = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.resizes = 0
        self._clear(rows)

    def _clear(self, rows: int) -> None:
        self.mark, self.place = np.zeros((rows, SLOTS), np.uint16), np.full((rows, SLOTS), -1, np.int32)

    def _rows(self, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The marks of digests and their two rows; either row follows from the other and the mark."""
        mark = ((d[:, 0] & np.uint64(0xFFFF)) | np.uint64(1)).astype(np.uint16)
        one = (d[:, 1] & np.uint64(len(self.mark) - 1)).astype(np.int64)
        return mark, one, one ^ self._step(mark)

    def _step(self, mark: np.ndarray) -> np.ndarray:
        return ((mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) & (len(self.mark) - 1)

    def find(self, d: np.ndarray) -> np.ndarray:
        """Places of digests, -1 where not live. Slots say where to look, stored keys whether it is so."""
        mark, one, two = self._rows(d)
        at = np.full(len(d), -1, np.int64)
        for row in (one, two):
            for s in range(SLOTS):
                hit = np.flatnonzero((self.mark[row, s] == mark) & (at < 0))
                place = self.place[row[hit], s].astype(np.int64)
                true = (self.keys[place] == d[hit]).all(1) & (place >= 0)
                at[hit[true]] = place[true]
        return at

    def _put(self, d: np.ndarray, places: np.ndarray) -> None:
        """Slots for stored keys: first free ones of either row, then by pushing others on."""
        mark, one, two = self._rows(d)
        left = np.arange(len(d))
        for row in (one, two) * SLOTS:
            if not len(left):
                return
            free = self.mark[row[left]] == 0
            able = left[free.any(1)]
            _, first = np.unique(row[able], return_index=True)
            now = able[first]
            s = (self.mark[row[now]] == 0).argmax(1)
            self.mark[row[now], s], self.place[row[now], s] = mark[now], places[now]
            left = np.setdiff1d(left, now, assume_unique=True)
        for k in left.tolist():
            m, p, row = int(mark[k]), int(places[k]), int(two[k])
            for turn in range(MOST_PUSHES):
                free = np.flatnonzero(self.mark[row] == 0)
                s = int(free[0]) if len(free) else (turn + p) % SLOTS
                m, self.mark[row, s] = int(self.mark[row, s]), m
                p, self.place[row, s] = int(self.place[row, s]), p
                if not m:
                    break
                row ^= int(self._step(np.array([m], np.uint16))[0])
            else:
                self._resize(2 * len(self.mark))
                return

    def _resize(self, rows: int) -> None:
        """A new filter from the stored keys of what is live."""
        self.resizes += 1
        self._clear(rows)
        at = np.flatnonzero(self.live)
        self._put(self.keys[at], at)

    @staticmethod
    def _once(d: np.ndarray, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each digest once, with its largest id and its sum."""
        order = np.lexsort((ids, d[:, 3], d[:, 2], d[:, 1], d[:, 0]))
        d, ids, n = d[order], ids[order], n[order]
        first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]).any(1)][: len(d)])
        last = np.r_[first[1:], len(d)] - 1
        return d[first], ids[last], np.add.reduceat(n, first) if len(d) else n

    def insert(self, d: np.ndarray, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Adds n documents of each digest, the largest id among them given; says which of the distinct digests are new."""
        d, ids, n = self._once(d, ids, n)
        at = self.find(d)
        old, new = at >= 0, at < 0
        self.count[at[old]] += n[old]
        self.keep[at[old]] = np.maximum(self.keep[at[old]], ids[old])
        places = np.arange(len(self.keys), len(self.keys) + new.sum())
        self.keys = np.concatenate([self.keys, d[new]])
        self.live = np.concatenate([self.live, np.ones(len(places), bool)])
        self.count, self.keep = np.concatenate([self.count, n[new]]), np.concatenate([self.keep, ids[new]])
        rows = len(self.mark)
        while self.live.sum() > 0.9 * SLOTS * rows:
            rows *= 2
        if rows > len(self.mark):
            self._resize(rows)
        else:
            self._put(d[new], places)
        return new

    def delete(self, d: np.ndarray, ids: np.ndarray) -> None:
        """Takes one document of each row away. A digest without documents leaves the filter; a group whose keeper left has an ``UNKNOWN`` one."""
        at = self.find(d)
        at, ids = at[at >= 0], ids[at >= 0]
        np.subtract.at(self.count, at, 1)
        self.keep[at[self.keep[at] == ids]] = UNKNOWN
        gone = np.unique(at[self.count[at] <= 0])
        _, one, two = self._rows(self.keys[gone])
        for row in (one, two):
            k, s = np.nonzero(self.place[row] == gone[:, None])
            self.mark[row[k], s], self.place[row[k], s] = 0, -1
        self.live[gone] = False
        if self.live.sum() < len(self.live) // 2:
            stay = self.live
            self.keys, self.count, self.keep, self.live = self.keys[stay], self.count[stay], self.keep[stay], self.live[stay]
            self._resize(len(self.mark))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: getattr(self, k) for k in _STATE})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooIndex:
        index = cls()
        with np.load(io.BytesIO(data)) as found:
            for k in _STATE:
                setattr(index, k, found[k])
        return index


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row: SHA-256 of the whole text, null as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"))


def _numbers(column: pa.Array) -> np.ndarray:
    return column.fill_null(UNKNOWN).to_numpy(zero_copy_only=False)


def _words(column: pa.Array) -> np.ndarray:
    """32-byte digests as rows of four words, most significant first."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 4)


def _bytes(d: np.ndarray) -> pa.Array:
    data = d.astype(">u8").tobytes()
    return pa.array([data[k : k + 32] for k in range(0, len(data), 32)], pa.binary())


def _counted(buckets: int):
    """(bucket, digest, doc_id, n): a task's rows of one digest together."""

    def emit(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        d, ids, n = CuckooIndex._once(_words(t.column("digest").combine_chunks()), _numbers(t.column("doc_id").combine_chunks()), np.ones(t.num_rows, np.int64))
        return pa.RecordBatch.from_arrays([pa.array((d[:, 0] >> np.uint64(32)).astype(np.int64) % buckets), _bytes(d), pa.array(ids), pa.array(n)], names=["bucket", "digest", "doc_id", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held, rows = [*held, batch], rows + batch.num_rows
            if rows >= TASK_ROWS:
                yield emit(held)
                held, rows = [], 0
        if rows:
            yield emit(held)

    return run


def _found(index: CuckooIndex, least: int) -> pa.RecordBatch:
    at = np.flatnonzero(index.live & (index.count >= least))
    keep = pa.array(index.keep[at], mask=index.keep[at] == UNKNOWN)
    return pa.RecordBatch.from_arrays([_bytes(index.keys[at]), keep, pa.array(index.count[at])], names=["digest", "keep_id", "group_size"])


def _grouped(least: int):
    """Groups of buckets that come sorted by bucket; a bucket's index is let go when the next begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, of = None, None
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1), len(bucket)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                if bucket[lo] != of:
                    if index is not None:
                        yield _found(index, least)
                    index, of = CuckooIndex(), bucket[lo]
                part = batch.slice(lo, hi - lo)
                index.insert(_words(part.column(1)), _numbers(part.column(2)), part.column(3).to_numpy())
        if index is not None:
            yield _found(index, least)

    return run


def bucket_count(spark: SparkSession, rows: int) -> int:
    """Buckets for so many rows: of bounded size each, and several for every shuffle partition."""
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))


def groups(rows: DataFrame, total: int, least: int = 2) -> DataFrame:
    """(digest, keep_id, group_size) of the digests that ``least`` rows (doc_id, digest) have, found by the buckets' indexes."""
    counted = rows.select("doc_id", "digest").mapInArrow(_counted(bucket_count(rows.sparkSession, total)), "bucket long, digest binary, doc_id long, n long")
    dealt = counted.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_grouped(least), "digest binary, keep_id long, group_size long")


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row (doc_id, text): of equal texts the largest id stays.

    A null text counts as empty and equals an empty one. A null id is smaller than all; if a whole group has null ids, its keep_id is null
    and its rows stay. Rows that repeat an id with its text are one document: they count in group_size and share their verdict. Other columns are
    ignored; an empty table gives an empty result.
    """
    rows = kept(digests(docs))
    total = rows.count()
    found = kept(groups(rows, total), small=True)
    hot = F.col("group_size") > max(HOT_ROWS, total // HOT_GROUPS)
    # a group that is joined by its digest has few rows, so none of its tasks is hot; the large ones are few
    large, small = F.broadcast(found.where(hot)), found.where(~hot)
    every = rows.join(large, "digest").unionByName(rows.join(large.select("digest"), "digest", "left_anti").join(small, "digest", "left"), allowMissingColumns=True)
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return every.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


_CHANGE = "bucket long, sign int, state binary, digest binary, doc_id long, n long"


def _changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """New states of buckets from rows sorted by bucket and sign: the old state (0), what is added (1), what is removed (2)."""

    def emit() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([of], pa.int64()), pa.array([index.to_bytes()], pa.binary())], names=["bucket", "state"])

    index, of = CuckooIndex(), None
    for batch in batches:
        key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1), key.shape[1]]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            if key[0, lo] != of:
                if of is not None:
                    yield emit()
                index, of = CuckooIndex(), int(key[0, lo])
            part, sign = batch.slice(lo, hi - lo), key[1, lo]
            if sign == 0:
                index = CuckooIndex.from_bytes(part.column(2)[0].as_py())
            elif sign == 1:
                index.insert(_words(part.column(3)), _numbers(part.column(4)), part.column(5).to_numpy())
            else:
                index.delete(_words(part.column(3)), _numbers(part.column(4)))
    if of is not None:
        yield emit()


def updated(index: DataFrame | None, added: DataFrame, removed: DataFrame | None, buckets: int) -> DataFrame:
    """The index (bucket, state) after inserting and deleting documents (doc_id, text); without one, a new index.

    Documents that are not in the index cannot be removed and are passed over. ``buckets`` is fixed for an index's life.
    """
    counted = digests(added).mapInArrow(_counted(buckets), "bucket long, digest binary, doc_id long, n long")
    null = lambda kind: F.lit(None).cast(kind)
    changes = counted.select("bucket", F.lit(1).alias("sign"), null("binary").alias("state"), "digest", "doc_id", "n")
    if removed is not None:
        away = digests(removed)
        first = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
        changes = changes.unionByName(away.select(F.pmod(first, F.lit(buckets)).alias("bucket"), F.lit(2).alias("sign"), null("binary").alias("state"), "digest", "doc_id", F.lit(1).cast("long").alias("n")))
    if index is not None:
        changes = changes.unionByName(index.select("bucket", F.lit(0).alias("sign"), "state", null("binary").alias("digest"), null("long").alias("doc_id"), null("long").alias("n")))
    return changes.repartition("bucket").sortWithinPartitions("bucket", "sign").mapInArrow(_changed, "bucket long, state binary")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for state in batch.column(0).to_pylist():
            yield _found(CuckooIndex.from_bytes(state), 1)


def live(index: DataFrame, docs: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size) of all live digests; where a group's keeper was removed, the next is found among the documents that are left."""
    found = kept(index.select("state").mapInArrow(_listed, "digest binary, keep_id long, group_size long"))
    open_ = found.where("keep_id IS NULL").select("digest")
    again = digests(docs).join(open_, "digest").groupBy("digest").agg(F.max("doc_id").alias("again"))
    return found.join(again, "digest", "left").select("digest", F.coalesce("keep_id", "again").alias("keep_id"), "group_size")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of those with its text."""
    return deduplicated(table(spark, sf_dir, "documents"))


QUERIES = {"op13_exact_dedup": op13_exact_dedup}
ORACLE = {
    "op13_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
}
