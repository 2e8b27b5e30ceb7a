"""Exact Jaccard self-join on word shingles, by prefixes, block skips and set relations.

1. Every text becomes the set of its hashed shingles. Documents with equal sets
   fall into one class by a digest of the set; one of each class goes on.
2. Shingles have one global order: those that many documents share come last.
   Two sets that reach the threshold share a shingle among the first
   ``n - ceil(threshold * n) + 1`` of each, so only those are indexed.
3. An index list holds the sets with one such shingle by size band and position, so that
   its blocks are alike in both. Members and blocks are skipped whose positions leave too few
   shingles to reach the threshold, or whose sizes differ too much. The index is dealt
   by range of its whole order, so a long list is spread over tasks. Short lists
   with the same members are kept once.
4. Within a list, sets are compared by small count sketches, whose bound on the
   overlap never falls short of it. What passes is proposed as stars between classes,
   at most one pair fewer than there are members, and never all pairs of a group.
5. Proposed pairs are verified on whole sets. Their overlaps answer for similar sets: what u
   shares with w is at most what x shares with w, and the shingles of u that x has not. So the
   verified answers of one set rule out those of all sets near it. Lists
   with pairs left open propose again, until none is left.
6. A long list is compared in windows of two neighbouring blocks; after that only those pairs of its
   blocks meet that are not all of one component and that sizes and positions leave possible.

So no link is lost, no task holds more of a list than two blocks, and components of
all links are made once (twice if a long list has blocks in several components).
The result is one row a document with the smallest id that links reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, give_back, giving_back, kept, table

#: Words of a shingle, and similarity in hundredths from which sets link.
WORDS, PERCENT = 4, 85
#: Members of a block of an index list.
BLOCK = 1024
#: Counters of a set's sketch, by size: up to so many shingles, so many counters. Powers of two, so that they fold.
COUNTERS = ((1000, 128), (4000, 512), (1 << 62, 2048))
#: Shared shingles: summaries hold so many a task, and the order so many in all.
SUMMARY, SHARED = 1 << 16, 1 << 18
#: Ids up to this number are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Rows of pairs and lists up to this number are broadcast (about 100 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 200_000

#: Tasks that the stars of one set in different lists are dealt to.
CHUNKS = 16

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2**64
_LOW = np.uint64((1 << 63) - 1)
#: White space between words, by byte: 9 to 13 and 32.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of text that are hashed at once.
_GROUP_BYTES = 1 << 18
#: Words of more bytes are hashed one by one.
_LONG_WORD = 256


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


#: One random word for every byte.
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> None:
        if len(cls.up) < n:
            size = max(n, _GROUP_BYTES + (1 << 18))
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            cls.up = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, _BASE)]))
            cls.down = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, inverse)]))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 63-bit shingle hashes of every text; whole texts.

    Words are runs of characters other than space and the controls 9 to 13, with
    A-Z in lower case. A text with fewer words than a shingle has one shingle, one without
    words or null has none.
    """
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    group: list[int] = []
    raw: list[bytes] = []
    held = 0
    for k in range(len(texts) + 1):
        if k < len(texts):
            data = (texts[k] or "").encode("utf-8", "surrogatepass") + b" "
            group.append(k)
            raw.append(data)
            held += len(data)
        if group and (held >= _GROUP_BYTES or k == len(texts)):
            for g, s in zip(group, _hash_group(raw, words), strict=True):
                out[g] = s
            group, raw, held = [], [], 0
    return out


def _hash_group(raw: list[bytes], words: int) -> Iterator[np.ndarray]:
    data = _LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    _Powers.upto(len(data) + 1)
    space = _SPACE[data]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _Powers.up[: len(data)], dtype=np.uint64)])
    word = _mix((total[end] - total[start]) * _Powers.down[start] + (end - start).astype(np.uint64))
    for k in np.flatnonzero(end - start > _LONG_WORD):  # sums of powers may collide on built words of about 1,000 characters
        word[k] = xxhash.xxh3_64_intdigest(data[start[k] : end[k]].tobytes())
    bounds = np.searchsorted(start, np.cumsum([0] + [len(r) for r in raw]))
    turn = [_BYTE[k] for k in range(words)]
    if len(word) >= words:
        n = len(word) - words + 1
        shingle = _mix(sum(word[k : k + n] * turn[k] for k in range(words))) & _LOW
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= words:
            yield np.unique(shingle[a : b - words + 1])
        elif b > a:
            yield np.array([_mix(sum(word[a + k : a + k + 1] * turn[k] for k in range(b - a)) + np.uint64(b - a))[0] & _LOW])
        else:
            yield np.zeros(0, np.uint64)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """How many shingles of a set of n are indexed."""
    return n - -(-percent * n // 100) + 1 if n else 0


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Smallest overlap with which sets of sizes n and m link."""
    return -(-percent * (n + m) // (100 + percent))


def _ordered(shingles: np.ndarray, shared: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Shingles as keys in the global order: shared ones get the keys from 2**63, by rank."""
    if not len(shared):
        return shingles
    at = np.minimum(np.searchsorted(shared, shingles), len(shared) - 1)
    return np.sort(np.where(shared[at] == shingles, rank[at] | ~_LOW, shingles))


def _sketch(keys: np.ndarray) -> bytes:
    """How many shingles fall on each counter, one byte each; all bytes 255 if one would overflow."""
    size = next(c for most, c in COUNTERS if len(keys) <= most)
    counts = np.bincount((_mix(keys) >> np.uint64(65 - size.bit_length())).astype(np.int64), minlength=size)
    return b"\xff" * size if counts.max(initial=0) >= 255 else counts.astype(np.uint8).tobytes()


def _pressed(sketch: bytes) -> bytes:
    """A sketch for travelling: half its size, as counters are small numbers."""
    return zstandard.ZstdCompressor(level=1, write_checksum=False).compress(sketch)


def _opened(sketches: list[bytes]) -> list[bytes]:
    opener = zstandard.ZstdDecompressor()
    return [opener.decompress(s) for s in sketches]


def _folded(sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sketches with as many counters as the shortest has, and which of them bound nothing."""
    size = min(len(s) for s in sketches)
    rows = [np.frombuffer(s, np.uint8) for s in sketches]
    plain = np.array([bool((r == 255).all()) for r in rows])
    return np.stack([r.reshape(size, -1).sum(1, dtype=np.uint16) for r in rows]), plain


def _shared_summaries(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Frequent shingles of a task by a summary of bounded size (counts fall short by a known error at most)."""
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            column = batch.column(0)
            for lo in range(0, len(column), 1024):
                sets = shingle_sets(column.slice(lo, 1024).to_pylist(), words)
                new, n = np.unique(np.concatenate(sets or [keys[:0]]), return_counts=True)
                new, n = new[n > 1], n[n > 1]
                keys, inv = np.unique(np.concatenate([keys, new]), return_inverse=True)
                counts = np.bincount(inv, np.concatenate([counts, n]), len(keys)).astype(np.int64)
                if len(keys) > SUMMARY:
                    counts = counts - np.partition(counts, len(keys) - SUMMARY)[len(keys) - SUMMARY]
                    keys, counts = keys[counts > 0], counts[counts > 0]
        top = np.argsort(-counts, kind="stable")[: SUMMARY // 2]
        top = top[counts[top] >= 3]
        yield pa.RecordBatch.from_arrays([pa.array(keys[top].astype(np.int64)), pa.array(counts[top])], names=["shingle", "n"])

    return run


def shared_shingles(docs: DataFrame, text: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The most shared shingles of all documents (sorted), and their ranks by frequency; at most ``SHARED``.

    They only set the order in which shingles are indexed: which ones are
    found affects the cost of the join, never its result.
    """
    found = docs.select(text).mapInArrow(giving_back(_shared_summaries(words)), "shingle long, n long")
    found = found.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(SHARED).toArrow()
    shingle = found.column("shingle").to_numpy().astype(np.uint64)
    rank = np.empty(len(shingle), np.uint64)
    rank[np.lexsort((shingle, found.column("n").to_numpy()))] = np.arange(len(shingle), dtype=np.uint64)
    order = np.argsort(shingle)
    del found
    give_back()  # the driver's
    return shingle[order], rank[order]


def _signatures(words: int, percent: int, order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, rank = order.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                digest, size, prefix, sketch = [], [], [], []
                for s in shingle_sets(part.column(1).to_pylist(), words):
                    keys = _ordered(s, shared, rank)
                    digest.append(xxhash.xxh3_128_digest(keys.tobytes()))
                    size.append(len(s))
                    prefix.append(keys[: prefix_length(len(s), percent)].astype(np.int64))
                    sketch.append(_pressed(_sketch(keys)))
                offsets = np.cumsum([0] + [len(p) for p in prefix]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int32()), pa.array(digest, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefix))), pa.array(sketch, pa.binary())],
                    names=["id", "n", "digest", "prefix", "sketch"],
                )

    return run


def _entries(percent: int):
    width = np.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-9  # sets that link lie in one band or in neighbouring ones

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Index entries (key, band, pos, n, id), one for each shingle of a prefix."""
        for batch in batches:
            lists = batch.column(2)
            offsets, keys = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            length = np.diff(offsets)
            row = np.repeat(np.arange(batch.num_rows), length)
            pos = np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], length)
            n = batch.column(1).to_numpy()
            band = (np.log(np.maximum(n, 1)) / width).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[offsets[0] : offsets[-1]]), pa.array(band[row]), pa.array(pos.astype(np.int32)), pa.array(n[row]), pa.array(batch.column(0).to_numpy()[row])],
                names=["key", "band", "pos", "n", "id"],
            )

    return run


def _partnered(n: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """Which members of a list have a partner there that may link, by sizes and positions.

    The first shingle that a linking pair shares leaves both sets enough shingles from it on
    for the overlap that their sizes ask for, so the pair passes in the list of that shingle.
    """
    left, out = n - pos, np.zeros(len(n), bool)
    for lo in range(0, len(n), 256):
        at = np.arange(lo, min(len(n), lo + 256))
        may = np.minimum(left[at, None], left) >= least_overlap(n[at, None], n, percent)
        may[at - lo, at] = False
        out[at] = may.any(1)
    return out


_LIST = "list string, block long, kind string, lo int, hi int, left int, members array<long>"


def _lists(percent: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cuts entries (key, band, pos, n, id), sorted in this order, into the lists that can hold links.

        A list of at most two blocks that lies within the task is one row of kind ``single``.
        Of any other each two neighbouring blocks are a row of kind ``window``, and each block is one of kind
        ``block``, with its sizes and the most that a position leaves. Of a list that goes on
        over batches at most three blocks are held.
        """
        context = TaskContext.get()
        part = (context.partitionId() if context else 0) << 32
        held = [np.zeros(0, np.int64), *(np.zeros(0, np.int32) for _ in range(3)), np.zeros(0, np.int64)]
        done, first = 0, True  # blocks of the held list that are out; whether the task's first list is not complete yet
        rows: list[tuple] = []

        def single(a: int, b: int) -> None:
            size = held[3][a:b].astype(np.int64)
            members = held[4][a:b][_partnered(size, held[2][a:b], percent)]
            if len(members) > 1:
                rows.append(("", 0, "single", 0, 0, 0, np.sort(members)))

        def long_list(name: str, a: int, b: int, serial: int, last: bool) -> None:
            """Windows and blocks of entries a to b; if not last, of the first block only."""
            n, ids = held[3], held[4]
            for k, lo in enumerate(range(a, b, block)):
                hi = min(b, lo + block)
                if hi < b or lo == a and b - a > 1 and not serial:
                    rows.append((name, part + serial + k, "window", 0, 0, 0, ids[lo : min(b, lo + 2 * block)]))
                rows.append((name, part + serial + k, "block", int(n[lo:hi].min()), int(n[lo:hi].max()), int((n[lo:hi] - held[2][lo:hi]).max()), ids[lo:hi]))
                if not last:
                    return

        source = iter(batches)
        while True:
            batch = next(source, None)
            if batch is not None:
                held = [np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(held)]
            key, band = held[0], held[1]
            if len(key):
                start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                stop = np.append(start[1:], len(key))
                whole = len(start) - (batch is not None)  # the last list may go on
                edge = np.zeros(len(start), bool)  # may go on in another task
                edge[0], edge[-1] = first, edge[-1] or batch is None
                for r in np.flatnonzero((stop - start >= 2) | edge | ((np.arange(len(start)) == 0) & (done > 0)))[: len(start)]:
                    if r >= whole:
                        break
                    a, b = start[r], stop[r]
                    if edge[r] or (r == 0 and done):
                        long_list(f"{key[a]:x}", a, b, done if r == 0 else 0, True)
                        continue
                    cut = [a, *(a + 1 + np.flatnonzero(np.diff(band[a:b]) > 1)), b]
                    for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                        if hi - lo > 2 * block:
                            long_list(f"{key[a]:x}:{band[lo]}", lo, hi, 0, True)
                        elif hi - lo > 1:
                            single(lo, hi)
                if whole:
                    first, done = False, 0
                rest = start[whole] if whole < len(start) else len(key)
                while len(key) - rest >= 3 * block:
                    long_list(f"{key[rest]:x}", rest, len(key), done, False)
                    rest, done = rest + block, done + 1
                held = [h[rest:] for h in held]
            if rows:
                offsets = np.cumsum([0] + [len(r[6]) for r in rows]).astype(np.int32)
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), *(pa.array(cols[k], pa.int32()) for k in (3, 4, 5)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(cols[6])))],
                    names=["list", "block", "kind", "lo", "hi", "left", "members"],
                )
                rows = []
            if batch is None:
                return

    return run


def index_lists(reps: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Index lists (list, block, kind, lo, hi, left, members) of class representatives (id, n, prefix).

    Entries are dealt by range of their whole order and streamed, so that no list is held whole or
    needs one task. Single lists with the same members are kept once.
    """
    order = ["key", "band", "pos", "n", "id"]
    entries = reps.select("id", "n", "prefix").mapInArrow(giving_back(_entries(percent)), "key long, band int, pos int, n int, id long")
    lists = entries.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(giving_back(_lists(percent, block)), _LIST)
    # equal single lists have one name, by their members
    name = F.when(F.col("kind") == "single", F.concat(F.lit("="), F.sha1(F.array_join(F.col("members").cast("array<string>"), ",")))).otherwise(F.col("list"))
    return lists.withColumn("list", name).dropDuplicates(["list", "block", "kind"])


def _propose(percent: int, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs to verify of rows (list, i, j, members, cut, known), one row at a time."""
        for batch in batches:
            at: list[int] = []
            pairs: list[tuple[int, int, int]] = []
            members, known = batch.column(3), batch.column(5)
            for r in range(batch.num_rows):
                ids, of, n, sketch = members.values.slice(members.offsets[r].as_py(), len(members[r])).flatten()
                before = [x.to_numpy() for x in known.values.slice(known.offsets[r].as_py(), len(known[r])).flatten()] if known[r].is_valid else None
                found = _open_pairs(ids.to_numpy(), of.to_numpy(), n.to_numpy().astype(np.int64), _opened(sketch.to_pylist()), batch.column(4)[r].as_py(), before, percent, turn)
                at += [r] * len(found)
                pairs += found
            rows = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(rows) for k in range(3)), *(pa.array([p[k] for p in pairs], pa.int64()) for k in range(3))],
                names=["list", "i", "j", "a", "b", "centre"],
            )

    return run


def _roots(of: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Classes 0.. of members with classes ``of`` after links between the places a and b."""
    root = np.unique(of, return_inverse=True)[1]
    parent = list(range(root.max() + 1))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(root[a].tolist(), root[b].tolist(), strict=True):
        parent[find(x)] = find(y)
    return np.unique(np.array([find(x) for x in range(len(parent))])[root], return_inverse=True)[1]


def _open_pairs(ids: np.ndarray, of: np.ndarray, n: np.ndarray, sketches: list[bytes], cut: int, before: list[np.ndarray] | None, percent: int, turn: int) -> list[tuple[int, int, int]]:
    """Pairs between classes that may link: a forest of stars over the classes.

    Bounds on overlaps are those of the sketches and, once pairs were verified, those that follow
    from the answers of similar sets. From the second turn on each set outside the largest class also proposes its
    best pairs, sixteen times as many each turn, so that few turns are needed. With ``cut`` only members
    on either side of that place are compared. A pair (a, b, centre) comes with the end whose star it is of.
    """
    m = len(ids)
    of = np.unique(of, return_inverse=True)[1]
    if of.max(initial=0) == 0:
        return []
    sketch, plain = _folded(sketches)
    side = np.arange(m) >= cut
    left = ids.argsort(kind="stable")

    def bound(rows: np.ndarray) -> np.ndarray:
        """By how much the overlaps of some members with all may exceed what a link needs."""
        out = np.empty((len(rows), m), np.int32)
        for k, u in enumerate(rows):
            most = np.minimum(n[u], n)
            if not plain[u]:
                seen = np.minimum(sketch[u], sketch).sum(1, dtype=np.int64)
                most = np.where(plain, most, np.minimum(most, seen))
            out[k] = most
        return out

    whole = None
    if before is not None:
        a, b = (left[np.searchsorted(ids[left], x)] for x in before[:2])
        overlap = before[2].astype(np.int64)
        linked = 100 * overlap >= percent * (n[a] + n[b] - overlap)
        of = _roots(of, a[linked], b[linked])
        if of.max() == 0:
            return []
        whole = bound(np.arange(m))
        whole[a, b] = whole[b, a] = overlap
        # what u shares with w is at most what x shares with w, and what u has beside x
        for _ in range(2):
            for x in np.unique(np.concatenate([a, b])):
                near = np.concatenate([b[a == x], a[b == x]])
                beside = n[near].astype(np.int32) - whole[near, x]
                whole[near] = np.minimum(whole[near], whole[x] + beside[:, None])
                whole[:, near] = whole[near].T
        for u in range(m):
            whole[u] -= least_overlap(n[u], n, percent).astype(np.int32)
        whole[a, b] = whole[b, a] = -1
        whole[of[:, None] == of] = -1
        if cut:
            whole[side[:, None] == side] = -1
        if whole.max() < 0:
            return []

    def spare(u: int, among: np.ndarray) -> np.ndarray:
        if whole is not None:
            return whole[u, among]
        most = np.minimum(n[u], n[among])
        if not plain[u]:
            seen = np.minimum(sketch[u], sketch[among]).sum(1, dtype=np.int64)
            most = np.where(plain[among], most, np.minimum(most, seen))
        got = most - least_overlap(n[u], n[among], percent)
        got[of[among] == of[u]] = -1
        if cut:
            got[side[among] == side[u]] = -1
        return got

    pairs: dict[tuple[int, int], int] = {}

    def add(u: int, v: int) -> None:
        if u != v:
            pairs.setdefault((min(ids[u], ids[v]), max(ids[u], ids[v])), int(ids[u]))

    reached = np.zeros(of.max() + 1, bool)
    by_class = np.argsort(of, kind="stable")
    first = np.searchsorted(of[by_class], np.arange(of.max() + 2))
    for c in range(len(reached)):
        if reached[c]:
            continue
        reached[c] = True
        todo = list(by_class[first[c] : first[c + 1]])
        while todo:
            u = todo.pop()
            among = np.flatnonzero(~reached[of])
            if not len(among):
                break
            got = spare(u, among)
            best = np.lexsort((among, -got))  # of each class the pair with most to spare
            best = best[got[best] >= 0]
            for v in among[best[np.unique(of[among[best]], return_index=True)[1]]]:
                reached[of[v]] = True
                add(u, v)
                todo += list(by_class[first[of[v]] : first[of[v] + 1]])
    if turn > 1:
        largest = np.bincount(of).argmax()
        for u in np.flatnonzero(of != largest):
            best = np.argsort(-whole[u], kind="stable")[: 16 ** (turn - 1)]
            for v in best[whole[u, best] >= 0]:
                add(u, v)
    asked = set() if before is None else set(zip(before[0].tolist(), before[1].tolist(), strict=True))
    return sorted((int(a), int(b), c) for (a, b), c in pairs.items() if (a, b) not in asked)


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, shingles) of rows (id, text)."""
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                sets = [s.astype(np.int64) for s in shingle_sets(part.column(1).to_pylist(), words)]
                offsets = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))], names=["id", "shingles"]
                )

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(a, b, overlap, linked) of rows (centre, chunk, role, id, shingles) that come sorted: the set of a star's centre, then those of its ends."""
        centre, whole = None, None
        for batch in batches:
            of, role, ids, sets = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)
            out = []
            for k in range(batch.num_rows):
                x = sets[k].values.to_numpy()
                if role[k] == 0:
                    centre, whole = of[k], x.copy()
                elif of[k] == centre:
                    both = int(np.intersect1d(x, whole, assume_unique=True).size)
                    out.append((min(centre, ids[k]), max(centre, ids[k]), both, 100 * both >= percent * (len(x) + len(whole) - both)))
            cols = list(zip(*out, strict=True)) if out else [()] * 4
            types = pa.int64(), pa.int64(), pa.int32(), pa.bool_()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["a", "b", "overlap", "linked"])

    return run


def stars_of(proposed: DataFrame) -> DataFrame:
    """(id, centre, chunk, role): where the set of each id of proposed pairs (list, i, j, a, b, centre) is to be compared.

    The set of a star's centre (role 0) goes along once for its other ends (role 1), so that a star costs half of what its pairs would. The stars
    that a set has in different lists are dealt to ``CHUNKS`` tasks. A pair that several lists propose is of one star.
    """
    chunk = F.pmod(F.xxhash64("list", "i", "j"), F.lit(CHUNKS)).cast("int")
    one = proposed.groupBy("a", "b").agg(F.min(F.struct(F.col("centre"), chunk.alias("chunk"))).alias("s"))
    ends = F.array(F.struct(F.col("s.centre").alias("id"), F.lit(0).alias("role")), F.struct(F.when(F.col("s.centre") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("id"), F.lit(1).alias("role")))
    return one.select("s.centre", "s.chunk", F.explode(ends).alias("e")).select("e.id", "centre", "chunk", "e.role").distinct()


def verified(proposed: DataFrame, docs: DataFrame, words: int, percent: int, few: bool | None = None) -> DataFrame:
    """(a, b, overlap, linked) of proposed pairs, each once, by the whole sets (of 63-bit hashes of shingles) of docs (id, text).

    Only the sets of ids in pairs are made. Sets meet by the stars that their pairs form. ``few`` says that the pairs have at most
    ``BROADCAST_ROWS`` ends; without it the rows of stars are counted.
    """
    stars = kept(stars_of(proposed), small=True)
    if few is None:
        few = stars.count() <= BROADCAST_ROWS
    # few rows are broadcast as they are: making their ids distinct takes a shuffle
    wanted = F.broadcast(stars.select("id")) if few else stars.select("id").distinct()
    sets = docs.select("id", "text").join(wanted, "id", "left_semi") if few else matched(docs.select("id", "text"), kept(wanted, small=True), "left_semi")
    sets = sets.mapInArrow(giving_back(_sets(words)), "id long, shingles array<long>")
    order = ["centre", "chunk", "role", "id"]
    met = sets.join(F.broadcast(stars) if few else stars, "id").select(*order, "shingles").repartition("centre", "chunk").sortWithinPartitions(*order)
    return kept(met.mapInArrow(giving_back(_verify(percent)), "a long, b long, overlap int, linked boolean"), small=True)


def copies_of(signed: DataFrame) -> DataFrame:
    """(id, rep) of sets that equal one with a smaller id; rep is the smallest. Only ids and digests are shuffled."""
    groups = signed.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).where("copies > 1")
    return kept(signed.select("id", "digest").join(groups.select("digest", "rep"), "digest").where("id <> rep").select("id", "rep"), small=True)


def matched(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of rows with kept, distinct ids: these are broadcast up to ``BROADCAST_IDS``, and shuffled beyond."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", how)


def bounded(rows: DataFrame) -> DataFrame:
    """Kept rows of a few numbers, to be broadcast up to ``BROADCAST_ROWS``, and joined by a shuffle beyond."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


_KNOWN = "array<struct<a:long,b:long,overlap:int>>"


def links_of(filled: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame | None:
    """Links (a, b) that join what links within rows (list, i, j, members, cut); None without any."""
    links, known, turn = None, None, 1
    rows = filled.withColumn("known", F.lit(None).cast(_KNOWN))
    while True:
        columns = rows.select("list", "i", "j", "members", "cut", "known")
        proposed = kept(columns.mapInArrow(giving_back(_propose(percent, turn)), "list string, i long, j long, a long, b long, centre long"), small=True)
        n = proposed.count()  # a pair has two ends, is checked once and found again in each of its lists: one count bounds all of these
        if not n:
            return links
        few = 2 * n <= BROADCAST_ROWS
        checked = verified(proposed, docs, words, percent, few or None)
        new = checked.where("linked").select("a", "b")
        links = new if links is None else links.union(new)
        found = kept(proposed.join(F.broadcast(checked) if few else bounded(checked), ["a", "b"]).select("list", "i", "j", "a", "b", "overlap", (~F.col("linked")).alias("open"), F.lit(turn).alias("turn")), small=True)
        known = found if known is None else known.union(found)
        answers = F.collect_list(F.struct("a", "b", "overlap")).alias("known")
        unsure = known.groupBy("list", "i", "j").agg(answers, F.max(F.col("open") & (F.col("turn") == turn)).alias("open")).where("open").drop("open")
        unsure, turn = kept(unsure, small=True), turn + 1
        if unsure.isEmpty():
            return links
        rows = filled.join(F.broadcast(unsure) if n <= BROADCAST_ROWS else unsure, ["list", "i", "j"])


def _filled(lists: DataFrame, sketches: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Rows (list, block, members) of id lists, each member with class, size and sketch; a row holds at most two blocks."""
    one = lists.select("list", "block", F.explode("members").alias("id"))
    if classes is None:
        one = one.withColumn("class", F.col("id"))
    else:
        one = one.join(bounded(classes.withColumnRenamed("component", "class")), "id", "left").withColumn("class", F.coalesce("class", "id"))
    member = F.struct("id", "class", "n", "sketch")
    return one.join(sketches, "id").groupBy("list", "block").agg(F.collect_list(member).alias("members"))


def far_blocks(blocks: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (list, i, j) of blocks of long lists that were not neighbours, are not all of one class, and may hold links.

    Lists of one class take no part, so the pairs are those of lists with several classes. Blocks meet by list and band of sizes: sets
    that link lie in one band or in neighbouring ones. Few rows meet by broadcast, without tasks of a shuffle.
    """
    of = blocks.select("list", "block", "lo", "hi", "left", F.explode("members").alias("id")).join(bounded(classes), "id", "left")
    of = of.withColumn("class", F.coalesce("component", "id")).groupBy("list", "block", "lo", "hi", "left")
    about = kept(of.agg(F.min("class").alias("low"), F.max("class").alias("high")), small=True)
    mixed = kept(about.groupBy("list").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least < most").select("list"), small=True)
    few = about.count() <= BROADCAST_ROWS
    about = about.join(F.broadcast(mixed) if few else mixed, "list")
    i, j = (about.select("list", *(F.col(c).alias(f"{c}_{k}") for c in about.columns if c != "list")) for k in "ij")
    least = F.ceil(percent * (F.col("lo_i") + F.col("lo_j")) / F.lit(100.0 + percent) - 1e-6)
    may = (F.least("left_i", "left_j") >= least) & (100 * F.col("hi_i") >= percent * F.col("lo_j")) & (100 * F.col("hi_j") >= percent * F.col("lo_i"))
    apart = (F.col("block_i") + 1 < F.col("block_j")) & (F.least("low_i", "low_j") < F.greatest("high_i", "high_j"))
    width = float(np.log(100 / min(percent, 99)) * (1 + 1e-9))  # a band may be too wide, never too narrow
    band = lambda x: F.floor(F.log(F.greatest(x, F.lit(1)).cast("double")) / width)
    i = i.withColumn("band", F.explode(F.sequence(band(F.col("lo_i")), band(F.col("hi_i")))))
    j = j.withColumn("band", F.explode(F.sequence(band(F.col("lo_j")) - 1, band(F.col("hi_j")) + 1)))
    return j.join(F.broadcast(i) if few else i, ["list", "band"]).where(apart & may).select("list", F.col("block_i").alias("i"), F.col("block_j").alias("j")).distinct()


def jaccard_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row a document: (key, n_shingles, component_id).

    Two documents link when 100 * intersection >= percent * union of their shingle
    sets; component_id is the smallest key that links reach. Keys are distinct
    integers (a row that is repeated whole is returned as often; one with a null key has no component, and a key that is
    no number is an error). Documents without words, and null texts, have
    empty sets and are alone. An empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    order = spark.sparkContext.broadcast(shared_shingles(docs, "text", words))
    schema = "id long, n int, digest binary, prefix array<long>, sketch binary"
    signed = kept(docs.mapInArrow(giving_back(_signatures(words, percent, order)), schema))
    sets = signed.where("n > 0 AND id IS NOT NULL")
    copies = copies_of(sets)
    reps = matched(sets, copies.select("id"), "left_anti")
    lists = kept(index_lists(reps, percent, block))
    members = kept(lists.where("kind <> 'block'").select(F.explode("members").alias("id")).distinct(), small=True)
    sketches = kept(matched(reps.select("id", "n", "sketch"), members, "left_semi"))
    near = _filled(lists.where("kind <> 'block'"), sketches).withColumns({"i": F.col("block"), "j": F.col("block"), "cut": F.lit(0)})
    links = links_of(kept(near), docs, words, percent)
    blocks = lists.where("kind = 'block'")
    several = kept(blocks.groupBy("list").agg(F.count("*").alias("blocks")).where("blocks > 1").select("list"), small=True)
    blocks = kept(blocks.join(bounded(several), "list"), small=True)
    classes = None if links is None else components(links)
    if not blocks.isEmpty():
        none = copies.select("id", F.col("rep").alias("component")).where("false")
        apart = kept(far_blocks(blocks, none if classes is None else classes, percent), small=True)
        if not apart.isEmpty():
            wanted = kept(apart.select("list", F.col("i").alias("block")).union(apart.select("list", "j")).distinct(), small=True)
            ids = blocks.join(bounded(wanted), ["list", "block"], "left_semi")
            some = kept(ids.select(F.explode("members").alias("id")).distinct(), small=True)
            filled = kept(_filled(ids, matched(reps.select("id", "n", "sketch"), some, "left_semi"), classes))
            i, j = (filled.select("list", F.col("block").alias(k), F.col("members").alias(f"of_{k}")) for k in "ij")
            far = i.join(bounded(apart), ["list", "i"]).join(j, ["list", "j"])
            far = far.select("list", "i", "j", F.concat("of_i", "of_j").alias("members"), F.size("of_i").alias("cut"))
            more = links_of(kept(far), docs, words, percent)
            if more is not None:
                links = more if links is None else links.union(more)
                classes = components(links)
    whole = signed.select("id", "n").join(bounded(copies), "id", "left").withColumn("rep", F.coalesce("rep", "id"))
    if classes is not None:
        whole = whole.join(bounded(classes.withColumnRenamed("id", "rep")), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    else:
        whole = whole.withColumn("component", F.col("rep"))
    return whole.select(F.col("id").alias(key), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set and the id of its component."""
    return jaccard_classes(table(spark, sf_dir, "documents"))


QUERIES = {"op5_ngram_jaccard_join": op5_ngram_jaccard_join}
ORACLE: dict[str, str] = {}
