"""Phrase collocations from weighted acyclic automata.

The n-grams of a shard of texts are counted and sorted, and an automaton over words is built from them state by
state: a state that is finished is looked up among the finished ones, so that equal ends are stored once. A path's weight,
on its last arc, is the n-gram's count. Shards' automata are cut at prefix bounds, and the cuts of one prefix
range meet in one task, which unites them and sums weights. Bounds are whole n-grams, not first words, so a frequent word is split.

Orders are counted one after the other. A phrase cannot be frequent unless its parts are, so words (then pairs) that
are not frequent anywhere are left out by a filter of bits; it lets some through that are not needed and never holds back one that is.

Parts are looked up by composition: the parts of a range's candidates, as a sorted acceptor, travel to the ranges that hold them,
each part once a range however many candidates have it, and their weights travel back. With pairs goes the highest count of a longer candidate
around them, which tells the pair's own range whether the pair is to be dropped.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import kept, table

#: Words of a phrase at most, least count of a candidate, candidates returned of each language, and the share (in hundredths) of
#: a phrase's count from which a longer candidate stands for it.
MAX_WORDS, LEAST, MOST, SHARE = 3, 10, 2000, 50
#: Bytes of text of a shard, entries that wait in a task to be united, prefix ranges a shuffle partition, and n-grams drawn a range to set their bounds.
SHARD_BYTES, UNITE_ENTRIES, RANGES, DRAWN = 12 << 20, 1 << 21, 2, 64
#: Bits of the filter: so many a phrase, and in all at most (2 to this power, 32 MB); they decide cost only.
FILTER_BITS, FILTER_MOST = 16, 28
_CHUNK = 1 << 15

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0 in words, 1 between words, 2 between pieces.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2

Paths = tuple[pa.Array, list[np.ndarray], np.ndarray]


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Sorted distinct words (binary) of texts, and the number of its word and of its piece for every occurrence."""
    whole = texts.cast(pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    n = int(offsets[-1] - offsets[0]) if len(whole) else 0
    if not n:
        return pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(0, np.int32)
    data = _LOWER[np.frombuffer(whole.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    kind = _CLASS[data]
    word, edge = kind == 0, np.zeros(n + 1, bool)
    edge[offsets - offsets[0]] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:n]
    start = np.flatnonzero(begin)
    piece = np.cumsum((kind == 2) | edge[:n], dtype=np.int32)[start]
    ends = np.append(np.cumsum(word, dtype=np.int32)[start] - 1, word.sum()).astype(np.int32)
    every = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[word])]).dictionary_encode()
    order = pc.sort_indices(every.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return every.dictionary.take(pa.array(order)), rank[every.indices.to_numpy()], piece


def summed(columns: list[np.ndarray], weights: np.ndarray | None = None, fold: np.ufunc = np.add) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct sorted paths with their weights folded; each counts one without weights."""
    if not len(columns[0]):
        return [c.astype(np.int64) for c in columns], np.zeros(0, np.int64)
    key, sizes, pairs = columns[0].astype(np.int64), [int(c.max()) + 1 for c in columns], None
    if len(columns) == 3 and sizes[0] * sizes[1] * sizes[2] >= 1 << 62:
        pairs, key = np.unique(key * sizes[1] + columns[1], return_inverse=True)
        key = key.reshape(-1) * sizes[2] + columns[2]
    else:
        for c, size in zip(columns[1:], sizes[1:], strict=True):
            key = key * size + c
    if weights is None:
        key = np.sort(key)
    else:
        order = np.argsort(key, kind="stable")
        key, weights = key[order], weights[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    total = np.diff(np.append(first, len(key))) if weights is None else fold.reduceat(weights, first)
    key, out = key[first], []
    for size in reversed(sizes[1:] if pairs is None else sizes[2:]):
        out.append(key % size)
        key = key // size
    if pairs is not None:
        key = pairs[key]
        out += [key % sizes[1]]
        key = key // sizes[1]
    return [key, *reversed(out)], total.astype(np.int64)


def _least_kind(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))


def built(columns: list[np.ndarray], weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The minimal automaton of sorted distinct paths: for each depth the arcs a state, labels, and weights (last depth) or states."""
    depths, value, new = [], weights, np.arange(len(weights))
    for depth in range(len(columns) - 1, -1, -1):
        label = columns[depth][new]
        if depth:
            changed = np.zeros(len(new), bool)
            changed[:1] = True
            for c in columns[:depth]:
                at = c[new]
                changed[1:] |= at[1:] != at[:-1]
            first = np.flatnonzero(changed)
        else:
            first = np.zeros(min(1, len(new)), np.int64)
        last = np.append(first, len(new))[1:]
        data, register, state = np.stack([label, value], 1).astype(np.int64).tobytes(), {}, np.empty(len(first), np.int64)
        arcs = []
        for k, (a, b) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
            end = data[16 * a : 16 * b]
            state[k] = at = register.setdefault(end, len(register))
            if at == len(arcs):
                arcs.append((a, b))
        take = np.concatenate([np.arange(a, b) for a, b in arcs]) if arcs else np.zeros(0, np.int64)
        depths.append((np.array([b - a for a, b in arcs], np.int64), label[take], value[take]))
        value, new = state, new[first]
    return depths[::-1]


def paths(depths: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """All paths of an automaton in order, and their weights."""
    (_, label, value), columns = depths[0], []
    columns.append(label)
    for size, label, target in depths[1:]:
        first = np.append(0, np.cumsum(size))
        times = size[value]
        arc = np.repeat(first[value] - np.append(0, np.cumsum(times))[:-1], times) + np.arange(times.sum())
        columns = [np.repeat(c, times) for c in columns] + [label[arc]]
        value = target[arc]
    return columns, value


def packed(words: pa.Array, columns: list[np.ndarray], weights: np.ndarray) -> bytes:
    """An automaton with the words it uses, as bytes."""
    used = np.unique(np.concatenate(columns))
    renamed = [np.searchsorted(used, c) for c in columns]
    arrays = [_least_kind(x) for depth in built(renamed, weights) for x in depth]
    text = b"\n".join(words.take(pa.array(used)).to_pylist())
    head = struct.pack(f"<II{2 * len(arrays)}I", len(text), len(arrays), *(n for x in arrays for n in (x.itemsize, len(x))))
    return head + text + b"".join(x.tobytes() for x in arrays)


def unpacked(data: bytes) -> Paths:
    """Words, paths and weights of a packed automaton."""
    size, n = struct.unpack_from("<II", data)
    about = struct.unpack_from(f"<{2 * n}I", data, 8)
    at = 8 + 8 * n
    text, at, arrays = data[at : at + size], at + size, []
    for item, length in zip(about[::2], about[1::2], strict=True):
        arrays.append(np.frombuffer(data, f"u{item}", length, at).astype(np.int64))
        at += item * length
    columns, weights = paths([tuple(arrays[k : k + 3]) for k in range(0, n, 3)])
    return pa.array(text.split(b"\n") if len(weights) else [], pa.binary()), columns, weights


def united(parts: list[Paths], fold: np.ufunc = np.add) -> Paths:
    """The union of automata, weights of equal paths folded."""
    every = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    order = pc.sort_indices(every.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    name, at, columns = rank[every.indices.to_numpy()], 0, []
    for words, cols, _ in parts:
        columns.append([name[at : at + len(words)][c] for c in cols])
        at += len(words)
    merged, weights = summed([np.concatenate(c) for c in zip(*columns, strict=True)], np.concatenate([p[2] for p in parts]), fold)
    return every.dictionary.take(pa.array(order)), merged, weights


def cuts(words: pa.Array, columns: list[np.ndarray], bounds: list[tuple[bytes, ...]]) -> list[int]:
    """The number of paths before each bound (a tuple of words); a path that begins a bound is before it."""
    known, out = words.to_pylist(), []
    for bound in bounds:
        lo, hi = 0, len(columns[0])
        for depth, word in enumerate(bound):
            if depth == len(columns):
                lo = hi
                break
            at = bisect.bisect_left(known, word)
            here = columns[depth][lo:hi]
            if at == len(known) or known[at] != word:
                lo = lo + int(np.searchsorted(here, at, "left"))
                break
            lo, hi = lo + int(np.searchsorted(here, at, "left")), lo + int(np.searchsorted(here, at, "right"))
        out.append(lo)
    return out


def by_range(lang: str, p: Paths, bounds: dict[str, list[tuple[bytes, ...]]]) -> Iterator[tuple[int, bytes]]:
    """The non-empty cuts of an automaton at its language's prefix bounds, with the number of the range."""
    words, columns, weights = p
    at = [0, *cuts(words, columns, bounds.get(lang, [])), len(weights)]
    for part, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True)):
        if lo < hi:
            yield part, packed(words, [c[lo:hi] for c in columns], weights[lo:hi])


class Filter:
    """Bits of the frequent phrases of one order: ``has`` is never false for one of them."""

    def __init__(self, bits: np.ndarray, power: int) -> None:
        self.bits, self.power = bits, power

    @staticmethod
    def names(lang: str, words: pa.Array) -> np.ndarray:
        import xxhash

        seed = zlib.crc32(lang.encode())
        return np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words.to_pylist()], np.uint64)

    @staticmethod
    def of(names: list[np.ndarray]) -> np.ndarray:
        """Hashes of phrases from the hashes of their words."""
        h = names[0]
        for x in names[1:]:
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + x
        return h * np.uint64(0xD6E8FEB86659FD93)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.power)
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def shard_paths(lang: str, texts: pa.Array, order: int, known: Filter | None) -> Paths:
    """Counts of a shard's n-grams of one order whose parts may be frequent."""
    words, at, piece = tokens(texts)
    if order == 1:
        return words, *summed([at])
    names = Filter.names(lang, words)
    n = len(at) - order + 1
    if n <= 0:
        return words, *summed([at[:0]] * order)
    if order == 2:
        may = known.has(Filter.of([names]))[at]
        good = may[:-1] & may[1:] & (piece[:-1] == piece[1:])
    else:
        pair = (piece[:-1] == piece[1:]) & known.has(Filter.of([names[at[:-1]], names[at[1:]]]))
        good = pair[:-1] & pair[1:]
    use = np.flatnonzero(good)
    return words, *summed([at[use + k] for k in range(order)])


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    lang = batch.column(0).dictionary_encode()
    for k, name in enumerate(lang.dictionary.to_pylist()):
        yield name, batch.column(1).filter(pc.equal(lang.indices, k))


_CUT = "lang string, part int, blob binary"


def _sharded(order: int, bounds: Broadcast, known: Broadcast | None):
    """Cuts (lang, part, blob) of the automata of a task's shards of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        size = 0

        def emit() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                shard = shard_paths(lang, pa.concat_arrays(texts), order, known.value if known else None)
                for part, blob in by_range(lang, shard, bounds.value):
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([part], pa.int32()), pa.array([blob], pa.binary())], names=["lang", "part", "blob"])

        for batch in batches:
            # a batch may hold many long texts: it is taken in slices
            for lo in range(0, batch.num_rows, 256):
                for lang, texts in _by_language(batch.slice(lo, 256)):
                    held.setdefault(lang, []).append(texts.cast(pa.large_string()))
                    size += texts.nbytes
                if size >= SHARD_BYTES:
                    yield from emit()
                    held, size = {}, 0
        yield from emit()

    return run


def in_groups(keys: int, start: Callable[[], object]):
    """Feeds rows sorted by their first ``keys`` columns to an object of their group: ``add`` of each row, then ``done``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, of = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = [c[k].as_py() for c in batch.columns]
                if row[:keys] != of:
                    if group is not None:
                        yield from group.done(*of)
                    group, of = start(), row[:keys]
                yield from group.add(*row)
        if group is not None:
            yield from group.done(*of)

    return run


class _United:
    """The automata of one prefix range, united; what is frequent stays."""

    def __init__(self, least: int) -> None:
        self.least, self.parts, self.entries = least, [], 0

    def add(self, lang: str, part: int, blob: bytes) -> Iterator[pa.RecordBatch]:
        p = unpacked(blob)
        self.parts.append(p)
        self.entries += len(p[2])
        if self.entries > max(UNITE_ENTRIES, 2 * len(self.parts[0][2])):
            self.parts = [united(self.parts)]
            self.entries = len(self.parts[0][2])
        return iter(())

    def done(self, lang: str, part: int) -> Iterator[pa.RecordBatch]:
        words, columns, weights = united(self.parts)
        often = weights >= self.least
        blob = packed(words, [c[often] for c in columns], weights[often])
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([part], pa.int32()), pa.array([int(often.sum())]), pa.array([int(weights.sum())]), pa.array([blob], pa.binary())], names=["lang", "part", "entries", "total", "blob"])


def _drawn(each: int):
    """(lang, key): so many n-grams of each text, evenly spaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words, at, _ = tokens(batch.column(1).slice(k, 1))
                begin = np.unique(np.linspace(0, max(0, len(at) - 1), min(each, len(at))).astype(int))
                keys = [[words[int(w)].as_py().decode("utf-8", "replace") for w in at[b : b + MAX_WORDS]] for b in begin]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[k].as_py()] * len(keys), pa.string()), pa.array(keys, pa.list_(pa.string()))], names=["lang", "key"])

    return run


def prefix_bounds(texts: DataFrame, ranges: int) -> dict[str, list[tuple[bytes, ...]]]:
    """Bounds of about so many prefix ranges, by language, from a bounded draw of n-grams; they decide where work goes, not results."""
    share = min(1.0, 2 * ranges / max(1, texts.count()))
    drawn = texts.where(F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = drawn.mapInArrow(_drawn(DRAWN), "lang string, key array<string>").limit(8 * DRAWN * ranges).toArrow()
    keys = sorted(zip(rows.column("lang").to_pylist(), (tuple(w.encode() for w in key) for key in rows.column("key").to_pylist()), strict=True))
    out: dict[str, list[tuple[bytes, ...]]] = {}
    for lang, key in sorted({keys[k * len(keys) // ranges] for k in range(1, ranges)} if keys else ()):
        out.setdefault(lang, []).append(key)
    return out


def phrase_filter(found: DataFrame, entries: int) -> Filter:
    """The filter of the phrases of united automata (lang, part, entries, total, blob); its bits are joined by Spark in chunks."""
    power = min(FILTER_MOST, max(15, int(FILTER_BITS * entries).bit_length()))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, blob in zip(batch.column("lang").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                words, columns, _ = unpacked(blob)
                names = Filter.names(lang, words)
                at = (Filter.of([names[c] for c in columns]) >> np.uint64(64 - power)).astype(np.int64)
                for c in np.unique(at // _CHUNK):
                    mine = at[at // _CHUNK == c] % _CHUNK
                    here = chunks.setdefault(int(c), np.zeros(_CHUNK // 8, np.uint8))
                    np.bitwise_or.at(here, mine >> 3, (1 << (mine & 7)).astype(np.uint8))
        if chunks:
            yield pa.RecordBatch.from_arrays([pa.array(list(chunks), pa.int32()), pa.array([b.tobytes() for b in chunks.values()], pa.binary())], names=["chunk", "bits"])

    got = found.select("lang", "blob").mapInArrow(bits, "chunk int, bits binary").groupBy("chunk").agg(F.bitmap_or_agg("bits").alias("bits"))
    every = np.zeros(max(1 << power, _CHUNK) // 8, np.uint8)
    for r in got.toLocalIterator():
        every[r["chunk"] * _CHUNK // 8 : (r["chunk"] + 1) * _CHUNK // 8] = np.frombuffer(r["bits"], np.uint8)
    return Filter(every, power)


def parts_of(columns: list[np.ndarray], weights: np.ndarray) -> dict[int, tuple[list[np.ndarray], np.ndarray]]:
    """The distinct parts of phrases by their number of words, sorted, with the highest count of a phrase around each."""
    n, out = len(columns), {}
    ends = [columns[0], columns[-1]]
    out[1] = summed([np.concatenate(ends)], np.concatenate([weights, weights]), np.maximum)
    if n == 3:
        out[2] = summed([np.concatenate([columns[0], columns[1]]), np.concatenate([columns[1], columns[2]])], np.concatenate([weights, weights]), np.maximum)
    return out


def places_of(sought: list[np.ndarray], held: list[np.ndarray]) -> np.ndarray:
    """Where paths stand among sorted held ones (of one or two words), -1 where they do not."""
    if not len(held[0]):
        return np.full(len(sought[0]), -1)
    size = max(int(c.max(initial=0)) for c in (*sought, *held)) + 1
    key = lambda cols: cols[0] if len(cols) == 1 else cols[0] * size + cols[1]
    a, b = key(sought), key(held)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return np.where((b[at] == a) & (np.minimum.reduce(sought) >= 0), at, -1)


_ASK = "lang string, part int, words int, role int, to_part int, to_words int, blob binary"


def _row(*values: object) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["lang", "part", "words", "role", "to_part", "to_words", "blob"])


def _asked(bounds: Broadcast):
    """What the candidates of a range (lang, part, words, blob) ask of the ranges that hold their parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, part, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, columns, weights = unpacked(blob)
                if len(weights):
                    for size, (cols, longest) in parts_of(columns, weights).items():
                        for at, cut in by_range(lang, (words, cols, longest), bounds.value):
                            yield _row(lang, at, size, 1, part, n, cut)

    return run


class _Composed:
    """A range's automaton (role 0) composed with what is asked of it (role 1): weights go back, and verdicts on its own pairs."""

    def __init__(self, share: int) -> None:
        self.share, self.held, self.longest = share, None, None

    def add(self, lang: str, part: int, words: int, role: int, to_part: int, to_words: int, blob: bytes) -> Iterator[pa.RecordBatch]:
        if role == 0:
            self.held = unpacked(blob)
            self.longest = np.zeros(len(self.held[2]), np.int64)
            return
        names, columns, longest = unpacked(blob)
        rename = pc.index_in(names, value_set=self.held[0]).fill_null(-1).to_numpy().astype(np.int64)
        at = places_of([rename[c] for c in columns], self.held[1])
        if (at < 0).any():
            raise ValueError(f"a part of a candidate of {lang} is not among the counts")
        if to_words > words >= 2:
            self.longest[at] = np.maximum(self.longest[at], longest)
        yield _row(lang, to_part, to_words, 1, part, words, self.held[2][at].tobytes())

    def done(self, lang: str, part: int, words: int) -> Iterator[pa.RecordBatch]:
        if words >= 2:
            # exact: counts are far below 2 to the power 56
            yield _row(lang, part, words, 2, 0, 0, (100 * self.longest >= self.share * self.held[2]).tobytes())


class _Scored:
    """The candidates of a range (role 0) with the counts of their parts (role 1, by words and range) and what is to be dropped (role 2)."""

    def __init__(self, most: int) -> None:
        self.most, self.own, self.counts, self.dropped = most, None, {}, None

    def add(self, lang: str, part: int, words: int, role: int, from_part: int, from_words: int, blob: bytes) -> Iterator[pa.RecordBatch]:
        if role == 0:
            self.own = unpacked(blob)
        elif role == 1:
            self.counts.setdefault(from_words, []).append(np.frombuffer(blob, np.int64))
        else:
            self.dropped = np.frombuffer(blob, bool)
        return iter(())

    def done(self, lang: str, part: int, words: int) -> Iterator[pa.RecordBatch]:
        names, columns, weights = self.own
        if not len(weights):
            return
        parts = {k: cols for k, (cols, _) in parts_of(columns, weights).items()}
        count = {k: np.concatenate(c) for k, c in self.counts.items()}
        of = lambda cols: count[len(cols)][places_of(cols, parts[len(cols)])].astype(object)
        a = weights.astype(object)
        best = None
        for k in range(1, words):
            left, right = of(columns[:k]), of(columns[k:])
            score = 1_000_000 * a * a // (left * right)
            if best is None:
                best = [score, left, right]
            else:
                lower = (score < best[0]).astype(bool)
                best = [np.where(lower, x, y) for x, y in zip((score, left, right), best, strict=True)]
        text, keep = names.to_pylist(), np.ones(len(weights), bool) if self.dropped is None else ~self.dropped
        rows = [(-int(best[0][i]), -int(weights[i]), b" ".join(text[c[i]] for c in columns), int(best[1][i]), int(best[2][i])) for i in np.flatnonzero(keep)]
        rows = sorted(rows)[: self.most]
        if rows:
            score, count_, phrase, left, right = zip(*rows, strict=True)
            out = [pa.array([lang] * len(rows)), pa.array([p.decode() for p in phrase]), pa.array([-c for c in count_]), pa.array(left), pa.array(right), pa.array([-s for s in score])]
            yield pa.RecordBatch.from_arrays(out, names=["lang", "phrase", "a", "l", "r", "score"])


def ngram_counts(docs: DataFrame, least: int = LEAST, max_words: int = MAX_WORDS) -> tuple[list[DataFrame], Broadcast]:
    """United automata (lang, part, entries, total, blob) of each order, with counts of ``least`` at least, and the bounds of their ranges."""
    spark = docs.sparkSession
    context = spark.sparkContext
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = context.broadcast(prefix_bounds(texts, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    out, known = [], None
    for order in range(1, max_words + 1):
        shards = texts.mapInArrow(_sharded(order, bounds, known), _CUT)
        dealt = shards.repartition("lang", "part").sortWithinPartitions("lang", "part")
        found = kept(dealt.mapInArrow(in_groups(2, lambda: _United(least)), "lang string, part int, entries long, total long, blob binary"))
        out.append(found)
        if order < max_words:
            entries = found.agg(F.sum("entries")).first()[0] or 0
            known = context.broadcast(phrase_filter(found, entries))
    return out, bounds


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, share: int = SHARE, max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each language the phrases of two to ``max_words`` (2 or 3) words that score best.

    A null text is empty, a null language ``und``; texts without words give nothing. Every row counts, repeated ones too, and texts are
    taken whole. Ties in score and count go to the phrase that is smaller in bytes. Other columns are ignored; an empty table gives an empty result.
    """
    if max_words not in (2, 3):
        raise ValueError("phrases have two or three words at most")
    found, bounds = ngram_counts(docs, least, max_words)
    own = [df.select("lang", "part", F.lit(k + 1).alias("words"), "blob") for k, df in enumerate(found)]
    candidates = own[1].unionByName(own[2]) if max_words == 3 else own[1]
    held = own[0].unionByName(own[1])
    zero = lambda df: df.select("lang", "part", "words", F.lit(0).alias("role"), F.lit(0).alias("to_part"), F.lit(0).alias("to_words"), "blob")
    keys = ["lang", "part", "words"]

    def met(df: DataFrame, start: Callable[[], object], schema: str) -> DataFrame:
        dealt = df.repartition(*keys).sortWithinPartitions(*keys, "role", "to_words", "to_part")
        return dealt.mapInArrow(in_groups(3, start), schema)

    asked = candidates.mapInArrow(_asked(bounds), _ASK)
    answers = met(zero(held).unionByName(asked), lambda: _Composed(share), _ASK).where("words >= 2")
    scored = met(zero(candidates).unionByName(answers), lambda: _Scored(most), "lang string, phrase string, a long, l long, r long, score long")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # a language's candidates are many rows: salts rank first
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = salted.withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("at") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    totals = found[0].groupBy("lang").agg(F.sum("total").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of each language in all documents."""
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op12_phrase_collocations": op12_phrase_collocations}
ORACLE = {
    "op12_phrase_collocations": f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
      UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) >= 2
      UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w WHERE len(w) >= 3),
f AS (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, w FROM f WHERE k >= 2 AND f >= {LEAST}),
cut AS (SELECT c.*, i AS cut, array_to_string(c.w[1:i], ' ') AS p1, array_to_string(c.w[i + 1:], ' ') AS p2 FROM c, range(1, 3) x(i) WHERE i < c.k),
s AS (SELECT cut.lang, cut.k, cut.phrase, cut.a, cut.w, cut.cut, x.f AS l, y.f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.p1 JOIN f y ON y.lang = cut.lang AND y.phrase = cut.p2),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3),
top AS (SELECT lang, phrase, max(a) AS a FROM longer GROUP BY lang, phrase),
left_ AS (SELECT b.* FROM b LEFT JOIN top ON top.lang = b.lang AND top.phrase = b.phrase WHERE top.a IS NULL OR 100 * top.a < {SHARE} * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM left_ JOIN n USING (lang) QUALIFY rank <= {MOST}
"""
}
