"""Phrase collocations against plain Python, and their automata."""

import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from skillgrid.llm import common, phrases


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_counts(rows, longest=3):
    f = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            for n in range(1, longest + 1):
                f.update((lang or "und", tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    return f


def plain_collocations(rows, least=10, most=2000, share=50, longest=3):
    f = plain_counts(rows, longest)
    n = Counter()
    for (lang, w), c in f.items():
        n[lang] += c if len(w) == 1 else 0
    cand = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    out = []
    for (lang, w), a in cand.items():
        score, _, left, right = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        inside = lambda v: len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))  # noqa: B023, E731
        if not any(g == lang and inside(v) and 100 * b >= share * a for (g, v), b in cand.items()):
            out.append((lang, -score, -a, " ".join(w).encode(), left, right))
    result, seen = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        seen[lang] += 1
        if seen[lang] <= most:
            result.append((lang, seen[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return result


def texts_of(seed, n, size=12):
    rnd = random.Random(seed)
    marks = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\x0b", " \x1f ", ";", ""]
    names = [f"w{k}" for k in range(size)] + ["É", "é", "ab", "AB", "日本", "-", "x.y", "\x85", " "]
    return ["".join(rnd.choice(names) + rnd.choice(marks) for _ in range(rnd.randrange(0, 120))) for _ in range(n)]


def rows_of(seed, n=120):
    rnd = random.Random(seed)
    return [(rnd.choice(["en", "en", "de", None]), t) for t in texts_of(seed, n)]


EDGE = [("en", None), ("en", ""), (None, " \t\n.,"), ("en", "one"), ("xx", "a b"), (None, None), ("und", "same und " * 30), ("en", "same long text " * 20_000)]


def test_collocations_equal_plain_python(spark):
    common.ship(spark)
    rows = rows_of(1) + EDGE + [("fr", "the very same sentence again and again")] * 40
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, n int")
    got = [tuple(r) for r in phrases.collocations(df).orderBy("lang", "rank").collect()]
    assert got == plain_collocations(rows)
    two = [tuple(r) for r in phrases.collocations(df, least=4, most=7, share=90, max_words=2).orderBy("lang", "rank").collect()]
    assert two == plain_collocations(rows, 4, 7, 90, 2)
    assert phrases.collocations(df.where("false")).count() == 0
    with pytest.raises(ValueError, match="two or three"):
        phrases.collocations(df, max_words=4)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_automata_keep_paths_and_share_ends(order):
    rnd = np.random.default_rng(order)
    columns, weights = phrases.summed([rnd.integers(0, 9, 400) for _ in range(order)])
    words = pa.array([b"%d" % k for k in range(9)], pa.binary())
    names, back, again = phrases.unpacked(phrases.packed(words, columns, weights))
    assert [[names[int(x)].as_py() for x in c] for c in back] == [[words[int(x)].as_py() for x in c] for c in columns]
    assert (again == weights).all()
    same = phrases.built([np.repeat(np.arange(50), 2), np.tile([3, 4], 50)], np.ones(100, np.int64))
    assert [len(d[0]) for d in same] == [1, 1]
    none = [np.zeros(0, np.int64)] * order
    assert phrases.unpacked(phrases.packed(words, none, none[0]))[2].tolist() == []


def test_paths_too_many_for_one_key():
    big = 1 << 22
    columns = [np.array([big, 1, big]), np.array([2, big, 2]), np.array([big - 1, 3, big - 1])]
    found, n = phrases.summed(columns)
    assert [c.tolist() for c in found] == [[1, big], [big, 2], [3, big - 1]] and n.tolist() == [1, 2]


def test_shards_cut_at_bounds_unite_to_all_counts(monkeypatch):
    """Many small shards, bounds inside frequent words, unions in the middle of a group."""
    monkeypatch.setattr(phrases, "SHARD_BYTES", 2000)
    monkeypatch.setattr(phrases, "UNITE_ENTRIES", 50)
    rows = [(g or "und", t) for g, t in rows_of(5, 200)]
    plain = plain_counts(rows)
    bounds = {"en": [(b"ab",), (b"ab", b"w1"), (b"w1", b"w2", b"w3"), (b"w10",), (b"zz",)], "de": [(b"w3", b"w3")]}
    batches = [pa.RecordBatch.from_arrays([pa.array([g for g, _ in part]), pa.array([t for _, t in part])], names=["lang", "text"]) for part in (rows[k : k + 15] for k in range(0, 200, 15))]
    known = None
    for order in (1, 2, 3):
        cuts = [(r["lang"], r["part"], r["blob"]) for b in phrases._sharded(order, SimpleNamespace(value=bounds), SimpleNamespace(value=known) if known else None)(iter(batches)) for r in b.to_pylist()]
        assert len(cuts) > 20 and len({p for g, p, _ in cuts if g == "en"}) >= 5
        cuts.sort(key=lambda c: c[:2])
        batch = pa.RecordBatch.from_arrays([pa.array([c[0] for c in cuts]), pa.array([c[1] for c in cuts], pa.int32()), pa.array([c[2] for c in cuts], pa.binary())], names=["lang", "part", "blob"])
        found, keys = {}, []
        for b in phrases.in_groups(2, lambda: phrases._United(10))(iter([batch])):
            r = b.to_pylist()[0]
            names, columns, weights = phrases.unpacked(r["blob"])
            mine = [tuple(names[int(c[i])].as_py().decode() for c in columns) for i in range(len(weights))]
            keys += [(r["lang"], *(w.encode() for w in p)) for p in mine]
            found |= {(r["lang"], p): int(w) for p, w in zip(mine, weights, strict=True)}
        assert found == {k: c for k, c in plain.items() if len(k[1]) == order and c >= 10}
        assert keys == sorted(keys)
        bits = np.zeros(1 << 12, np.uint8)
        for (lang, w) in found:
            h = phrases.Filter.of([phrases.Filter.names(lang, pa.array([x.encode()], pa.binary())) for x in w])
            at = int(h[0] >> np.uint64(64 - 15))
            bits[at >> 3] |= 1 << (at & 7)
        known = phrases.Filter(bits, 15)
