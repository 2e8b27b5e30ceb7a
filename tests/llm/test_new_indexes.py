"""Exact dedup and centroid clustering against plain Python, with edge cases."""

import hashlib
import random

import numpy as np
import pytest

from skillgrid.llm import centroids, common, dedup, topk


def words_of(texts):
    return np.frombuffer(b"".join(hashlib.sha256(t.encode()).digest() for t in texts), ">u8").astype(np.uint64).reshape(-1, 4)


def test_cuckoo_index_inserts_deletes_and_resizes():
    index, rnd, plain = dedup.CuckooIndex(2), random.Random(5), {}
    for turn in range(60):
        add = [(f"t{rnd.randrange(3000)}", turn * 1000 + k) for k in range(rnd.randrange(1, 120))]
        index.insert(words_of([t for t, _ in add]), np.array([i for _, i in add]), np.ones(len(add), np.int64))
        for t, i in add:
            plain.setdefault(t, []).append(i)
        gone = [(t, plain[t].pop(rnd.randrange(len(plain[t])))) for t in rnd.sample(sorted(plain), min(len(plain), 40)) if plain[t]]
        gone += [("never there", 1)]
        index.delete(words_of([t for t, _ in gone]), np.array([i for _, i in gone]))
        plain = {t: ids for t, ids in plain.items() if ids}
        index = dedup.CuckooIndex.from_bytes(index.to_bytes()) if turn % 7 == 0 else index
    names = sorted(plain)
    at = index.find(words_of(names))
    assert (at >= 0).all() and index.count[at].tolist() == [len(plain[t]) for t in names]
    assert (index.find(words_of([f"no{k}" for k in range(5000)])) < 0).all()
    assert index.live.sum() == len(plain) == (index.mark != 0).sum()
    assert len(index.mark) > 2


def test_hits_are_verified_against_stored_keys():
    """Digests alike in all bits that the filter knows are told apart."""
    d = words_of([f"x{k}" for k in range(3)])
    d[:, 0], d[:, 1] = d[0, 0], d[0, 1]
    index = dedup.CuckooIndex()
    assert index.insert(d[:2], np.array([1, 2]), np.ones(2, np.int64)).all()
    assert index.find(d).tolist() == [0, 1, -1]


def test_overflow_resizes_from_stored_keys():
    """More digests of the same two rows than slots: pushing ends, and the filter grows until they part."""
    d = words_of([f"y{k}" for k in range(12)])
    d[:, 0] = d[0, 0]
    d[:, 1] = (d[0, 1] & np.uint64(1)) + (np.arange(12).astype(np.uint64) << np.uint64(1))
    index = dedup.CuckooIndex(2)
    index.insert(d, np.arange(12), np.ones(12, np.int64))
    assert index.resizes and sorted(index.find(d).tolist()) == list(range(12))


EDGE = [(1, "a"), (2, None), (3, ""), (4, "a"), (5, "A"), (6, " a"), (None, "b"), (7, "b"), (7, "b"), (8, "long " * 100_000), (9, "long " * 100_000), (None, "n"), (None, "n"), (10, "é")]


def plain_dedup(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_dedup_edges(spark):
    common.ship(spark)
    rows = EDGE + [(100 + k, "hot") for k in range(400)] + [(1000 + k, f"t{k % 150}") for k in range(300)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, digest string, n long, keep_id string")
    got = dedup.deduplicated(df)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_dedup(rows)
    assert dedup.deduplicated(df.where("false")).count() == 0


def test_live_index_follows_changes(spark):
    common.ship(spark)
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    first, second = [(k, f"t{k % 40}") for k in range(120)], [(200 + k, f"t{k + 20}") for k in range(40)]
    gone = [first[k] for k in range(0, 120, 3)] + [second[0], (999, "never")]
    index = common.kept(dedup.updated(None, make(first), None, 8))
    index = common.kept(dedup.updated(index, make(second), make(gone), 8))
    left = [r for r in first + second if r not in gone]
    want = {}
    for i, t in left:
        want.setdefault(hashlib.sha256(t.encode()).digest(), []).append(i)
    got = {bytes(r["digest"]): (r["keep_id"], r["group_size"]) for r in dedup.live(index, make(left)).collect()}
    assert got == {d: (max(ids), len(ids)) for d, ids in want.items()}


def plain_clusters(rows, k=16, rounds=3):
    rows = [(i, np.array([int(np.floor(64 * x)) for x in v])) for i, v in rows]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v.tolist()) for i, v in rows if i is not None)[:k]
    c = [np.array(v) for _, v in start]
    near = lambda v: min((int(((v - x) ** 2).sum()), n) for n, x in enumerate(c))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in rows]
        for n in range(len(c)):
            mine = [v for (_, v), m in zip(rows, of) if m == n]
            if mine:
                c[n] = np.array([sum(x) // len(mine) for x in zip(*(v.tolist() for v in mine))])
    found = [(i, *near(v)[::-1]) for i, v in rows]
    cost = lambda n: sum(d for _, m, d in found if m == n)
    name = [hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest() for x in c]
    return sorted(((i, m, d, cost(m), sum(x[2] for x in found), name[m]) for i, m, d in found), key=repr)


@pytest.mark.parametrize("share", [0.0, 0.25, 1.0])
def test_dictionaries_lose_nothing(share):
    v = np.random.default_rng(3).integers(-5, 6, (500, 7))
    v[:200] = v[0]
    blocks = centroids.encoded(v, share)
    assert (np.concatenate([d[c] for d, c in blocks], axis=1) == v).all()
    c = v[:4] + 1
    best, far = centroids.nearest(blocks, len(v), c)
    full = ((v[:, None] - c[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (far == full.min(1)).all()


def test_clusters_equal_plain_python(spark):
    common.ship(spark)
    rnd = np.random.default_rng(7)
    good = [(k, (rnd.standard_normal(64) * (1 if k % 3 else 40)).tolist()) for k in range(300)]
    good += [(500, good[0][1]), (501, good[0][1]), (7, good[8][1]), (None, good[9][1])]
    bad = [(600, None), (601, [1.0] * 63), (602, [float("nan")] * 64), (603, [float("inf")] + [0.0] * 63), (604, [None] + [0.0] * 63), (605, [])]
    df = spark.createDataFrame([(*r, "x", "y") for r in good + bad], "vec_id long, embedding array<double>, cluster string, n string")
    got = centroids.clustered(centroids.whole_vectors(df))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_clusters(good)
    few = df.where("vec_id < 5")
    assert sorted((tuple(r) for r in centroids.clustered(centroids.whole_vectors(few)).collect()), key=repr) == plain_clusters(good[:5])
    assert centroids.clustered(centroids.whole_vectors(df.where("vec_id >= 600"))).count() == 0
    with pytest.raises(Exception, match="too large"):
        centroids.whole_vectors(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")).collect()


def test_queries_are_sent_alike_by_broadcast_and_by_salt(spark, monkeypatch):
    asked = spark.createDataFrame([(k, 64, k % 2, float(k)) for k in range(50)], "id long, dim int, class int, bound double")
    about = spark.createDataFrame([(b, 64, b % 2, b * 1.5) for b in range(9)], "block long, dim int, class int, longest double")
    one = sorted(map(tuple, topk.sent_to(asked, about, ["dim", "class"]).collect()))
    monkeypatch.setattr(topk, "BROADCAST_BLOCKS", 3)
    two = topk.sent_to(asked, about, ["dim", "class"])
    assert sorted(map(tuple, two.collect())) == one and len(one) == 25 * 5 + 25 * 4
