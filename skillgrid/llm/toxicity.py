"""Toxicity by a subsequence string kernel, a Nyström map and a linear SVM.

Units are words in lower case without accents, with a mark at the start, cut into
windows of ``UNIT_CHARS`` letters; letters spelled apart ("i d i o t") make one unit. The
kernel of two units sums over all subsequences of three letters that both have,
gaps allowed, each weighted by DECAY to the length it spans in either, and is
normalised. So an insult still resembles itself with letters put in, left out or
hidden behind signs. Two sentences compare by the sum over all pairs of
their units of a power of the unit kernel.

Landmarks are short strings that mark labelled documents, chosen so that together they cover
all toxic ones, and frequent neutral words. With K the landmarks' own kernel matrix, the Nyström map of a sentence is
K^(-1/2) times its kernels with the landmarks; a linear SVM is trained there on
sentences. A row's label does not say which sentence earned it, so each toxic row stands for its most
toxic sentence, which is chosen anew after each training, and every sentence of clean rows is clean.
Since the sentence kernel is a sum over units, its margin is a sum of
one number a unit, which is computed once for each distinct unit of a task. A document
scores as its worst sentence, made a probability by Platt's method. Rows are sorted by key before
anything is summed, so training on the same rows gives the same model however they are dealt.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, kept, split_remainder, table, texts_of

#: Labelled rows to learn from, as expected numbers; whole texts of rows drawn by a hash of their key.
TOXIC_ROWS, CLEAN_ROWS = 1000, 2000
#: Landmarks that mark toxic rows, and neutral ones, at most: the rank of the Nyström map.
MARKING, NEUTRAL = 48, 8
#: Rows that a mark is found in at least; the same whatever the size of the sample.
MARK_ROWS = 3
#: How often the most toxic sentence of each toxic row is chosen anew, at most.
ROUNDS = 5
#: Letters of a unit; longer words are cut into windows that overlap by half.
UNIT_CHARS = 7
DECAY = 0.6
#: A mark, or what resembles it, is so many times more frequent in toxic rows at least.
MIN_LIFT = 12.0
#: Longer sentences are cut, so that many chance likenesses do not add up.
SENTENCE_WORDS = 16
#: Power of the unit kernels within the sentence kernel: likeness counts, chance letters do not.
POWER = 6
#: Units none of whose kernels reaches this are not computed when texts are scored: 0.4 ** POWER is 0.4 % of a full likeness.
FLOOR = 0.4
#: Windows of words that are held at once.
_WINDOWS = 1 << 14
#: Score from which a document counts as toxic.
CUT = 0.3
#: Distinct words whose margins a task remembers.
_CACHE = 200_000

_SENTENCE = re.compile(r"[.!?;|\n]+(?:\s|\Z)")
_SPELLED = re.compile(r"(?<!\S)[^\W_](?:[\s.*_-][^\W_](?!\w)){3,}")
_LOOKALIKE = str.maketrans("01345@$!", "oieasasi")
_OUTER = "\"'()[]{}<>,.:;!?#%&*$+=~`_-/\\|"
#: Letters a-z are 0 to 25, the mark at a word's start is 26; whatever else a word has is a gap.
_START, _GAP = "^", 27
_BASE = _GAP + 1
_NONE = _BASE**3


def sentences_of(text: str) -> list[list[str]]:
    """Words of every sentence, in lower case; letters spelled apart are put together."""
    text = _SPELLED.sub(lambda m: "".join(c for c in m[0] if c.isalnum()), text.lower())
    words = [s.split() for s in _SENTENCE.split(text)]
    return [w[k : k + SENTENCE_WORDS] for w in words for k in range(0, len(w), SENTENCE_WORDS)]


def plain(word: str) -> str:
    """A word for comparison: accents off, look-alike signs as letters, other signs off."""
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))
    return "".join(c for c in word.strip(_OUTER).translate(_LOOKALIKE) if c.isalnum())


def windows_of(word: str) -> list[str]:
    """The units of a word: itself, or overlapping windows of ``UNIT_CHARS``."""
    word = _START + word
    if len(word) <= UNIT_CHARS:
        return [word]
    step = UNIT_CHARS // 2
    return [word[k : k + UNIT_CHARS] for k in range(0, len(word) - step, step)]


def _codes(units: list[str]) -> np.ndarray:
    """Letter codes of units of one length."""
    raw = np.frombuffer("".join(units).encode("utf-32-le", "replace"), np.uint32).reshape(len(units), -1)
    return np.where((raw >= 97) & (raw <= 122), raw - 97, np.where(raw == ord(_START), 26, _GAP)).astype(np.int64)


def _subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Feature number of every three places, and its weight; the number is _NONE if a gap takes part."""
    for i, j, k in combinations(range(codes.shape[1]), 3):
        a, b, c = codes[:, i], codes[:, j], codes[:, k]
        yield np.where((a < _GAP) & (b < _GAP) & (c < _GAP), (a * _BASE + b) * _BASE + c, _NONE), DECAY ** (k - i + 1)


def _features(unit: str) -> dict[int, float]:
    out: dict[int, float] = {}
    for code, weight in _subsequences(_codes([unit])):
        if code[0] < _NONE:
            out[int(code[0])] = out.get(int(code[0]), 0.0) + weight
    return out


@dataclass
class Kernel:
    """Landmarks, laid out as a table of their normalised features."""

    landmarks: list[str]
    table: np.ndarray  # feature x landmark
    highest: np.ndarray  # of each feature over the landmarks

    @classmethod
    def of(cls, landmarks: list[str]) -> Kernel:
        out = np.zeros((_NONE + 1, len(landmarks)), np.float32)
        for m, unit in enumerate(landmarks):
            f = _features(unit)
            norm = np.sqrt(sum(v * v for v in f.values()))
            for code, v in f.items():
                out[code, m] = v / norm
        return cls(landmarks, out, out.max(1) if landmarks else out.sum(1))

    def units(self, units: list[str], floor: float = FLOOR) -> np.ndarray:
        """Powers of the normalised kernels of units with the landmarks (units x landmarks).

        Rows of units none of whose kernels can reach ``floor`` are zero.
        """
        out = np.zeros((len(units), len(self.landmarks)), np.float32)
        by_length: dict[int, list[int]] = {}
        for k, u in enumerate(units):
            by_length.setdefault(len(u), []).append(k)
        for length, rows in by_length.items():
            if length < 3:
                continue
            for lo in range(0, len(rows), 4096):
                part = np.array(rows[lo : lo + 4096])
                found = list(_subsequences(_codes([units[k] for k in part])))
                code, weight = np.stack([c for c, _ in found], 1), np.array([w for _, w in found], np.float32)
                # no landmark is nearer than this: features that fall together only lengthen the unit
                reach = self.highest[code] @ weight / np.sqrt(((code < _NONE) @ (weight * weight)) + 1e-9)
                near = np.flatnonzero(reach >= floor)
                if not len(near):
                    continue
                code = code[near]
                dot = np.zeros((len(near), len(self.landmarks)), np.float32)
                for t, w in enumerate(weight):
                    dot += w * self.table[code[:, t]]
                kernel = dot / np.sqrt(np.maximum(_self_kernel(code, weight), 1e-9))[:, None].astype(np.float32)
                out[part[near]] = kernel**POWER
        return out

    def words(self, words: list[str]) -> np.ndarray:
        """Of every word the sum over its windows of the powers of kernels (words x landmarks)."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        flat: list[str] = []
        owner: list[int] = []

        def add() -> None:
            np.add.at(out, owner, self.units(flat))
            flat.clear()
            owner.clear()

        for k, word in enumerate(words):
            for unit in windows_of(plain(word)):
                flat.append(unit)
                owner.append(k)
                if len(flat) >= _WINDOWS:
                    add()
        if flat:
            add()
        return out


def _self_kernel(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Squared norm of each unit's features; like features of a unit add up first."""
    order = np.argsort(codes, axis=1, kind="stable")
    code, w = np.take_along_axis(codes, order, 1), weights[order]
    w = np.where(code < _NONE, w, 0.0)
    new = np.ones(code.shape, bool)
    new[:, 1:] = code[:, 1:] != code[:, :-1]
    group = np.cumsum(new.ravel()) - 1
    total = np.bincount(group, w.ravel())
    row = np.repeat(np.arange(len(code)), new.sum(1))
    return np.bincount(row, total**2, len(code))


@dataclass
class Model:
    """A trained scorer: margin of a word = kernels with the landmarks times ``beta``."""

    kernel: Kernel
    beta: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


class Scorer:
    """Scores texts with a model; remembers the margins of words."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def margins(self, texts: list[str]) -> np.ndarray:
        """The greatest sentence margin of each text; the bias for texts without words."""
        split = [sentences_of(t) for t in texts]
        new = set().union(*(w for s in split for w in s)) - self.known.keys() if split else set()
        if len(self.known) + len(new) > _CACHE:
            self.known, new = {}, set().union(*(w for s in split for w in s))
        new = sorted(new)
        for lo in range(0, len(new), 20_000):
            part = new[lo : lo + 20_000]
            self.known.update(zip(part, (self.model.kernel.words(part) @ self.model.beta).tolist(), strict=True))
        get = self.known.__getitem__
        return np.array([self.model.bias + max((sum(map(get, s)) for s in ss), default=0.0) for ss in split])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS,
    text: str = "text", key: str = "doc_id", label: str = "toxic",
) -> DataFrame:
    """(key, toxic, text) of a bounded sample of labelled rows, about so many of each class; computed once.

    Rows with a null key, label or text take no part; if a key has several labels, the
    greatest counts. Of rows of a class with the same whole text the one with the smallest key is learned from, as
    copies are no further evidence. The keys drawn are few by the two bounds, so the join
    broadcasts them and texts that were not drawn are not shuffled.
    """
    of = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
    of = of.agg((F.max(F.col(label)) > 0).cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in of.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    u = F.pmod(F.xxhash64("key", F.lit(8)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, toxic_rows / max(1, n.get(1, 0)))).otherwise(min(1.0, clean_rows / max(1, n.get(0, 0))))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    drawn = texts.join(F.broadcast(of.where(u < share)), "key")
    once = drawn.groupBy("toxic", F.sha2("text", 256).alias("digest")).agg(F.min("key").alias("key"), F.first("text").alias("text"))
    return kept(once.select("key", "toxic", "text").orderBy("key"))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row (toxic, text, row) the strings that may become landmarks: units and their stems."""
    for batch in batches:
        toxic, strings, rows = [], [], []
        for y, t, row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            words = {plain(w) for s in sentences_of(t) for w in s}
            units = {u for w in words for u in windows_of(w) if u.isascii() and u.strip(_START).isalpha()}
            found = {u[:k] for u in units for k in range(5, len(u) + 1)}
            toxic += [y] * len(found)
            strings += found
            rows += [row] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(strings, pa.string()), pa.array(rows, pa.int64())], names=["toxic", "string", "row"])


def choose_landmarks(sample: DataFrame, marking: int = MARKING, neutral: int = NEUTRAL) -> tuple[list[str], list[str]]:
    """Strings that are far more frequent in toxic rows, and the most frequent neutral ones.

    Marks are taken one by one, each the one that covers most toxic rows that are not covered yet, by its lift; once all
    are covered, they are covered again. So a mark of few rows is found as well as one of many.
    """
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    one, zero = F.col("one"), F.col("zero")
    lift = ((one + 0.5) / (n1 + 1)) / ((zero + 0.5) / (n0 + 1))
    rows = sample.select("toxic", "text", F.xxhash64("key").alias("row"))
    counts = rows.mapInArrow(_candidates, "toxic int, string string, row long").groupBy("string").agg(
        F.sum(F.col("toxic")).alias("one"), F.sum(1 - F.col("toxic")).alias("zero"), F.sort_array(F.collect_list(F.when(F.col("toxic") == 1, F.col("row")))).alias("rows")
    )
    counts = kept(counts.where(one + zero >= MARK_ROWS).withColumn("lift", F.log(lift)), small=True)
    found = counts.where((F.col("lift") > float(np.log(MIN_LIFT))) & (one >= MARK_ROWS)).select("string", "lift", "rows").orderBy("string").collect()
    left = [(r["string"], r["lift"], set(r["rows"])) for r in found]
    marks: list[str] = []
    covered: set[int] = set()
    while left and len(marks) < marking:
        best = max(left, key=lambda c: (len(c[2] - covered) * c[1], len(c[0]), c[0]))
        if not best[2] - covered:
            covered = set()
            continue
        marks.append(best[0])
        # what resembles a mark is not taken beside it
        like = Kernel.of(marks[-1:]).units([c[0] for c in left])[:, 0] >= 0.3
        covered |= best[2].union(*(c[2] for c, near in zip(left, like, strict=True) if near))
        left = [c for c, near in zip(left, like, strict=True) if not near and c[0] != best[0]]
    if not marks:
        return [], []
    common: list[str] = []
    for r in counts.where(F.abs("lift") < 1).orderBy(F.desc(one + zero), "string").select("string").toLocalIterator():
        if len(common) == neutral:
            break
        if Kernel.of(marks + common).units([r["string"]]).max() < 0.3:
            common.append(r["string"])
    return marks, common


def train(sample: DataFrame) -> Model | None:
    """A model from a bounded sample (key, toxic, text); None if one class has no rows or nothing marks the other."""
    marks, neutral = choose_landmarks(sample)
    if not marks:
        return None
    n_marks, marks = len(marks), marks + neutral
    kernel = Kernel.of(marks)

    def sentence_kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                doc, rows, toxic = [], [], []
                split = [sentences_of(t) for t in part.column(2).to_pylist()]
                words = sorted(set().union(*(w for s in split for w in s))) if split else []
                of = dict(zip(words, kernel.words(words), strict=True)) if words else {}
                for key, y, ss in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), split, strict=True):
                    for s in ss:
                        doc.append(key)
                        toxic.append(y)
                        rows.append(np.sum([of[w] for w in s], axis=0).astype(np.float16).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(toxic, pa.int32()), pa.array(rows, pa.binary())], names=["doc", "toxic", "k"])

    # sorted by key: sums do not depend on how the sample is dealt
    got = sample.select(F.xxhash64("key").alias("row"), "toxic", "text").orderBy("row").mapInArrow(sentence_kernels, "doc long, toxic int, k binary").toArrow()
    if not len(got):
        return None
    k = np.frombuffer(b"".join(got.column("k").to_pylist()), np.float16).reshape(-1, len(marks)).astype(np.float32)
    y, doc = got.column("toxic").to_numpy(), got.column("doc").to_numpy()
    if y.min() == y.max():
        return None
    # a mark that other words of clean rows resemble as often marks nothing
    ids, at = np.unique(doc, return_inverse=True)
    label = np.zeros(len(ids))
    np.maximum.at(label, at, y)
    n1, n0 = (label > 0).sum(), (label == 0).sum()
    keep = np.ones(len(marks), bool)
    for m in range(n_marks):
        fires = label[np.unique(at[k[:, m] >= 0.5])]
        keep[m] = ((fires > 0).sum() + 0.5) / (n1 + 1) >= MIN_LIFT * ((fires == 0).sum() + 0.5) / (n0 + 1)
    n_marks, marks, k = int(keep[:n_marks].sum()), [u for u, stays in zip(marks, keep, strict=True) if stays], k[:, keep]
    if not n_marks:
        return None
    kernel = Kernel.of(marks)
    own = kernel.units(marks, 0.0).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2 + 1e-6 * np.eye(len(marks)))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-4))) @ vectors.T
    clean, toxic = np.flatnonzero(y == 0), np.flatnonzero(y == 1)
    margin, witness = k[:, :n_marks].sum(1), np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        # of each toxic row the sentence of the greatest margin, of equals the first
        order = toxic[np.lexsort((toxic, -margin[toxic], at[toxic]))]
        chosen = order[np.unique(at[order], return_index=True)[1]]
        if np.array_equal(chosen, witness):
            break
        witness = chosen
        use = np.concatenate([clean, witness])
        w, bias = _svm(k[use] @ root, np.where(y[use] == 1, 1.0, -1.0))
        beta = root @ w
        margin = k @ beta + bias
    top = np.full(len(ids), -np.inf)
    np.maximum.at(top, at, margin)
    slope, offset = _platt(top, label)
    return Model(kernel, beta.astype(np.float32), float(bias), slope, offset)


def _svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 60) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, classes weighted alike, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = c * np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum())) / len(y) * 100
    w, eye = np.zeros(x.shape[1]), np.eye(x.shape[1])
    eye[-1, -1] = 1e-3
    for _ in range(steps):
        active = y * (x @ w) < 1
        xa, wa = x[active], weight[active]
        new = np.linalg.solve(eye + (xa * wa[:, None]).T @ xa, (xa * wa[:, None]).T @ y[active])
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return w[:-1], float(w[-1])


def _platt(margin: np.ndarray, label: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic that makes margins probabilities."""
    n1, n0 = label.sum(), (1 - label).sum()
    goal = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.stack([margin, np.ones(len(margin))], 1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - goal) + 1e-3 * w)
        w = w - np.clip(step, -2, 2)
    return float(max(w[0], 1e-3)), float(w[1])


def score_column(text: Column, model: Model | None, spark: SparkSession) -> Column:
    """Probability that a text is toxic. Null counts as empty; a text without words
    has the score of the bias. Without a model every score is 0."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value) if shared.value else None
        for texts in batches:
            if scorer is None:
                yield pa.array(np.zeros(len(texts)))
            else:
                yield in_slices(lambda part: pa.array(shared.value.probability(scorer.margins(texts_of(part)))), texts)

    return score(text)


def score_toxicity(docs: DataFrame, model: Model | None, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a score column (double). A column of that name is replaced."""
    return docs.withColumn(out, score_column(F.col(text), model, docs.sparkSession))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = split_remainder(F.col("doc_id"), 4) == 2
    model = train(labelled_sample(docs, table(spark, sf_dir, "labels").where(~held)))
    return score_toxicity(docs, model, out="score").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLE: dict[str, str] = {}
