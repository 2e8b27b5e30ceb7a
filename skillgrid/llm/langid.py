"""Language identification by prediction by partial matching on bytes.

For each language a context tree of variable order holds, for every context of
up to ``ORDER`` bytes seen in training, how often each byte
followed. The statistics are frozen: scoring never updates them. The
probability of a byte is that of the longest context that knows it, times the
probabilities of the escapes from longer contexts (escape method C: an escape
counts as often as there are distinct followers); below the empty context all
256 bytes are alike. The code length of a text is the sum of minus log2 over
its bytes, and the language with the shortest code wins.

As the statistics are frozen, the cost of a byte depends only on the deepest
known context before it. The most frequent contexts are numbered once, and the costs of
every (context, byte class) pair are laid out as one table for each language, in ``TABLE_BYTES`` for all of them together;
scoring then is two array look-ups a byte. Of the other contexts each language keeps, as sorted lists, only those that it knows, with what followed them
and their escapes, and looks them up where a text has one: which contexts are laid out changes speed and never a
result. Bytes unseen in training share a class. Beside the tables the model has about 12 bytes for each distinct string of three or four bytes
of a language's sample (one or two MB), and two arrays by three bytes (at most 84 MB).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, giving_back, in_slices, split_remainder, table, texts_of

#: Longest context in bytes.
ORDER = 3
#: Training rows a language, as an expected number; whole texts of rows drawn by a hash of their key.
TRAIN_ROWS = 1500
#: Contexts of three bytes that are laid out as tables: seen so often in all languages together, and the most frequent
#: so many of these. The others are looked up in lists.
TABLE_COUNT, TABLE_CONTEXTS = 24, 40_000
#: Size of the tables of all languages together, at most (but for contexts of one byte, which are always laid out).
TABLE_BYTES = 64 << 20
#: A document with less posterior probability than this is not accepted as any language.
MIN_SCORE = 0.5

_GRAM = 256 ** np.arange(ORDER, -1, -1, dtype=np.uint64)
#: Bytes scored at once; bounds the memory of a task.
_CHUNK = 1 << 19


@dataclass
class Model:
    """Frozen context trees of all languages, as arrays."""

    languages: list[str]
    classes: np.ndarray  # byte -> class; the last class is for unseen bytes
    context: np.ndarray  # three classes -> number of the deepest context that is laid out
    cost: np.ndarray  # language, context * n_classes + class -> bits
    rare: list[np.ndarray]  # by order 2 and 3: classes of a context -> whether a language knows it and it is not laid out
    known: list[list[Known]]  # by order 2 and 3, language


@dataclass
class Known:
    """Contexts that are not laid out, of one language and order."""

    contexts: np.ndarray  # sorted
    escape: np.ndarray  # bits of the escape of each
    grams: np.ndarray  # context * n_classes + class, sorted
    cost: np.ndarray  # bits of each

    def bits(self, context: np.ndarray, gram: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Costs of grams whose costs in the next shorter context are ``below``."""
        if not len(self.grams):
            return below
        i = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        j = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        escape = np.where(self.contexts[j] == context, self.escape[j], 0)
        return np.where(self.grams[i] == gram, self.cost[i], escape + below)


def _known(context: np.ndarray, symbol: np.ndarray, n: np.ndarray, size: int, lower: np.ndarray, row: np.ndarray) -> Known:
    """Of distinct grams (context, symbol) with their counts: escape method C. ``lower`` has the probability of each symbol in the next shorter
    context, ``row`` the sum of all probabilities there."""
    contexts, first, of = np.unique(context, return_index=True, return_inverse=True)
    total, kinds = np.bincount(of, n, len(contexts)), np.bincount(of, minlength=len(contexts))
    rest = row[first] - np.bincount(of, lower, len(contexts))
    share = kinds / np.maximum(total + kinds, 1) / np.maximum(rest, 1e-12)
    order = np.argsort(context * size + symbol)
    cost = -np.log2(n / (total + kinds)[of])
    return Known(contexts, -np.log2(np.maximum(share, 1e-12)).astype(np.float32), (context * size + symbol)[order], cost[order].astype(np.float32))


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (ORDER + 1)-byte grams by language, summed over a task's rows in parts.

    A text is preceded by ORDER zero bytes, so that its first bytes have contexts.
    """
    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(bytes(ORDER) + (text or "").encode("utf-8", "replace"))
        for lang, texts in by_lang.items():
            parts = []
            for t in texts:
                b = np.frombuffer(t, np.uint8).astype(np.uint64)
                if len(b) > ORDER:
                    parts.append(sum(b[k : len(b) - ORDER + k] * _GRAM[k] for k in range(ORDER + 1)))
            if parts:
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )


def training_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = TRAIN_ROWS
) -> DataFrame:
    """Gram counts (lang, gram, n) of a bounded sample of labelled rows.

    Of each language about ``rows`` rows are drawn by a hash of their key (all,
    if there are fewer); texts are used whole. Rows without text or language are left out.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(key).alias("key")
    )
    share = {r["lang"]: min(1.0, rows / r["n"]) for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not share:
        share = {"": 1.0}
    shares = F.create_map(*(F.lit(x) for pair in share.items() for x in pair))
    drawn = F.pmod(F.xxhash64("key", F.lit(6)), F.lit(1 << 30)) < shares[F.col("lang")] * (1 << 30)
    counted = known.where(drawn).select("text", "lang").mapInArrow(giving_back(_gram_counts), "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame, table_count: int = TABLE_COUNT, table_contexts: int = TABLE_CONTEXTS, table_bytes: int = TABLE_BYTES) -> Model | None:
    """Context trees from gram counts; None without any. The counts of the bounded sample fit the driver."""
    got = counts.toArrow()
    if not len(got):
        return None
    langs = sorted(set(got.column("lang").to_pylist()))
    lang = np.searchsorted(langs, got.column("lang").to_numpy(zero_copy_only=False).astype(str))
    gram, n = got.column("gram").to_numpy(), got.column("n").to_numpy().astype(np.float64)
    bytes_ = np.stack([(gram >> (8 * k)) & 255 for k in range(ORDER, -1, -1)], 1)

    seen = np.zeros(256, bool)
    seen[bytes_] = True
    seen[0] = True
    classes = np.full(256, seen.sum(), np.int64)
    classes[seen] = np.arange(seen.sum())
    size = int(seen.sum()) + 1
    cls = classes[bytes_]

    # contexts that are laid out: the most frequent in all languages together, those of three bytes only with their ends of two
    code2, code3 = cls[:, 1] * size + cls[:, 2], (cls[:, 0] * size + cls[:, 1]) * size + cls[:, 2]
    rows = table_bytes // (4 * len(langs) * size)
    ctx2, inv2 = np.unique(code2, return_inverse=True)
    keep2 = np.sort(ctx2[np.argsort(-np.bincount(inv2, n), kind="stable")[: rows // 2]])
    ctx3, inv3 = np.unique(code3, return_inverse=True)
    total = np.bincount(inv3, n)
    able = (total >= table_count) & np.isin(ctx3 % (size * size), keep2)
    order = np.argsort(-total, kind="stable")
    keep3 = np.sort(ctx3[order[able[order]]][: min(table_contexts, max(0, rows - len(keep2)))])
    rare2, rare3 = ~np.isin(code2, keep2), ~np.isin(code3, keep3)

    # numbers: 0 the empty context, then one byte, two bytes, three bytes
    first2, first3 = 1 + size, 1 + size + len(keep2)
    one = 1 + np.arange(size)
    two = np.tile(one, size)
    two[keep2] = first2 + np.arange(len(keep2))
    three = np.tile(two, size)
    three[keep3] = first3 + np.arange(len(keep3))

    cost, known = np.empty((len(langs), (first3 + len(keep3)) * size), np.float32), [[], []]
    for li in range(len(langs)):
        own = lang == li
        at, w = cls[own], n[own]

        def table_of(code, numbers, own_cls=at, weight=w):
            """Counts of followers for the contexts in ``numbers``."""
            pos = np.searchsorted(numbers, code)
            hit = (pos < len(numbers)) & (numbers[np.minimum(pos, len(numbers) - 1)] == code) if len(numbers) else np.zeros(len(code), bool)
            return np.bincount(pos[hit] * size + own_cls[hit, 3], weight[hit], len(numbers) * size).reshape(-1, size)

        below = np.full((1, size), 1 / 256)
        # the class of unseen bytes stands for one of them
        p0 = _escape(np.bincount(at[:, 3], w, size)[None], below)
        p1 = _escape(table_of(at[:, 2], np.arange(size)), np.repeat(p0, size, 0))
        p2 = _escape(table_of(code2[own], keep2), p1[keep2 % size])
        lower = np.concatenate([p0, p1, p2])
        p3 = _escape(table_of(code3[own], keep3), lower[two[keep3 % (size * size)]])
        cost[li] = -np.log2(np.maximum(np.concatenate([lower, p3]), 1e-12)).ravel()
        # the same for contexts that are not laid out: of two bytes, then of three, whose ends may be among those
        some = np.flatnonzero(rare2[own])
        gram2, inv = np.unique(code2[own][some] * size + at[some, 3], return_inverse=True)
        c, x = gram2 // size, gram2 % size
        short = _known(c, x, np.bincount(inv, w[some], len(gram2)), size, lower[one[c % size], x], lower.sum(1)[one[c % size]])
        some = np.flatnonzero(rare3[own])
        c, x = code3[own][some], at[some, 3]
        end, laid = c % (size * size), ~rare2[own][some]
        under, row = lower[two[end], x], lower.sum(1)[two[end]]
        if not laid.all():
            row = np.where(laid, row, 1.0)
            under[~laid] = np.exp2(-short.cost[np.searchsorted(short.grams, end[~laid] * size + x[~laid])].astype(np.float64))
        known[0].append(short)
        known[1].append(_known(c, x, w[some], size, under, row))
    del got, gram, n, bytes_, cls
    give_back()  # the driver's
    flags = [np.zeros(size**2, bool), np.zeros(size**3, bool)]
    flags[0][code2[rare2]], flags[1][code3[rare3]] = True, True
    return Model(langs, classes.astype(np.int32), three.astype(np.int32), cost, flags, known)


def _escape(count: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities by escape method C, with those of the next shorter context below."""
    total, kinds = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
    known = count > 0
    left = np.where(known, 0, lower).sum(1, keepdims=True)  # excluded: what the longer context knows
    share = np.where(total > 0, kinds / np.maximum(total + kinds, 1), 1.0)
    return np.where(known, count / np.maximum(total + kinds, 1), share * lower / np.maximum(left, 1e-12))


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of every text under every language (texts x languages), whole texts in chunks of bounded size."""
    size = int(model.classes.max()) + 1
    out = np.zeros((len(texts), len(model.languages)))
    group: list[int] = []
    held = 0

    def flush() -> None:
        data = b"".join(bytes(ORDER) + texts[k] for k in group)
        starts = np.cumsum([0] + [len(texts[k]) + ORDER for k in group])[:-1]
        for lo in range(0, len(data), _CHUNK):
            hi = min(len(data), lo + _CHUNK)
            a = max(0, lo - ORDER)
            c = model.classes[np.frombuffer(data, np.uint8, hi - a, a)]
            if len(c) <= ORDER:
                continue
            code = (c[:-3] * size + c[1:-2]) * size + c[2:-1]
            idx = model.context[code] * np.int32(size) + c[3:]
            sought = []
            for order, context in enumerate((code % np.int32(size * size), code)):
                odd = np.flatnonzero(model.rare[order][context])
                sought.append((odd, context[odd].astype(np.int64), context[odd].astype(np.int64) * size + c[3:][odd]))
            first = a + ORDER  # place of the first scored byte
            lo_doc = np.searchsorted(starts, first, "right") - 1
            hi_doc = np.searchsorted(starts, hi - 1, "right") - 1
            cuts = np.maximum(starts[lo_doc : hi_doc + 1] + ORDER - first, 0)
            ends = np.append(np.maximum(starts[lo_doc + 1 : hi_doc + 1] - first, 0), hi - first)
            for li in range(len(model.languages)):
                each = model.cost[li][idx].astype(np.float64)
                for known, (odd, context, gram) in zip(model.known, sought, strict=True):
                    if len(odd):
                        each[odd] = known[li].bits(context, gram, each[odd])
                bits = np.concatenate([[0.0], np.cumsum(each)])
                lo_i, hi_i = np.minimum(cuts, len(idx)), np.minimum(ends, len(idx))
                out[[group[k] for k in range(lo_doc, hi_doc + 1)], li] += np.where(hi_i > lo_i, bits[hi_i] - bits[lo_i], 0)

    for k, t in enumerate(texts):
        group.append(k)
        held += len(t) + ORDER
        if held >= 4 * _CHUNK:
            flush()
            group, held = [], 0
    if group:
        flush()
    return out


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict_columns(text: Column, model: Model | None, spark: SparkSession) -> Column:
    """Struct (lang_pred, score) of a text column.

    ``und`` with score 0 for null, for texts without a letter, and if nothing
    was learned. Else the language of the shortest code (ties: first by name)
    and its posterior probability under equal priors.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        own = shared.value

        def some(part: pa.Array) -> pa.Array:
            rows = texts_of(part)
            pred, score = ["und"] * len(rows), np.zeros(len(rows))
            if own is not None:
                use = [k for k, t in enumerate(rows) if _has_letter(t)]
                bits = code_lengths(own, [rows[k].encode("utf-8", "replace") for k in use])
                for k, b in zip(use, bits, strict=True):
                    best = int(b.argmin())
                    pred[k], score[k] = own.languages[best], 1 / np.exp2(np.minimum(b[best] - b, 0)).sum()
            return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

        return in_slices(some, texts)

    return predict(text)


def identify(docs: DataFrame, model: Model | None, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column (lang_pred, score). A column of that name is replaced."""
    return docs.withColumn(out, predict_columns(F.col(text), model, docs.sparkSession))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held = split_remainder(F.col("doc_id"), 3) == 1
    model = fit(training_counts(docs.where(~held)))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), F.col("language.lang_pred").alias("lang_pred"), F.col("language.score").alias("score")
    )


QUERIES = {"op6_language_id": op6_language_id}
ORACLE: dict[str, str] = {}
