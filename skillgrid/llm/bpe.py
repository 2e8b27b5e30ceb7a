"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is cut in halves down to leaves. Each leaf is encoded by itself; two
neighbours are then joined. The joined ids are not the two lists side by side,
since pieces and merges can reach over the cut. So a window that grows on both
sides of the cut is encoded anew until its edges are *synchronisation points*:
places where a character that is not white space is followed by white space.
The splitting pattern never matches across such a place, whatever stands
before or after it, because white space occurs in a match only at its start.
Hence the ids outside the window are proven to be those of the whole text. If a side has
no such place, the window takes that side whole.

Joining is associative and the empty text is neutral, so the result does not
depend on where the cuts fall. Decoding concatenates bytes up the same tree.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, table, texts_of

#: Characters of a leaf. Leaves are encoded in one call; longer texts by joins.
LEAF_CHARS = 4096
#: First reach of the window on each side of a cut, in characters.
FIRST_REACH = 32


class TreeCodec:
    """Encoder and decoder of one rank file; thread-safe, made once a worker."""

    def __init__(self, ranks_path: str, pattern: str, leaf_chars: int = LEAF_CHARS):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.leaf_chars = max(2, leaf_chars)

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text (uint32)."""
        text = text.encode("utf-8", "replace").decode("utf-8") if not _encodable(text) else text
        return self._encode(text, 0, len(text))

    def _leaf(self, text: str) -> np.ndarray:
        return np.asarray(self.encoding.encode_to_numpy(text, disallowed_special=()), np.uint32)

    def _encode(self, text: str, lo: int, hi: int) -> np.ndarray:
        if hi - lo <= self.leaf_chars:
            return self._leaf(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join(text, lo, mid, hi, self._encode(text, lo, mid), self._encode(text, mid, hi))

    def _join(self, text, lo, mid, hi, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        start = _sync_left(text, lo, mid)
        end = _sync_right(text, mid, hi)
        keep = len(left) - len(self._leaf(text[start:mid]))
        drop = len(self._leaf(text[mid:end]))
        return np.concatenate([left[:keep], self._leaf(text[start:end]), right[drop:]])

    def decode(self, ids: np.ndarray, leaf_ids: int = 4096) -> bytes:
        """Bytes of the ids; halves are decoded and concatenated."""
        if len(ids) <= leaf_ids:
            return self.encoding.decode_bytes(ids.tolist())
        mid = len(ids) // 2
        return self.decode(ids[:mid], leaf_ids) + self.decode(ids[mid:], leaf_ids)


def _encodable(text: str) -> bool:
    try:
        text.encode("utf-8")
    except UnicodeEncodeError:
        return False
    return True


def _is_space(sign: str) -> bool:
    r"""What the pattern's \\s matches: white space by Unicode, without the separators U+001C to U+001F."""
    return sign.isspace() and not "\x1c" <= sign <= "\x1f"


def _sync_left(text: str, lo: int, mid: int) -> int:
    """Last synchronisation point in (lo, mid), else lo; looked for in growing windows."""
    reach = FIRST_REACH
    while True:
        a = max(lo, mid - reach)
        for p in range(mid - 1, a, -1):
            if _is_space(text[p]) and not _is_space(text[p - 1]):
                return p
        if a == lo:
            return lo
        reach *= 2


def _sync_right(text: str, mid: int, hi: int) -> int:
    """First synchronisation point in (mid, hi), else hi; looked for in growing windows."""
    reach = FIRST_REACH
    while True:
        b = min(hi, mid + reach)
        for p in range(mid + 1, b):
            if _is_space(text[p]) and not _is_space(text[p - 1]):
                return p
        if b == hi:
            return hi
        reach *= 2


@functools.lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str, leaf_chars: int = LEAF_CHARS) -> TreeCodec:
    """The codec of this worker process, made on first use."""
    return TreeCodec(ranks_path, pattern, leaf_chars)


def encode_column(text: Column, ranks_path: str, pattern: str, leaf_chars: int = LEAF_CHARS) -> Column:
    """Token ids of a text column as array<int>.

    Null counts as the empty text and gives an empty array. Every match of
    ``pattern`` is encoded by itself; text that looks like a special token is
    ordinary text. Long texts are encoded whole by tree joins.
    """

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        own = codec(ranks_path, pattern, leaf_chars)

        def some(part: pa.Array) -> pa.Array:
            ids = [own.encode(t) for t in texts_of(part)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

        return in_slices(some, texts)

    return encode(text)


def decode_column(ids: Column, ranks_path: str, pattern: str) -> Column:
    """Bytes of a column of token ids (array<int>) as binary; null gives empty bytes."""

    @F.arrow_udf("binary")
    def decode(lists: pa.Array) -> pa.Array:
        own = codec(ranks_path, pattern)

        def some(part: pa.Array) -> pa.Array:
            offsets, values = part.offsets.to_numpy(), part.values.to_numpy(zero_copy_only=False)
            return pa.array([own.decode(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())

        return in_slices(some, lists)

    return decode(ids)


def round_trip_column(text: Column, ranks_path: str, pattern: str, leaf_chars: int = LEAF_CHARS) -> Column:
    """Struct (token_ids, decoded) of a text column: its ids, and the bytes that these ids decode to.

    The same as encoding and then decoding, in one worker process.
    """

    @F.arrow_udf("struct<token_ids:array<int>,decoded:binary>")
    def both(texts: pa.Array) -> pa.Array:
        own = codec(ranks_path, pattern, leaf_chars)

        def some(part: pa.Array) -> pa.Array:
            ids = [own.encode(t) for t in texts_of(part)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            decoded = pa.array([own.decode(x) for x in ids], pa.binary())
            return pa.StructArray.from_arrays([lists, decoded], names=["token_ids", "decoded"])

        return in_slices(some, texts)

    return both(text)


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "token_ids"
) -> DataFrame:
    """``docs`` with a column of token ids. A column of that name is replaced."""
    return docs.withColumn(ids, encode_column(F.col(text), ranks_path, pattern))


def decode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, ids: str = "token_ids", out: str = "decoded"
) -> DataFrame:
    """``docs`` with the decoded bytes of a column of token ids."""
    return docs.withColumn(out, decode_column(F.coalesce(F.col(ids), F.array().cast("array<int>")), ranks_path, pattern))


def round_trip_documents(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "token_ids", out: str = "decoded"
) -> DataFrame:
    """``docs`` with token ids and with the bytes they decode to; columns of those names are replaced."""
    done = docs.withColumn("__bpe", round_trip_column(F.col(text), ranks_path, pattern))
    return done.withColumns({ids: F.col("__bpe.token_ids"), out: F.col("__bpe.decoded")}).drop("__bpe")


def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, with digests of both."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = round_trip_documents(docs, path, pattern)
    return done.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op1_bpe_roundtrip": op1_bpe_roundtrip}
ORACLE: dict[str, str] = {}
