"""Secret scan: fixed patterns and a token-efficiency test.

Three patterns give the base spans. Beside them, every run of characters that
a key or token may consist of is encoded by a public BPE vocabulary: ordinary
words need few tokens, random strings many, so a low number of characters a
token exposes them. Digests of known lengths, UUIDs, dates, addresses and other
identifiers are excluded first, as are the words and numbers of a path.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import codec
from .common import SPAN_DDL, in_slices, span_count, span_digest, span_text, spans_array, table, texts_of

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
#: A run under this many characters is too short to tell.
MIN_RANDOM_CHARS = 20
#: At most so many characters a token count as random.
MAX_CHARS_PER_TOKEN = 2.2

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_CUE = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RANDOM_CHARS)
#: Hexadecimal digests by length: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_DIGEST_CHARS = {32, 40, 56, 64, 96, 128}
_IDENTIFIER = re.compile(
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z"  # UUID
    r"|[0-9]{4}-[0-9]{2}-[0-9]{2}[T0-9-]*\Z"  # date and time
    r"|(?:[A-Za-z]+[-_/])+[A-Za-z]*[0-9]{0,4}\Z"  # words joined to a name or path
    r"|[+-]?[0-9+/_=-]+\Z"  # number
)
#: Parts of a run: between separators that paths, names and keys have.
_STEP, _PART = re.compile(r"[^/]+"), re.compile(r"[^/_=+-]+")


def _random(run: str, own, max_ratio: float) -> bool:
    """Whether a run is long, no known identifier, and has few characters a token."""
    if len(run) < MIN_RANDOM_CHARS or len(run) in _DIGEST_CHARS and _DIGEST.match(run) or _IDENTIFIER.match(run):
        return False
    return len(run) <= max_ratio * len(own.encode(run))


def _random_parts(run: str, own, max_ratio: float) -> list[tuple[int, int]]:
    """Random strings of a run: what is left between words and numbers of a path, whole or else its long parts."""
    found, at, end = [], None, 0
    for a, b in [*(m.span() for m in _STEP.finditer(run)), (len(run), len(run))]:
        part = run[a:b]
        word = not part or part.isdigit() or len(part) >= 3 and part.isalpha() and len(part) > max_ratio * len(own.encode(part))
        if word and at is not None:
            found, at = [*found, (at, end)], None
        elif not word:
            at, end = a if at is None else at, b
    out = []
    for a, b in found:
        if _random(run[a:b], own, max_ratio):
            out.append((a, b))
        else:
            out += [(a + m.start(), a + m.end()) for m in _PART.finditer(run[a:b]) if _random(m[0], own, max_ratio)]
    return out


def find_secrets(text: str, own, max_ratio: float = MAX_CHARS_PER_TOKEN) -> list[tuple[str, int, int]]:
    """Spans of one text, by start and then by kind as listed in ``KINDS``."""
    spans = []
    if _ASSIGN_CUE.search(text):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    base = list(spans)
    for m in _RUN.finditer(text):
        if text[m.end() : m.end() + 1] == "@" and text[max(0, m.start() - 1) : m.start()] not in (":", "/"):
            continue  # the name of an e-mail address
        for a, b in _random_parts(m[0], own, max_ratio):
            # letters that a pattern has found already need no second span
            if not (m[0][a:b].isalpha() and any(x <= m.start() + a and m.start() + b <= y for _, x, y in base)):
                spans.append(("random", m.start() + a, m.start() + b))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def secret_spans(
    text: Column, ranks_path: str, pattern: str, max_ratio: float = MAX_CHARS_PER_TOKEN
) -> Column:
    """Spans of secrets in a text column: array of (kind, start, end) in code points.

    Null and empty texts give an empty array; texts are scanned whole.
    """

    @F.arrow_udf(SPAN_DDL)
    def scan(texts: pa.Array) -> pa.Array:
        own = codec(ranks_path, pattern)
        return in_slices(lambda part: spans_array([find_secrets(t, own, max_ratio) for t in texts_of(part)]), texts)

    return scan(text)


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by [SECRET]; overlapping spans by one.

    Null stays null. The text is put together left to right from what lies between spans.
    """
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substr(text, done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        grown = F.when(span["start"] >= done["at"], F.concat(done["out"], gap, F.lit("[SECRET]")))
        return F.struct(
            grown.otherwise(done["out"]).alias("out"), F.greatest(done["at"], span["end"]).alias("at")
        )

    whole = F.aggregate(spans, start, step, lambda d: F.concat(d["out"], F.substr(text, d["at"] + 1)))
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def scan_secrets(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", spans: str = "secret_spans"
) -> DataFrame:
    """``docs`` with a column of spans. A column of that name is replaced."""
    return docs.withColumn(spans, secret_spans(F.col(text), ranks_path, pattern))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts, digest of the base spans, all spans."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    spans = F.col("secret_spans")
    return found.select(
        "doc_id",
        *(span_count(spans, k).alias(f"n_{k}") for k in BASE_KINDS),
        span_digest(spans, BASE_KINDS).alias("base_sha256"),
        span_text(spans).alias("spans"),
        F.size(spans).cast("long").alias("n_spans"),
    )


QUERIES = {"op7_secret_scan": op7_secret_scan}
ORACLE: dict[str, str] = {}
