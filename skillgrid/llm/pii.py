"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, URL
schemes, digits and words that introduce an identifier. Around each anchor a
small deterministic parser expands and checks the span: the local part and the
domain of an address, dotted numbers, digit groups with a check digit, account
numbers. The parsers of the four base kinds give the leftmost, non-overlapping
matches of the patterns named beside them.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPAN_DDL, in_slices, span_count, span_digest, span_text, spans_array, table, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "credential_url", "iban", "account")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = "0123456789"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_GROUPS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_USERINFO = re.compile(r"://[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+")
_IBAN = re.compile(r"[\s:=#]*([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Z0-9])")
_ACCOUNT = re.compile(r"(?:\x20(?:number|no\.?|nr\.?))?[\s:=#]{1,3}([0-9](?:[\x20-]?[0-9]){5,19})(?![0-9])")
#: Words that introduce an identifier; lower, title and upper case are looked for.
CUES = ("iban", "account", "konto", "passport", "ssn", "cuenta")


@functools.lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    own = ahocorasick.Automaton()
    for sign in "@+":
        own.add_word(sign, sign)
    for digit in _DIGITS:
        own.add_word(digit, "0")
    own.add_word("://", ":")
    for cue in CUES:
        for word in {cue, cue.title(), cue.upper()}:
            own.add_word(word, "i" if cue == "iban" else "a")
    own.make_automaton()
    return own


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number holds."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def iban_holds(number: str) -> bool:
    """Whether the check digits of an account number hold (ISO 13616, modulo 97)."""
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def _digits_of(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def find_pii(text: str) -> list[tuple[str, int, int]]:
    """Spans of one text, by start and then by kind as listed in ``KINDS``."""
    spans: list[tuple[str, int, int]] = []
    email = ip = card = phone = 0  # where the last match of each kind ended
    last_digit = -2
    for at, what in _automaton().iter(text):
        if what == "0":
            # of a digit run only the first digit that is not consumed is an anchor
            first = last_digit != at - 1
            last_digit = at
            if at >= ip and (first or at == ip):
                if m := _DOTTED.match(text, at):
                    ip = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                        spans.append(("ip", *m.span()))
            if at >= card and (first or at == card):
                if m := _GROUPS.match(text, at):
                    card = m.end()
                    digits = _digits_of(m[0])
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        spans.append(("card", *m.span()))
        elif what == "@":
            if m := _DOMAIN.match(text, at + 1):
                start = at
                while start > email and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at:
                    email = m.end()
                    spans.append(("email", start, email))
        elif what == "+":
            if at >= phone and (m := _PHONE.match(text, at)):
                phone = m.end()
                if 10 <= len(_digits_of(m[0])) <= 15:
                    spans.append(("phone", *m.span()))
        elif what == ":":
            if m := _USERINFO.match(text, at - 2):
                start = at - 2
                while start > 0 and text[start - 1].isalpha() and text[start - 1].isascii():
                    start -= 1
                if start < at - 2:
                    spans.append(("credential_url", start, m.end()))
        elif what == "i":
            if (m := _IBAN.match(text, at + 1)) and iban_holds(m[1].replace(" ", "")):
                spans.append(("iban", *m.span(1)))
        elif m := _ACCOUNT.match(text, at + 1):
            spans.append(("account", *m.span(1)))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def pii_spans(text: Column) -> Column:
    """Spans of personal data in a text column: array of (kind, start, end) in code points.

    Null and empty texts give an empty array; texts are scanned whole.
    """

    @F.arrow_udf(SPAN_DDL)
    def scan(texts: pa.Array) -> pa.Array:
        return in_slices(lambda part: spans_array([find_pii(t) for t in texts_of(part)]), texts)

    return scan(text)


def scan_pii(docs: DataFrame, text: str = "text", spans: str = "pii_spans") -> DataFrame:
    """``docs`` with a column of spans. A column of that name is replaced."""
    return docs.withColumn(spans, pii_spans(F.col(text)))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts, digest of the base spans, all spans."""
    found = scan_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("pii_spans")
    return found.select(
        "doc_id",
        *(span_count(spans, k).alias(f"n_{k}") for k in BASE_KINDS),
        span_digest(spans, BASE_KINDS).alias("base_sha256"),
        span_text(spans).alias("spans"),
        F.size(spans).cast("long").alias("n_spans"),
    )


QUERIES = {"op9_pii": op9_pii}
ORACLE: dict[str, str] = {}
