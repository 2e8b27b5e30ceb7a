"""The corpus pipeline: language, duplicates, secrets, mixture, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next stage's documents. All but the last keep the columns
of ``documents`` (doc_id, text, lang, source, n_chars).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgrid.llm import bpe, jaccard, langid, mixing, secrets
from skillgrid.llm.common import kept, ship, storage_folder, table

RANKS = "byte_bpe_50k.tiktoken"
#: Near-duplicate documents share so many hundredths of their shingles of so many words.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
#: Ids of duplicates up to this number are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language: those without letters, or alike in all languages, go."""
    ship(spark)
    model = langid.fit(langid.training_counts(docs))
    found = langid.identify(docs.select(*COLUMNS), model)
    sure = (F.col("language.lang_pred") != "und") & (F.col("language.score") >= langid.MIN_SCORE)
    return found.where(sure).select(*COLUMNS)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    ship(spark)
    classes = jaccard.jaccard_classes(docs, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    gone = kept(classes.where("component_id <> doc_id").select("doc_id"))
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark; n_chars is that of the new text."""
    ship(spark)
    found = secrets.scan_secrets(docs.select(*COLUMNS), *_tokenizer())
    clean = secrets.redacted(F.col("text"), F.col("secret_spans"))
    changed = F.size("secret_spans") > 0
    n_chars = F.when(changed, F.length("clean").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("clean", clean).withColumn("n_chars", n_chars).withColumn("text", F.col("clean")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn to the target weights of sources, languages and topics."""
    return mixing.mixed(docs.select(*COLUMNS), mixing.document_dimensions()).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, their number, and whether they decode to its text."""
    ship(spark)
    decoded = bpe.round_trip_documents(docs.select("doc_id", "lang", "source", "text"), *_tokenizer())
    return decoded.select(
        "doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("round_trip"), "token_ids",
    )


STAGES = [
    ("language", language),
    ("duplicates", duplicates),
    ("secrets", secret_free),
    ("mixture", mixture),
    ("tokens", tokens),
]
#: Language models and BPE are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is written to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{storage_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{folder}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
