"""The corpus pipeline: five stages over the documents, each writing its result for the next one.

    language ID, SimHash near-duplicates, benchmark decontamination, secret scan, BPE encoding
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm import bpe, decontamination, langid, secrets, simhash
from shelfcast.session import cut_lineage

#: Documents with a less certain language are rejected, as are those without a letter.
MIN_SCORE = 0.5

TOKENIZER = "word_bpe_49k.json"

#: Columns of documents, which all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain enough; the network learns from the labels among them."""
    found = langid.identify(docs.select(*COLUMNS, F.col("text").alias("scored")), langid.train(docs), text="scored", carry=COLUMNS)
    accepted = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE)
    return found.where(accepted).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints within two bits: that with the smallest id."""
    return simhash.near_duplicates(docs, shingle=3, max_bits=2, carry=COLUMNS, only_first=True).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_contamination(docs, benchmark, carry=COLUMNS)
    return found.where(F.size("matches") == 0).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what looks like a live secret masked and ``n_chars`` that of the new text."""
    found = secrets.find_secrets(docs, carry=COLUMNS)
    text = secrets.redact(F.col("text"), F.filter("found", lambda s: s["live"]))
    redacted = found.withColumn("__hit", F.exists("found", lambda s: s["live"])).withColumn("text", text)
    n_chars = F.when(F.col("__hit"), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return redacted.withColumn("n_chars", n_chars).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text as little-endian unsigned 32-bit integers, and their number."""
    tokenizer = public_tokenizers.path(TOKENIZER)
    ids = bpe.encode(docs, tokenizer, carry=["doc_id", "lang", "source"])
    return ids.select("doc_id", "lang", "source", bpe.n_tokens(F.col("ids")).alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("bpe_encoding", encode),
]

#: Fingerprints, training and BPE have no SQL; tests compare the stages with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
