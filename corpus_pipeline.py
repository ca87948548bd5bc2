"""Pipeline that prepares a text corpus: each stage reads what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, secret_scan, signature_join, toxicity, trie_bpe
from tallyloom.session import scratch_dir
from tallyloom.sources.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOXIC_CUT = 0.5
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
#: Bytes of rows that go to a Python worker at a time; a longer document goes alone.
BATCH_BYTES = 4 << 20


def _columns(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of documents, sent to Python workers in small batches so that many stages fit."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return docs.select(COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on the labelled ones, does not reject."""
    docs = _columns(spark, docs)
    return toxicity.keep_clean(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")), TOXIC_CUT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that hangs together by similar sets of word shingles."""
    return signature_join.one_of_each(_columns(spark, docs), SHINGLE_WORDS, SIMILAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.drop_contaminated(_columns(spark, docs), table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and the length counted anew where the text changed."""
    masked = secret_scan.mask_secrets(_columns(spark, docs).withColumn("before", F.length("text")))
    changed = F.length("text") != F.col("before")
    length = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", length).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, as little-endian 32-bit integers, and their number."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = trie_bpe.encode_documents(_columns(spark, docs), path)
    return coded.select("doc_id", trie_bpe.token_count().alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("bpe", encode),
]

#: SQL can't express the classifier or the encoder; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        kept = stage(spark, docs, sf_dir)
        path = scratch_dir(spark, f"stage-{name}")
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
