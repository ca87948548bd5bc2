"""Queries of the text operators: name -> (spark, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    conversation_repair,
    decontaminate,
    pu_quality,
    quality_rules,
    secret_scan,
    signature_join,
    spelling_variants,
    substring_dedup,
    token_counts,
    token_files,
    toxicity,
    trie_bpe,
    url_filter,
)
from tallyloom.llm.common import held_out
from tallyloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query
def op1_quality(spark: SparkSession, d: str) -> DataFrame:
    """Quality score of every document by a model of positives and unlabelled text."""
    scored = pu_quality.quality_scores(table(spark, d, "documents"), table(spark, d, "labels"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op2_secrets(spark: SparkSession, d: str) -> DataFrame:
    """Secrets in every document, with the digest of the base kinds' spans."""
    found = secret_scan.secret_spans(table(spark, d, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", sha256_of(F.col("base_spans")).alias("base_sha256"), "spans"
    )


@query
def op3_url_filter(spark: SparkSession, d: str) -> DataFrame:
    """Verdict on every page's URL, by rule or by the character models."""
    judged = url_filter.url_verdicts(table(spark, d, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity score of every document by a model fitted on labelled rows."""
    docs = table(spark, d, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, d, "labels"))
    scored = toxicity.toxicity_scores(docs, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op5_token_files(spark: SparkSession, d: str) -> DataFrame:
    """Token files of all documents, read back document by document."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.read_documents(spark, token_files.write_tokens(table(spark, d, "documents"), path, end_id=2))


@query
def op6_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Words of every document that repeat passages of earlier documents."""
    found = substring_dedup.duplicate_spans(table(spark, d, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op7_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        sha256_of(F.array_join(F.array_sort("items"), ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op8_bpe(spark: SparkSession, d: str) -> DataFrame:
    """Byte-level BPE ids of every document and the text they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = trie_bpe.decode_documents(trie_bpe.encode_documents(table(spark, d, "documents"), path), path)
    return coded.select(
        "doc_id",
        trie_bpe.token_count().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        sha256_of(F.col("decoded")).alias("decoded_sha256"),
    )


@query
def op9_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    """Counts and verdict of the quality rules on every document."""
    judged = quality_rules.quality_verdicts(table(spark, d, "documents"), table(spark, d, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept")


@query
def op10_signature_join(spark: SparkSession, d: str) -> DataFrame:
    """Groups of documents whose 4-word shingle sets share 85 per cent of their union."""
    linked = signature_join.linked_documents(table(spark, d, "documents"), size=4, percent=85)
    return linked.select("doc_id", "n_shingles", "component_id")


@query
def op11_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    """Words of all documents, some misspelt by a hash, with the more frequent words near them."""
    words = spelling_variants.word_counts(table(spark, d, "documents"), every=31)
    return spelling_variants.variant_groups(words)


def damaged_messages(messages: DataFrame) -> DataFrame:
    """Messages with faults put in by a hash of conversation and turn; nulls count as one blank."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn"))) % 20
    return (
        messages.withColumn("fault", fault)
        .filter("fault <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, "user").otherwise(blank("role")).alias("role"),
            F.when(F.col("fault") == 1, "")
            .when(F.col("fault") == 2, F.translate(blank("text"), ".!?", ""))
            .otherwise(blank("text"))
            .alias("text"),
            F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


@query
def op12_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest edits and the digest of what they give."""
    original = table(spark, d, "conversations")
    messages = damaged_messages(original)
    plan = conversation_repair.repair_plan(messages)
    digests = conversation_repair.message_digests(conversation_repair.repaired_messages(messages, plan))
    digests = digests.withColumnRenamed("conv_id", "digest_id")
    found = conversation_repair.report(plan, original)
    return found.join(digests, F.col("conv_id").eqNullSafe(F.col("digest_id")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


@query
def op13_token_counts(spark: SparkSession, d: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it has more than 512 tokens."""
    counted = token_counts.token_counts(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)
