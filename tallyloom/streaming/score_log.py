"""Requests in, pseudonymised prediction log and table of refused items and batches out."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import pseudonym
from tallyloom.operators.contracts import request_contract, with_verdict
from tallyloom.plans.preprocess import spec_by_name
from tallyloom.plans.scoring import score_rows
from tallyloom.plans.training import FinalModel
from tallyloom.session import small_table
from tallyloom.sources.prediction_log import by_day, log_records
from tallyloom.sources.requests import flatten_items, parse_batches
from tallyloom.spec import TabularSpec

_MEASURE = "batch bigint, inference_ms double"


def _all_errors() -> Column:
    """Errors of the batch, of the item and of its keys; NULL if there are none."""
    extra = F.when(
        F.size("extra_keys") > 0, F.concat(F.lit("extra keys: "), F.concat_ws(",", "extra_keys"))
    )
    own = F.when(F.col("index").isNotNull(), F.concat_ws("; ", "error", extra))
    text = F.concat_ws("; ", "batch_error", F.when(F.length(own) > 0, own))
    return F.when(F.length(text) > 0, text)


def judged_requests(
    bodies: DataFrame, final: FinalModel, spec_name: str, model_version: str
) -> DataFrame:
    """Every item of every body (columns ``request_id``, ``value``), scored or with its errors.

    A batch without items is one row without ``index``, with its ``value`` kept.
    """
    s = spec_by_name(spec_name)
    keep = ["request_id", "value", "batch_error"]
    items = flatten_items(parse_batches(bodies, "value"), s, keep, refused=True)
    lone = F.when(F.col("index").isNull(), F.col("value"))
    scored = score_rows(
        items.withColumn("value", lone), final, spec_name, "customer_id", model_version,
        request_contract(s), [*keep, "index", "extra_keys"],
    )
    judged = scored.withColumn("error", _all_errors()).withColumn("ok", F.col("error").isNull())
    return judged.select(
        "request_id",
        "index",
        "customer_id",
        *s.features,
        "ok",
        "error",
        F.when(F.col("ok"), F.col("churn_probability")).alias("churn_probability"),
        F.when(F.col("ok"), F.col("prediction")).alias("prediction"),
        "applied_threshold",
        "model_version",
        "value",
        "batch_error",
    )


def with_request_ids(bodies: DataFrame, *place: str) -> DataFrame:
    """Adds ``request_id``, one for each body, by its place in the input and its text.

    A repeated task reads the same rows in the same order and draws the same ids.
    """
    parts = F.concat_ws("\n", *place, F.monotonically_increasing_id(), "value")
    return bodies.withColumn("request_id", F.substring(F.sha2(parts, 256), 1, 32))


def score_requests(
    bodies: DataFrame, final: FinalModel, spec_name: str, model_version: str
) -> DataFrame:
    """JSON bodies (column ``value``) to scored items of the batches that are not refused."""
    judged = judged_requests(with_request_ids(bodies), final, spec_name, model_version)
    return judged.filter(F.col("batch_error").isNull()).drop("value", "batch_error")


def _refused_rows(judged: DataFrame, spec: TabularSpec) -> DataFrame:
    features = F.struct(*[F.col(c).cast("string").alias(c) for c in spec.features])
    return judged.filter(F.col("error").isNotNull()).select(
        "request_id",
        "error",
        F.col("index").cast("int").alias("index"),
        pseudonym(F.col("customer_id")).alias("customer_id_hash"),
        F.when(F.col("index").isNotNull(), features).alias("features"),
        F.when(F.col("index").isNull(), F.col("value")).alias("body"),
    )


def refused_requests(bodies: DataFrame, spec: TabularSpec) -> DataFrame:
    """(request_id, error, index, customer_id_hash, features, body) of what is not scored.

    An item is refused by its own errors, or with its batch where that is over the cap or has
    foreign keys. A batch without items is one row with the body as it came, as there is no id
    to replace in it.
    """
    keep = ["request_id", "value", "batch_error"]
    parsed = parse_batches(with_request_ids(bodies), "value")
    judged = with_verdict(flatten_items(parsed, spec, keep, refused=True), request_contract(spec))
    return _refused_rows(judged.withColumn("error", _all_errors()), spec)


def _measured(judged: DataFrame, batch_id: int, folder: str) -> tuple[DataFrame, float]:
    """The rows of a micro-batch, written once, and the milliseconds an accepted item took.

    The measure is written last and names its batch. A batch that comes again after that point
    finds its rows, with the same ids, and is not scored again.
    """
    spark = judged.sparkSession
    try:
        done = spark.read.schema(_MEASURE).parquet(f"{folder}/measure").first()
    except AnalysisException:
        done = None
    if done is None or done["batch"] != batch_id:
        seen = Observation()
        started = time.perf_counter()
        observed = judged.observe(seen, F.count_if("ok").alias("n"))
        observed.write.mode("overwrite").parquet(f"{folder}/rows")
        spent = (time.perf_counter() - started) * 1000
        share = round(spent / max(1, seen.get["n"]), 3)
        done = {"batch": batch_id, "inference_ms": share}
        measure = small_table(spark, [(batch_id, share)], _MEASURE)
        measure.write.mode("overwrite").parquet(f"{folder}/measure")
    return spark.read.schema(judged.schema).parquet(f"{folder}/rows"), done["inference_ms"]


def start_score_log(
    spark: SparkSession,
    request_folder: str,
    final: FinalModel,
    spec_name: str,
    model_version: str,
    log_path: str,
    checkpoint: str,
    max_files: int = 1000,
    refused_path: str | None = None,
):
    """One stream: accepted items go to the log, refused ones to a table beside it.

    Bodies are parsed and scored once per micro-batch. Both outputs have one folder for each
    micro-batch, which a repeated one overwrites, so that after a failure every request is in
    one of the two, once. All items of a body share its request id, and ``inference_ms`` is the
    time of the micro-batch divided by its accepted items. Refused items and batches go to
    ``refused_path``, by default ``<log_path>-refused``.
    """
    s = spec_by_name(spec_name)
    source = spark.readStream.option("maxFilesPerTrigger", max_files).text(request_folder)
    bodies = source.select(
        "value", F.col("_metadata.file_path").alias("file_"),
        F.col("_metadata.file_block_start").alias("block_"),
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        judged = judged_requests(
            with_request_ids(batch, "file_", "block_"), final, spec_name, model_version
        ).withColumn("scored_at", F.current_timestamp())
        rows, share = _measured(judged, batch_id, f"{checkpoint}-batch")
        records = log_records(
            rows.filter("ok"), s.features, "customer_id", "churn_probability", "prediction",
            model_version, F.col("request_id"), F.col("scored_at"), F.lit(float(share)),
        )
        refused = _refused_rows(rows, s).withColumn("batch", F.lit(batch_id))
        (
            by_day(records)
            .withColumn("batch", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch")
            .json(log_path)
        )
        (
            refused.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(refused_path or f"{log_path}-refused")
        )

    return (
        bodies.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
