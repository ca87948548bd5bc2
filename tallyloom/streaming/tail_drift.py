"""Drift of the last N log records, kept up to date as the log grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.operators.drift import MIN_RECORDS, WINDOW_RECORDS, report_if_enough
from tallyloom.sources.prediction_log import follow_log, recent


def start_tail_drift(
    spark: SparkSession,
    log_path: str,
    schema: T.StructType,
    reference: DataFrame,
    report_path: str,
    checkpoint: str,
    n: int = WINDOW_RECORDS,
    minimum: int = MIN_RECORDS,
):
    """Follow a prediction log and write one report per batch of new files.

    The window counts records, so it is the tail of the log and not of the batch. The state is
    the n latest records so far, a table beside the checkpoint: a batch is merged with the one
    that the batch before left (every task keeps its own top n first), so the log itself is read
    once. Records that come late count if they are among the latest. Two tables take turns, so a
    replayed batch starts from the same state and overwrites its own table and report. Fewer
    than ``minimum`` records give no report.
    """
    state = lambda batch_id: f"{checkpoint.rstrip('/')}-tail/{batch_id % 2}"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch_id > 0:
            batch = batch.unionByName(session.read.schema(schema).parquet(state(batch_id - 1)))
        recent(batch, n).write.mode("overwrite").parquet(state(batch_id))
        tail = session.read.schema(schema).parquet(state(batch_id)).select("features.*")
        report = report_if_enough(reference, tail, minimum)
        if report is not None:
            report.write.mode("overwrite").parquet(f"{report_path}/batch={batch_id}")

    return (
        follow_log(spark, log_path, schema)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
