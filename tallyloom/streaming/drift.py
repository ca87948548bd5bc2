"""Drift over tumbling event-time windows.

The stream keeps (window, feature, bin or category) counts, whose size does not depend on the
traffic, and appends a window once the watermark passes its end. PSI is computed from the
appended counts. Where the windows that are still open are wanted too, the counts are written as
they change, and what is not closed is marked as provisional. Rows later than the watermark are dropped, which the batch form does not do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.drift import feature_cells, psi_of_cells, status_of


_CELLS = (
    "window_start timestamp, window_end timestamp, feature string, bin int, category string, n bigint"
)


def windowed_cells(
    events: DataFrame,
    event_time: str,
    window: str,
    delay: str,
    edges: dict[str, list[float]],
    categorical: Sequence[str],
) -> DataFrame:
    """Streaming counts (window_start, window_end, feature, bin, category, n) in one aggregation."""
    timed = events.withWatermark(event_time, delay).withColumn(
        "span", F.window(event_time, window)
    )
    return feature_cells(timed, edges, categorical, ["span"]).select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        "feature",
        "bin",
        "category",
        "n",
    )


def start_cell_updates(cells: DataFrame, path: str, checkpoint: str):
    """Write the counts that each batch changes; a replayed batch overwrites its own."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        cells.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def latest_cells(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of every cell, of closed and open windows; counts only grow.

    A stream that has had no rows has written nothing and gives no cells.
    """
    try:
        written = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        written = spark.createDataFrame([], _CELLS)
    return (
        written.groupBy("window_start", "window_end", "feature", "bin", "category")
        .agg(F.max("n").alias("n"))
    )


def reached_watermark(query) -> str | None:
    """The watermark of a stream's newest batch as ISO text."""
    progress = query.lastProgress
    return progress["eventTime"].get("watermark") if progress else None


def psi_from_cells(cells: DataFrame, reference: DataFrame) -> DataFrame:
    """(window_start, feature, psi, status) from appended window counts."""
    scored = psi_of_cells(reference, cells, ["window_start"])
    return scored.select(
        "window_start",
        "feature",
        F.round("psi", 4).alias("psi"),
        status_of(F.col("psi")).alias("status"),
    )


def psi_with_open_windows(
    cells: DataFrame, reference: DataFrame, watermark: str | None
) -> DataFrame:
    """(window_start, feature, psi, status, provisional); later rows may change provisional ones."""
    scored = psi_of_cells(reference, cells, ["window_start", "window_end"])
    still_open = F.lit(True) if watermark is None else F.col("window_end") > F.to_timestamp(F.lit(watermark))
    return scored.select(
        "window_start",
        "feature",
        F.round("psi", 4).alias("psi"),
        status_of(F.col("psi")).alias("status"),
        still_open.alias("provisional"),
    )
