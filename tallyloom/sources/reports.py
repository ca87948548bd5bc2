"""Reference-table store and one-row report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_reference(reference: DataFrame, path: str) -> str:
    reference.write.mode("overwrite").parquet(path)
    return path


def load_reference(spark: SparkSession, path: str) -> DataFrame:
    """The stored reference; a missing path is an error of the scan."""
    return spark.read.parquet(path)


def nested_report(report: DataFrame, summary: DataFrame, n_records: int) -> DataFrame:
    """Summary row with the per-feature results (one entry per feature) as an array."""
    per_feature = report.agg(
        F.sort_array(F.collect_list(F.struct("feature", "psi", "status"))).alias("features")
    )
    both = summary.unionByName(per_feature, allowMissingColumns=True)
    merged = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
    return merged.withColumn("n_records", F.lit(n_records).cast("long"))


def write_report(row: DataFrame, path: str) -> str:
    row.write.mode("overwrite").json(path)
    return path
