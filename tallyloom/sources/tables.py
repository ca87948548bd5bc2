"""Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions.text import utc_micros


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the time also as microseconds."""
    return table(spark, folder, "events").withColumn("ts_us", utc_micros("ts"))
