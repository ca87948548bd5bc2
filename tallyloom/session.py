"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_session(cores: str = "8", shuffle_partitions: str = "8") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyloom")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallyloom-"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_by_value(module_name: str) -> None:
    """Send the task functions of a module with the job, so executors need not install it."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    It lies in the folder that ``spark.checkpoint.dir`` names, which every executor can reach.
    Only a session in one process (``local[n]``) may do without that setting and gets a
    temporary folder; on a cluster its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tallyloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many: a table in the scratch folder for inputs of several passes.

    It cuts the lineage without keeping anything on executors that may be lost.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as a local relation: no job, and a size the planner knows."""
    fields = T.StructType.fromDDL(schema).fields
    columns = {f.name: [r[i] for r in rows] for i, f in enumerate(fields)}
    df = spark.createDataFrame(pa.table(columns))
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in fields])


def ordering_buckets(spark: SparkSession) -> int:
    """How many pieces an ordered column is cut into: a few per shuffle partition."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(32, 4 * partitions)
