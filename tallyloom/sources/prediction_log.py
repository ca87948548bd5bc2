"""Append-only prediction log: pseudonymised records, tolerant reads, recent tail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import iso_utc, pseudonym, request_id_or_new, to_number
from tallyloom.spec import TabularSpec

CORRUPT = "_corrupt_record"


def feature_struct(spec: TabularSpec) -> T.StructType:
    """Logged inputs; number-or-blank features are text so that foreign logs parse."""
    number = {c: T.LongType() for c in (*spec.int_numeric, *spec.flags)}
    number |= {c: T.DoubleType() for c in spec.float_numeric}
    return T.StructType(
        [T.StructField(c, number.get(c, T.StringType())) for c in spec.features]
    )


def log_schema(features: T.StructType) -> T.StructType:
    """Declared record type around the given feature struct."""
    return T.StructType(
        [
            T.StructField("ts", T.StringType()),
            T.StructField("request_id", T.StringType()),
            T.StructField("customer_id_hash", T.StringType()),
            T.StructField("features", features),
            T.StructField("churn_probability", T.DoubleType()),
            T.StructField("prediction", T.StringType()),
            T.StructField("model_version", T.StringType()),
            T.StructField("inference_ms", T.DoubleType()),
        ]
    )


def log_records(
    scored: DataFrame,
    features: Sequence[str],
    id_col: str,
    probability: str,
    prediction: str,
    model_version: str,
    request_id: Column | None = None,
    ts: Column | None = None,
    inference_ms: Column | None = None,
) -> DataFrame:
    """One log record per scored row. The raw id leaves only as its pseudonym."""
    given = request_id if request_id is not None else F.lit(None).cast("string")
    return scored.select(
        iso_utc(ts if ts is not None else F.current_timestamp()).alias("ts"),
        request_id_or_new(given).alias("request_id"),
        pseudonym(F.col(id_col)).alias("customer_id_hash"),
        F.struct(*features).alias("features"),
        F.round(F.col(probability), 6).alias("churn_probability"),
        F.col(prediction).alias("prediction"),
        F.lit(model_version).alias("model_version"),
        (inference_ms if inference_ms is not None else F.lit(None).cast("double")).alias(
            "inference_ms"
        ),
    )


def by_day(records: DataFrame) -> DataFrame:
    """Adds the folder column of the log, the day of ``ts``; every writer partitions by it."""
    return records.withColumn("day", F.substring("ts", 1, 10))


def append_log(records: DataFrame, path: str) -> None:
    """Append as JSON lines under one folder per day, so a tail reads few files."""
    by_day(records).write.mode("append").partitionBy("day").json(path)


def parsed_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Records of text lines (``value``); blank and torn lines are left out, extra keys ignored."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        "value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return (
        lines.filter(F.length(F.trim("value")) > 0)
        .select(parsed.alias("record"))
        .filter(F.col("record").isNotNull() & F.col(f"record.{CORRUPT}").isNull())
        .select("record.*")
        .drop(CORRUPT)
    )


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parsed records of all files below a path.

    Lines are scanned as text and parsed by expression, so that every query on the result,
    also a plain count, sees the same records.
    """
    # writers may add folders below the day
    return parsed_lines(spark.read.option("recursiveFileLookup", "true").text(path), schema)


def follow_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The same records as a stream over the files that writers add."""
    files = spark.readStream.option("recursiveFileLookup", "true").text(path)
    return parsed_lines(files, schema)


def _entries(spark: SparkSession, path: str) -> list[str] | None:
    """Names directly under a path, or None if it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    return [entry.getPath().getName() for entry in fs.listStatus(folder)]


def read_log_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The log, or no rows when nothing has been written yet."""
    if _entries(spark, path) is None:
        return spark.createDataFrame([], schema)
    return read_log(spark, path, schema)


def read_recent(spark: SparkSession, path: str, schema: T.StructType, n: int) -> DataFrame:
    """The n latest records of a day-partitioned log, reading only the newest days.

    Days are opened from the newest on until they hold n records; older ones cannot
    contribute, because the day is part of the time. A log with entries outside day folders is
    refused, as their records would be missed.
    """
    names = [e for e in _entries(spark, path) or [] if not e.startswith(("_", "."))]
    foreign = sorted(e for e in names if not e.startswith("day="))
    if foreign:
        raise ValueError(f"not partitioned by day: {path} holds {foreign[0]}")
    days = sorted(names, reverse=True)
    if not days or n <= 0:
        return spark.createDataFrame([], schema)
    kept, found = [], 0
    for day in days:
        one = read_log(spark, f"{path}/{day}", schema)
        kept.append(one)
        # Only n rows are counted; one day usually suffices.
        found += one.limit(n - found).count()
        if found >= n:
            break
    rows = kept[0]
    for part in kept[1:]:
        rows = rows.unionByName(part)
    return recent(rows, n)


def recent(log: DataFrame, n: int, ts: str = "ts", tie: str = "request_id") -> DataFrame:
    """The n latest records by (ts, tie); n = 0 gives none. Every task keeps its own top n."""
    return log.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(max(n, 0))


def logged_features(log: DataFrame, spec: TabularSpec) -> DataFrame:
    """Flat feature columns of log records, foreign number texts coerced."""
    flat = log.select("features.*")
    return flat.withColumns({c: to_number(F.col(c)) for c in spec.text_numeric})
