"""Inputs of the catalogue queries, all derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import hash_number, seeded_hash
from tallyloom.plans.snapshot import account_snapshot
from tallyloom.sources.requests import request_json
from tallyloom.sources.tables import events
from tallyloom.spec import ACCOUNT

DRIFT_CUT = "2024-01-16"


def scored_events(spark: SparkSession, folder: str) -> DataFrame:
    """(event_id, y, p): purchases scored by their value."""
    return events(spark, folder).select(
        "event_id",
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        F.least(F.col("value") / 500.0, F.lit(1.0)).alias("p"),
    )


def event_features(spark: SparkSession, folder: str) -> DataFrame:
    """Logged features of an event: four numeric, two categorical."""
    return with_event_features(events(spark, folder))


def with_event_features(df: DataFrame) -> DataFrame:
    """The features of a table or stream of events."""
    k = F.from_json("props", "k int")["k"]
    return df.select(
        "event_id",
        "ts",
        "ts_us",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "value",
        k.cast("double").alias("k"),
        F.hour("ts").cast("double").alias("hour"),
        (F.hour("ts") >= 18).cast("int").cast("double").alias("evening"),
        "event_type",
        F.concat(F.lit("w"), F.floor((F.dayofmonth("ts") - 1) / 7)).alias("week"),
    )


EVENT_NUMERIC = ("value", "k", "hour", "evening")
EVENT_CATEGORICAL = ("event_type", "week")


def before_cut(df: DataFrame) -> DataFrame:
    return df.filter(F.col("ts") < F.lit(DRIFT_CUT).cast("timestamp_ntz"))


def after_cut(df: DataFrame) -> DataFrame:
    return df.filter(F.col("ts") >= F.lit(DRIFT_CUT).cast("timestamp_ntz"))


def defective_snapshot(spark: SparkSession, folder: str, repeats: bool = True) -> DataFrame:
    """The snapshot with defects planted by account number, and some accounts twice."""
    a = F.col("account_id")
    bad = account_snapshot(spark, folder).withColumns(
        {
            "segment": F.when(a % 37 == 5, "Unknown").otherwise(F.col("segment")),
            "tenure": F.when(a % 41 == 3, F.lit(-1)).otherwise(F.col("tenure")),
            "total_charges": F.when(a % 43 == 7, "abc").otherwise(F.col("total_charges")),
            "monthly_charges": F.when(a % 59 == 2, F.lit(-5.0)).otherwise(
                F.col("monthly_charges")
            ),
            "last_priority": F.when(a % 61 == 1, F.lit(None)).otherwise(F.col("last_priority")),
            "churn": F.when(a % 53 == 11, F.lit(None)).otherwise(F.col("churn")),
        }
    )
    if not repeats:
        return bad
    copies = F.when(a % 101 == 4, 2).otherwise(1)
    return bad.withColumn("copy_", F.explode(F.sequence(F.lit(1), copies))).drop("copy_")


def batch_number() -> Column:
    """Client batches of at most 128 consecutive accounts, some over the cap, and single records."""
    return F.expr(
        "CASE WHEN account_id % 97 = 13 THEN concat('one-', account_id) "
        "WHEN (account_id div 64) % 9 = 4 THEN concat('big-', account_id div 128) "
        "ELSE concat('b-', account_id div 64) END"
    )


def request_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_id, value): request JSON, some with a key of no contract at each of its levels."""
    a = F.col("account_id")
    extra = F.when(a % 29 == 6, F.lit("123-45")).alias("ssn")
    features = [F.col(c) for c in ACCOUNT.features]
    items = defective_snapshot(spark, folder, repeats=False).select(
        "account_id",
        batch_number().alias("batch_id"),
        F.concat(
            F.when(a % 31 == 8, '{"note":1,').otherwise("{"),
            F.substr(request_json("account_id", [*features, extra]), F.lit(2)),
        ).alias("item"),
    )
    listed = F.concat_ws(",", F.col("items.item"))
    foo = F.expr("batch_id LIKE 'b-%' AND CAST(substr(batch_id, 3) AS INT) % 11 = 7")
    return items.groupBy("batch_id").agg(
        F.sort_array(F.collect_list(F.struct("account_id", "item"))).alias("items")
    ).select(
        "batch_id",
        F.when(F.col("batch_id").startswith("one-"), listed)
        .otherwise(
            F.concat(F.when(foo, '{"foo":1,"items":[').otherwise('{"items":['), listed, F.lit("]}"))
        )
        .alias("value"),
    )


def planted_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot with a label that its features explain up to hash noise."""
    noise = hash_number(seeded_hash(7, F.col("account_id"))) / float(2**32)
    strength = (
        F.when(F.col("active") == "No", 2.0).otherwise(0.0)
        + F.when(F.col("last_status") == "F", 1.0).otherwise(0.0)
        + F.when(F.col("tenure") < 60, 1.0).otherwise(0.0)
        + F.when(F.col("bought_economy") == "Yes", -0.5).otherwise(0.0)
        + noise
    )
    churn = F.when(strength > 2.2, "Yes").otherwise("No")
    return account_snapshot(spark, folder).withColumn("churn", churn).withColumn(
        "label", (churn == "Yes").cast("int")
    )
