"""An account snapshot derived from customers, orders, line items and parts.

Features use only orders before the cutoff; the label looks after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.tables import table
from tallyloom.spec import ACCOUNT, PART_TYPES

CUTOFF = "2000-08-01"
RECENT_FROM = "1999-08-01"


def _day(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _yes(flag):
    return F.when(F.coalesce(flag, F.lit(False)), "Yes").otherwise("No")


def order_history(orders: DataFrame) -> DataFrame:
    """Per customer: first and last order, totals in cents, recent activity, later orders.

    One aggregate with conditional terms; it combines before its only shuffle.
    """
    day = F.to_date("o_orderdate")
    before = F.col("o_orderdate") < _day(CUTOFF)
    recent = before & (F.col("o_orderdate") >= _day(RECENT_FROM))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return orders.groupBy("o_custkey").agg(
        F.min(F.when(before, day)).alias("first_day"),
        F.max(
            F.when(
                before,
                F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority"),
            )
        ).alias("last_order"),
        F.sum(F.when(before, cents)).alias("lifetime_cents"),
        F.sum(F.when(recent, cents)).alias("recent_cents"),
        F.max(recent).alias("is_active"),
        F.max(recent & (F.col("o_orderpriority") == "1-URGENT")).alias("is_urgent"),
        F.max(~before).alias("came_back"),
    )


def part_types_bought(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Per customer, one flag per part type bought in the recent year.

    The date filter shrinks orders before the line items meet them.
    """
    recent = orders.filter(
        (F.col("o_orderdate") >= _day(RECENT_FROM)) & (F.col("o_orderdate") < _day(CUTOFF))
    ).select("o_orderkey", "o_custkey")
    lines = recent.join(
        lineitem.select("l_orderkey", "l_partkey"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    typed = lines.join(
        part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    )
    return typed.groupBy("o_custkey").agg(
        *[F.max(F.col("p_type") == t).alias(f"has_{t.lower()}") for t in PART_TYPES]
    )


def _money_text(cents):
    return F.concat(
        F.expr("lifetime_cents div 100").cast("string"),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )


def account_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    customer, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    history = order_history(orders).withColumnRenamed("o_custkey", "account_id")
    bought = part_types_bought(
        orders, table(spark, folder, "lineitem"), table(spark, folder, "part")
    ).withColumnRenamed("o_custkey", "account_id")
    accounts = customer.select(
        F.col("c_custkey").alias("account_id"), "c_acctbal", "c_mktsegment"
    )
    cutoff_month = 12 * int(CUTOFF[:4]) + int(CUTOFF[5:7])
    months = F.lit(cutoff_month) - (12 * F.year("first_day") + F.month("first_day"))
    joined = accounts.join(history, "account_id", "left").join(bought, "account_id", "left")
    return joined.select(
        "account_id",
        F.when(F.col("c_acctbal") < 0, "Neg").otherwise("Pos").alias("sign_flag"),
        F.coalesce(F.col("is_urgent"), F.lit(False)).cast("bigint").alias("urgent_flag"),
        F.coalesce(months, F.lit(0)).cast("bigint").alias("tenure"),
        _yes(F.col("is_active")).alias("active"),
        F.coalesce("last_order.o_orderstatus", F.lit("No")).alias("last_status"),
        *[
            _yes(F.col(f"has_{t.lower()}")).alias(f"bought_{t.lower()}")
            for t in PART_TYPES
        ],
        F.col("c_mktsegment").alias("segment"),
        F.coalesce("last_order.o_orderpriority", F.lit("none")).alias("last_priority"),
        F.round(F.coalesce(F.col("recent_cents"), F.lit(0)) / 1200.0, 6).alias("monthly_charges"),
        F.coalesce(_money_text(F.col("lifetime_cents")), F.lit(" ")).alias("total_charges"),
        _yes(~F.coalesce(F.col("came_back"), F.lit(False))).alias("churn"),
    )


SNAPSHOT_COLUMNS = [
    ACCOUNT.id_col,
    "sign_flag",
    "urgent_flag",
    "tenure",
    "active",
    "last_status",
    *ACCOUNT.addons,
    "segment",
    "last_priority",
    "monthly_charges",
    "total_charges",
    "churn",
]
