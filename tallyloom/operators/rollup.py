"""Request-log rollup per time window and path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import present, safe_ratio
from tallyloom.operators.ordering import add_buckets, quantile_edges, running_totals


def exact_percentiles(
    df: DataFrame, groups: Sequence[str], value: str, percents: Sequence[int]
) -> DataFrame:
    """(group..., p<percent>...): the smallest value that covers the share, exact at any size.

    Values are counted first, so repeated ones are one row. The value range is cut into pieces
    and a rank is found from the totals of the pieces before, so no task orders a whole group.
    Missing values are left out; a NULL group is a group.
    """
    keyed = df.select(F.struct(*groups).alias("group_"), F.col(value).cast("double").alias("x"))
    known = keyed.filter(present(F.col("x")))
    pieces = add_buckets(known, quantile_edges(known, ["x"]))
    counts = pieces.groupBy("group_", "x__bucket", "x").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, ["group_"], "x__bucket", "x", ["n"])
    # whole numbers: the rank is the share rounded up
    rank = lambda p: F.floor((F.col("n_all") * p + 99) / 100)
    picked = [F.min(F.when(F.col("n_cum") >= rank(p), F.col("x"))).alias(f"p{p}") for p in percents]
    return ranked.groupBy("group_").agg(*picked).select("group_.*", *[f"p{p}" for p in percents])


def request_rollup(
    df: DataFrame, window_start: Column, path: str, is_error: Column, latency: str
) -> DataFrame:
    """Count, error share and exact latency percentiles; the table is read more than once."""
    rows = df.select(
        window_start.alias("window_start"),
        F.col(path).alias("path"),
        is_error.alias("is_error"),
        F.col(latency).alias("latency"),
    )
    keys = ["window_start", "path"]
    totals = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_error").alias("n_error")
    )
    percentiles = exact_percentiles(rows, keys, "latency", (50, 95))
    # one row of each kind for a group; put together without a join, as a key may be NULL
    both = totals.unionByName(percentiles, allowMissingColumns=True)
    merged = both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("n", "n_error", "p50", "p95")])
    return merged.select(
        *keys,
        "n",
        safe_ratio(F.col("n_error"), F.col("n")).alias("error_share"),
        F.col("p50").alias("latency_p50"),
        F.col("p95").alias("latency_p95"),
    )
