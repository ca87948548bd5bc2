"""Ordered computations that never bring a whole group to one task.

A global or per-class running total over an ordered column is split in two: the range of the
column is cut into buckets, totals per bucket are accumulated over the (few) buckets, and the
running total inside a bucket is a window of that bucket only. Joining on the bucket and
windowing by the bucket need the same hash partitioning, so the join adds no shuffle of its own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numeric import present
from tallyloom.session import ordering_buckets, small_table, stored


def quantile_edges(
    df: DataFrame, cols: Sequence[str], n_buckets: int | None = None
) -> dict[str, list[float]]:
    """Approximate equal-weight cut points per column, from one aggregate pass.

    The driver receives at most ``n_buckets - 1`` numbers per column. They only balance the
    buckets: results built on them are exact whatever the cut points are, so they are put
    into the plan as literals and every branch of the plan sees the same buckets.
    """
    n_buckets = n_buckets or ordering_buckets(df.sparkSession)
    probs = ",".join(f"{i / n_buckets!r}D" for i in range(1, n_buckets))
    accuracy = max(10_000, 10 * n_buckets)
    numbers = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    row = numbers.agg(
        *[
            F.expr(
                f"percentile_approx(CASE WHEN NOT isnan(v{i}) THEN v{i} END, "
                f"array({probs}), {accuracy}) AS e{i}"
            )
            for i in range(len(cols))
        ]
    ).first()
    return {c: sorted({v + 0.0 for v in (row[i] or [])}) for i, c in enumerate(cols)}


def add_buckets(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Adds ``<col>__bucket`` (number of cut points <= value) by binary search in the JVM.

    Input columns become doubles with negative zero folded into zero, as grouping does.
    """
    out = df.withColumns({c: F.col(c).cast("double") + F.lit(0.0) for c in edges})
    finite = {c: [x for x in e if abs(x) != float("inf")] for c, e in edges.items()}
    searched = {c: e for c, e in finite.items() if e}
    if searched:
        out = Bucketizer(
            inputCols=list(searched),
            outputCols=[f"{c}__bucket" for c in searched],
            splitsArray=[[-float("inf"), *e, float("inf")] for e in searched.values()],
            handleInvalid="keep",
        ).transform(out)
    # Never NULL, so that joins on the bucket add no null filter to one of two equal branches
    # (which would keep Spark from reusing their shuffle). Missing values are filtered later.
    return out.withColumns(
        {
            f"{c}__bucket": F.coalesce(F.col(f"{c}__bucket").cast("int"), F.lit(0))
            if c in searched
            else F.lit(0)
            for c in edges
        }
    )


def bucket_offsets(
    cells: DataFrame, group_cols: Sequence[str], bucket: str, values: Sequence[str]
) -> DataFrame:
    """Per (group, bucket): its totals, those of all earlier buckets and of the whole group.

    ``cells`` has one row per (group, bucket), so a window partition holds at most as many
    rows as there are buckets.
    """
    keys = list(group_cols) or [F.lit(0)]
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(*keys)
    return cells.select(
        *group_cols,
        bucket,
        *values,
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"{v}__before") for v in values],
        *[F.sum(v).over(whole).alias(f"{v}_all") for v in values],
    )


def running_totals(
    counts: DataFrame,
    group_cols: Sequence[str],
    bucket: str,
    order_col: str,
    values: Sequence[str],
) -> DataFrame:
    """Adds ``<v>_cum`` (inclusive, ascending) and ``<v>_all`` to one-row-per-value counts."""
    keys = [*group_cols, bucket]
    cells = counts.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
    offsets = bucket_offsets(cells, group_cols, bucket, values).drop(*values)
    inside = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        counts.join(offsets, keys)
        .withColumns({f"{v}_cum": F.sum(v).over(inside) + F.col(f"{v}__before") for v in values})
        .drop(*[f"{v}__before" for v in values])
    )


def bucketed_row_number(
    df: DataFrame,
    partition_cols: Sequence[str],
    bucket: str,
    order_cols: Sequence[str | Column],
    out: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """row_number() over (partition by ... order by bucket, order_cols), one task per bucket.

    ``bucket`` must be monotone in the wanted order. ``total`` names a column for the size of
    the partition.
    """
    keys = [*partition_cols, bucket]
    cells = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    offsets = bucket_offsets(cells, partition_cols, bucket, ["n"]).drop("n")
    inside = Window.partitionBy(*keys).orderBy(*order_cols)
    ranked = df.join(offsets, keys).withColumn(
        out, (F.row_number().over(inside) + F.col("n__before")).cast("bigint")
    )
    if total:
        ranked = ranked.withColumnRenamed("n_all", total)
    return ranked.drop("n__before", "n_all")


def melt_buckets(
    df: DataFrame, cols: Sequence[str], keep: Sequence[str], edges: dict[str, list[float]]
) -> DataFrame:
    """Long form (keep..., column, bucket, x) of numeric columns, missing values left out."""
    wide = add_buckets(df.select(*dict.fromkeys([*keep, *cols])), edges)
    if len(cols) == 1:
        c = cols[0]
        long = wide.select(
            *keep,
            F.lit(c).alias("column"),
            F.col(f"{c}__bucket").alias("bucket"),
            F.col(c).alias("x"),
        )
    else:
        cells = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(f"{c}__bucket").alias("bucket"),
                    F.col(c).alias("x"),
                )
                for c in cols
            ]
        )
        long = wide.select(*keep, F.inline(cells))
    return long.filter(present(F.col("x")))


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    n_buckets: int | None = None,
    edges: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles, exact, as rows (group..., column, prob, value, n).

    Bucket counts tell in which bucket each wanted rank lies; only the rows of those buckets
    are then ordered. Groups must not be NULL.
    """
    edges = edges or quantile_edges(df, cols, n_buckets)
    # The same column may be both key and value; keys keep their own type under an alias.
    keys = [f"key_{g}" for g in group_cols]
    source = df.select(
        *cols, *[F.col(g).alias(k) for g, k in zip(group_cols, keys)]
    )
    long = melt_buckets(source, cols, keys, edges)
    series = [*keys, "column"]
    cell = [*series, "bucket"]

    cells = long.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    located = bucket_offsets(cells, series, "bucket", ["n"])
    rank = F.col("prob") * (F.col("n_all") - 1).cast("double")
    ranks = (
        located.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("frac", rank - F.floor(rank))
        .withColumn(
            "k", F.explode(F.array_distinct(F.array(F.floor(rank), F.ceil(rank))))
        )
        .withColumn("upper", F.col("k") > rank)
        .filter(
            (F.col("k") >= F.col("n__before")) & (F.col("k") < F.col("n__before") + F.col("n"))
        )
        .withColumn("k", F.col("k") - F.col("n__before"))
        .groupBy(*cell)
        .agg(
            F.collect_list(F.struct("prob", "frac", "k", "upper")).alias("wanted"),
            F.first("n_all").alias("n_all"),
        )
    )
    # Written once: it is used twice, and as a table its size is known, so Spark broadcasts it
    # (few groups) or joins it by shuffle (very many groups) on its own.
    wanted = stored(ranks, "quantile-ranks")
    values = (
        long.join(wanted.select(*cell), cell, "left_semi")
        .groupBy(*cell, "x")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    inside = Window.partitionBy(*cell).orderBy("x").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    picked = (
        values.withColumn("cum", F.sum("c").over(inside))
        .join(wanted, cell)
        .withColumn(
            "hit",
            F.filter(
                "wanted",
                lambda w: (w["k"] >= F.col("cum") - F.col("c")) & (w["k"] < F.col("cum")),
            ),
        )
        .select(*series, "x", "n_all", F.inline("hit"))
    )
    low = F.max(F.when(~F.col("upper"), F.col("x")))
    high = F.coalesce(F.max(F.when(F.col("upper"), F.col("x"))), low)
    return picked.groupBy(*series, "prob").agg(
        (low + (high - low) * F.max("frac")).alias("value"), F.max("n_all").alias("n")
    ).select(*[F.col(k).alias(g) for g, k in zip(group_cols, keys)], "column", "prob", "value", "n")


def fitted_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    n_buckets: int | None = None,
    edges: dict[str, list[float]] | None = None,
) -> dict[str, list[float]]:
    """Exact interpolated quantiles of whole columns, brought to the driver for a fit.

    Three passes: balancing cut points, counts per bucket (at most ``n_buckets`` per column),
    and the ordered values of only those buckets that hold a wanted rank. A column without
    values gives an empty list.
    """
    edges = edges or quantile_edges(df, cols, n_buckets)
    long = melt_buckets(df, cols, [], {c: edges[c] for c in cols})
    counts: dict[str, list[tuple[int, int]]] = {c: [] for c in cols}
    for r in long.groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["column"]].append((r["bucket"], r["n"]))

    wanted, ranks = [], {}
    for c, cells in counts.items():
        total = sum(n for _, n in cells)
        ranks[c] = [p * (total - 1) for p in probs] if total else []
        targets = {k for r in ranks[c] for k in (math.floor(r), math.ceil(r))}
        before = 0
        for bucket, n in sorted(cells):
            wanted += [(c, bucket, k, k - before) for k in targets if before <= k < before + n]
            before += n
    if not wanted:
        return {c: [] for c in cols}

    spark = df.sparkSession
    cells = small_table(
        spark, sorted({(c, b) for c, b, _, _ in wanted}), "column string, bucket int"
    )
    picks = small_table(spark, wanted, "column string, bucket int, k bigint, at bigint")
    inside = Window.partitionBy("column", "bucket").orderBy("x").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # Both small tables have at most two rows per column and probability.
    ordered = (
        long.join(F.broadcast(cells), ["column", "bucket"])
        .groupBy("column", "bucket", "x")
        .agg(F.count(F.lit(1)).alias("c"))
        .withColumn("cum", F.sum("c").over(inside))
        .join(F.broadcast(picks), ["column", "bucket"])
        .filter((F.col("at") >= F.col("cum") - F.col("c")) & (F.col("at") < F.col("cum")))
    )
    found = {(r["column"], r["k"]): r["x"] for r in ordered.select("column", "k", "x").collect()}

    def value(c: str, rank: float) -> float:
        low, high = found[c, math.floor(rank)], found[c, math.ceil(rank)]
        return low + (high - low) * (rank - math.floor(rank))

    return {c: [value(c, r) for r in ranks[c]] for c in cols}
