"""Profiling aggregates. One scan per family of questions, never one per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numeric import present, safe_ratio
from tallyloom.functions.text import to_number
from tallyloom.operators.ordering import exact_quantiles
from tallyloom.session import stored
from tallyloom.spec import TabularSpec

QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)


def _positive(label: str, positive: str) -> Column:
    return F.col(label).eqNullSafe(F.lit(positive)).cast("int")


def _long(df: DataFrame, columns: Sequence[str], keep: Sequence[Column] = ()) -> DataFrame:
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return df.select(*keep, F.inline(cells))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, n_null) for the columns that have any NULL."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "n_null").filter(F.col("n_null") > 0)


def table_facts(df: DataFrame, spec: TabularSpec) -> DataFrame:
    """Row and column counts, unparsable totals, zero tenure, in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.count_if(to_number(F.col(spec.total)).isNull()).alias("n_blank_total"),
        F.count_if(F.col(spec.tenure) == 0).alias("n_zero_tenure"),
    )


def duplicate_row_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first occurrence of their values; NULLs compare equal."""
    counts = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
        F.sum("n").alias("n_rows"),
    )


def duplicate_text_count(df: DataFrame, column: str) -> DataFrame:
    """The same for one long text column: whole texts are compared by their SHA-256, so a
    32-byte digest is shuffled instead of the text."""
    digest = df.select(F.unhex(F.sha2(F.col(column), 256)).alias("digest"))
    return duplicate_row_count(digest, ["digest"])


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    return duplicate_row_count(df.select(key), [key])


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts and shares of every value of every listed column."""
    counts = _long(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    # One total per column; distinct values may be many, so no window over them.
    totals = counts.groupBy("column").agg(F.sum("n").alias("n_all"))
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "n", (F.col("n") / F.col("n_all")).alias("share")
    )


def cardinality(
    df: DataFrame, columns: Sequence[str], approximate: bool = False
) -> DataFrame:
    """Distinct non-null values per column; the sketch form needs no shuffle of values."""
    if approximate:
        return df.agg(
            *[F.approx_count_distinct(F.col(c)).alias(c) for c in columns]
        ).unpivot([], list(columns), "column", "n_distinct")
    distinct = _long(df, columns).filter(F.col("value").isNotNull()).distinct()
    return distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def class_balance(df: DataFrame, label: str, positive: str) -> DataFrame:
    """Class counts, positive rate, and negatives per positive (denominator at least 1)."""
    pos = F.count_if(F.col(label).eqNullSafe(F.lit(positive)))
    return df.agg(pos.alias("n_positive"), F.count(F.lit(1)).alias("n_rows")).select(
        "n_positive",
        (F.col("n_rows") - F.col("n_positive")).alias("n_negative"),
        safe_ratio(F.col("n_positive"), F.col("n_rows")).alias("positive_rate"),
        F.round(
            (F.col("n_rows") - F.col("n_positive")) / F.greatest(F.col("n_positive"), F.lit(1)), 2
        ).alias("imbalance_ratio"),
    )


def majority_class(df: DataFrame, label: str) -> DataFrame:
    """Most frequent value, the smallest one on a tie."""
    return (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col(label).asc())
        .limit(1)
    )


def rate_by(df: DataFrame, group: str | Column, label: str, positive: str) -> DataFrame:
    """Positive rate by one grouping column or expression."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(_positive(label, positive)).alias("rate")
    )


def rate_by_columns(
    df: DataFrame, columns: Sequence[str], label: str, positive: str
) -> DataFrame:
    """Positive rate by every value of many columns from a single scan."""
    long = _long(df, columns, [_positive(label, positive).alias("y_")])
    return long.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"), F.avg("y_").alias("rate")
    )


def top_rates(rates: DataFrame, k: int = 2) -> DataFrame:
    """The k values of highest rate per column; ties go to the smaller value."""
    ranked = Window.partitionBy("column").orderBy(F.col("rate").desc(), F.col("value").asc())
    return rates.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def five_numbers(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Exact box-plot numbers per (column, group): quartiles, 1.5 IQR fences, outliers.

    The outlier count is a second pass against the fences. They are one row per
    (column, group) and written first, so that their size is known: few groups are broadcast
    and the rows stay where they are, very many groups are joined by shuffle.
    """
    numeric = df.select(
        F.coalesce(F.col(group).cast("string"), F.lit("missing")).alias("group"),
        *[to_number(F.col(c)).alias(c) for c in columns],
    )
    quantiles = exact_quantiles(numeric, columns, QUARTILES, ["group"])
    names = dict(zip(QUARTILES, ("min", "q1", "median", "q3", "max")))
    boxes = quantiles.groupBy("column", "group").agg(
        F.max("n").alias("n"),
        *[
            F.max(F.when(F.col("prob") == F.lit(p), F.col("value"))).alias(name)
            for p, name in names.items()
        ],
    )
    iqr = F.col("q3") - F.col("q1")
    boxes = boxes.withColumns(
        {"low_fence": F.col("q1") - 1.5 * iqr, "high_fence": F.col("q3") + 1.5 * iqr}
    )
    boxes = stored(boxes, "boxes")
    long = numeric.unpivot(["group"], list(columns), "column", "x").filter(present(F.col("x")))
    outside = (
        long.join(boxes.select("column", "group", "low_fence", "high_fence"), ["column", "group"])
        .groupBy("column", "group")
        .agg(
            F.count_if(
                (F.col("x") < F.col("low_fence")) | (F.col("x") > F.col("high_fence"))
            ).alias("n_outliers")
        )
    )
    return boxes.join(outside, ["column", "group"])


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present, one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*cells)))


def redundancy(df: DataFrame, total: Column, left: Column, right: Column) -> DataFrame:
    """How closely ``total`` follows ``left * right``: correlation and mean relative gap."""
    both = df.select(total.alias("t"), (left * right).alias("e"))
    gap = F.when(F.col("t") != 0, F.abs(F.col("t") - F.col("e")) / F.abs(F.col("t")))
    return both.filter(present(F.col("t")) & present(F.col("e"))).agg(
        F.count(F.lit(1)).alias("n"),
        F.corr("t", "e").alias("r"),
        F.avg(gap).alias("mean_relative_gap"),
    )
