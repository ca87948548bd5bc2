"""Evaluation of scored rows (label 0/1, score) in one or two passes.

Scores are grouped before anything is ordered, so ties cost one row and a score shared by a
third of the table is combined on the map side. Counts stay integers up to the last division.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.numeric import (
    edges_below,
    present,
    ratio_or_null,
    safe_ratio,
)
from tallyloom.operators.ordering import (
    add_buckets,
    fitted_quantiles,
    melt_buckets,
    quantile_edges,
    running_totals,
)

# Threshold grid 0.10 ... 0.90 in hundredths, single-feature AUC flags.
THRESHOLD_GRID = tuple(range(10, 91))
REVIEW_AUC = 0.90
INVESTIGATE_AUC = 0.97


def _count_if(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))), F.lit(0))


def confusion_aggregates(y: str, p: str, threshold: float) -> list[Column]:
    pos, hit = F.col(y) == 1, F.col(p) >= F.lit(float(threshold))
    return [
        _count_if(~pos & ~hit).alias("tn"),
        _count_if(~pos & hit).alias("fp"),
        _count_if(pos & ~hit).alias("fn"),
        _count_if(pos & hit).alias("tp"),
    ]


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return safe_ratio(2 * tp, 2 * tp + fp + fn)


def rates_from_counts(df: DataFrame) -> DataFrame:
    """Adds precision, recall, F1, accuracy and macro F1 to tn, fp, fn, tp columns.

    Macro F1 is the mean over the classes that occur in the truth or in the predictions.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    has_pos, has_neg = (tp + fp + fn) > 0, (tn + fp + fn) > 0
    classes = has_pos.cast("int") + has_neg.cast("int")
    both = F.when(has_pos, _f1(tp, fp, fn)).otherwise(0.0) + F.when(
        has_neg, _f1(tn, fn, fp)
    ).otherwise(0.0)
    return df.withColumns(
        {
            "precision": safe_ratio(tp, tp + fp),
            "recall": safe_ratio(tp, tp + fn),
            "f1": _f1(tp, fp, fn),
            "accuracy": safe_ratio(tp + tn, tn + fp + fn + tp),
            "f1_macro": safe_ratio(both, classes),
        }
    )


def confusion_metrics(
    df: DataFrame, y: str, p: str, threshold: float, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts and the rates on them, one aggregate over the rows with label and score."""
    counts = with_score(df, y, p).groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(y).cast("double")).alias("positive_rate"),
        *confusion_aggregates(y, p, threshold),
    )
    return rates_from_counts(counts)


def with_score(df: DataFrame, y: str, p: str) -> DataFrame:
    """The rows that metrics count: label and score are there, and the score is a number."""
    return df.filter(present(F.col(p)) & F.col(y).isNotNull())


def _brier_expr(y: str, p: str) -> Column:
    gap = F.col(p) - F.col(y)
    return F.avg(gap * gap)


def brier(df: DataFrame, y: str, p: str) -> DataFrame:
    return with_score(df, y, p).agg(_brier_expr(y, p).alias("brier"))


def ranked_counts(
    df: DataFrame, y: str, p: str, n_buckets: int | None = None
) -> DataFrame:
    """One row per distinct score: pos, neg and tp, fp of the rule ``score >= this one``."""
    edges = quantile_edges(df, [p], n_buckets)
    counts = (
        add_buckets(with_score(df.select(y, p), y, p), edges)
        .groupBy(F.col(f"{p}__bucket").alias("bucket"), F.col(p).alias("score"))
        .agg(
            _count_if(F.col(y) == 1).cast("bigint").alias("pos"),
            _count_if(F.col(y) == 0).cast("bigint").alias("neg"),
        )
    )
    return _with_curve(running_totals(counts, [], "bucket", "score", ["pos", "neg"]))


def _with_curve(ranked: DataFrame) -> DataFrame:
    return ranked.withColumns(
        {
            "tp": F.col("pos_all") - F.col("pos_cum") + F.col("pos"),
            "fp": F.col("neg_all") - F.col("neg_cum") + F.col("neg"),
        }
    )


def _auc_expr() -> Column:
    """Mann-Whitney with half weight on ties; twice the count is summed as an exact decimal."""
    neg_below_twice = 2 * (F.col("neg_cum") - F.col("neg")) + F.col("neg")
    twice = F.sum(F.col("pos").cast("decimal(18,0)") * neg_below_twice.cast("decimal(19,0)"))
    pos, neg = F.max("pos_all").cast("double"), F.max("neg_all").cast("double")
    return F.when((pos > 0) & (neg > 0), twice.cast("double") / (2.0 * pos * neg))


def roc_auc(ranked: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve; NULL when only one class is present."""
    return ranked.groupBy(*group_cols).agg(_auc_expr().alias("roc_auc"))


def _precision(tp: Column, fp: Column) -> Column:
    """Precision with the curve's starting value 1 where nothing is predicted yet."""
    return F.when(tp + fp > 0, tp.cast("double") / (tp + fp).cast("double")).otherwise(F.lit(1.0))


def _pr_expr() -> Column:
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    width = pos.cast("double") / F.col("pos_all").cast("double")
    height = (_precision(tp, fp) + _precision(tp - pos, fp - neg)) / 2.0
    both = (F.max("pos_all") > 0) & (F.max("neg_all") > 0)
    return F.when(both, F.sum(F.when(F.col("pos_all") > 0, width * height)))


def pr_auc(ranked: DataFrame) -> DataFrame:
    """Trapezoid area under precision-recall, in curve order from (recall 0, precision 1).

    Each distinct score knows the counts above it, so a segment needs no neighbour row.
    Points of equal recall keep the curve order, which makes the area well defined.
    """
    return ranked.agg(_pr_expr().alias("pr_auc"))


def roc_points(ranked: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the start (0, 0), whose threshold is NULL."""
    points = ranked.select(
        F.col("score").alias("threshold"),
        ratio_or_null(F.col("fp"), F.col("neg_all")).alias("fpr"),
        ratio_or_null(F.col("tp"), F.col("pos_all")).alias("tpr"),
    )
    return points.unionByName(_end_point(ranked.sparkSession, points, fpr=0.0, tpr=0.0))


def _end_point(spark: SparkSession, points: DataFrame, **values: float) -> DataFrame:
    """The point of a curve that lies above every score."""
    row = [F.lit(values.get(c)).cast("double").alias(c) for c in points.columns]
    return spark.range(1).select(*row)


def pr_points(ranked: DataFrame) -> DataFrame:
    """(threshold, precision, recall) per distinct score, and (1, 0), whose threshold is NULL."""
    points = ranked.select(
        F.col("score").alias("threshold"),
        _precision(F.col("tp"), F.col("fp")).alias("precision"),
        ratio_or_null(F.col("tp"), F.col("pos_all")).alias("recall"),
    )
    return points.unionByName(_end_point(ranked.sparkSession, points, precision=1.0, recall=0.0))


def threshold_sweep(
    df: DataFrame, y: str, p: str, hundredths: Sequence[int] = THRESHOLD_GRID
) -> DataFrame:
    """Metrics at every grid threshold from a single pass over the scores.

    A row counts for all thresholds <= its score, so only its position in the grid matters:
    rows are grouped by that position and summed from the top over the few positions.
    """
    grid = sorted(int(h) for h in hundredths)
    inf = float("inf")
    slots = (
        Bucketizer(
            splits=[-inf, *[h / 100.0 for h in grid], inf], inputCol="p_", outputCol="slot"
        )
        .transform(
            df.select(F.col(y).alias("y_"), F.col(p).cast("double").alias("p_")).filter(
                present(F.col("p_")) & F.col("y_").isNotNull()
            )
        )
        .groupBy(F.col("slot").cast("bigint").alias("slot"))
        .agg(
            _count_if(F.col("y_") == 1).alias("pos"),
            _count_if(F.col("y_") == 0).alias("neg"),
        )
    )
    # Every slot must appear; the grid has len(grid) + 1 rows.
    positions = df.sparkSession.range(len(grid) + 1).withColumnRenamed("id", "slot")
    filled = positions.join(slots, "slot", "left").na.fill(0, ["pos", "neg"])
    above = Window.partitionBy(F.lit(0)).orderBy(F.col("slot").desc())
    whole = Window.partitionBy(F.lit(0))
    hundredth = F.element_at(F.array(*[F.lit(h) for h in grid]), F.col("slot").cast("int"))
    counts = (
        filled.select(
            "slot",
            F.sum("pos").over(above).alias("tp"),
            F.sum("neg").over(above).alias("fp"),
            F.sum("pos").over(whole).alias("pos_all"),
            F.sum("neg").over(whole).alias("neg_all"),
        )
        .filter(F.col("slot") > 0)
        .select(
            (hundredth / 100.0).alias("threshold"),
            "tp",
            "fp",
            (F.col("pos_all") - F.col("tp")).alias("fn"),
            (F.col("neg_all") - F.col("fp")).alias("tn"),
        )
    )
    return rates_from_counts(counts)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold of highest F1; the lowest one wins a tie."""
    return sweep.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1)


def metric_record(
    df: DataFrame, y: str, p: str, threshold: float, n_buckets: int | None = None
) -> DataFrame:
    """The whole metric suite as one row, confusion counts as a struct.

    One aggregate over the rows and one over the ranked scores; the two rows are merged.
    """
    counts = rates_from_counts(
        df.agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col(y).cast("double")).alias("positive_rate"),
            _brier_expr(y, p).alias("brier"),
            *confusion_aggregates(y, p, threshold),
        )
    )
    areas = ranked_counts(df, y, p, n_buckets).agg(
        _auc_expr().alias("roc_auc"), _pr_expr().alias("pr_auc")
    )
    both = counts.unionByName(areas, allowMissingColumns=True)
    joined = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
    return joined.select(
        F.lit(float(threshold)).alias("threshold"),
        F.col("n").alias("n_samples"),
        "positive_rate",
        "accuracy",
        "precision",
        "recall",
        "f1",
        "f1_macro",
        "roc_auc",
        "pr_auc",
        "brier",
        F.struct("tn", "fp", "fn", "tp").alias("confusion"),
    )


def calibration(df: DataFrame, y: str, p: str, bins: int = 10) -> DataFrame:
    """Quantile-bin reliability table; a score equal to an inner edge goes to the lower bin."""
    probs = [i / bins for i in range(bins + 1)]
    # bins + 1 numbers reach the driver.
    edges = fitted_quantiles(df, [p], probs)[p]
    return (
        df.filter(present(F.col(p)))
        .groupBy(edges_below(F.col(p), edges[1:-1]).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(p).alias("mean_score"),
            F.avg(F.col(y).cast("double")).alias("fraction_positive"),
        )
    )


def score_histogram(df: DataFrame, y: str, p: str, bins: int = 40) -> DataFrame:
    """Equal-width density histogram per class over that class's own score range, empty bins too."""
    scored = df.select(F.col(y).alias("y"), F.col(p).alias("p")).filter(present(F.col("p")))
    ranges = scored.groupBy("y").agg(
        F.min("p").alias("lo"), F.max("p").alias("hi"), F.count(F.lit(1)).alias("n_class")
    )
    flat = F.col("lo") == F.col("hi")
    ranges = ranges.select(
        "y",
        "n_class",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    # One row per class.
    slot = F.least(F.floor((F.col("p") - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    counts = (
        scored.join(F.broadcast(ranges), "y")
        .groupBy("y", slot.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("counted"))
    )
    every = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    filled = every.join(counts, ["y", "bin"], "left").withColumn(
        "n", F.coalesce("counted", F.lit(0).cast("bigint"))
    )
    return filled.select(
        "y",
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"),
        "n",
        (F.col("n") / (F.col("n_class") * F.col("width"))).alias("density"),
    )



def fairness_slices(
    df: DataFrame, attributes: Sequence[str], y: str, p: str, threshold: float
) -> DataFrame:
    """Size, base rate, TPR and FPR by group of every attribute, from one scan."""
    long = df.select(
        F.col(y).alias("y"),
        F.col(p).alias("p"),
        *[F.col(a).cast("string").alias(a) for a in attributes],
    ).unpivot(["y", "p"], list(attributes), "attribute", "group")
    return (
        long.groupBy("attribute", "group")
        .agg(F.count(F.lit(1)).alias("n"), *confusion_aggregates("y", "p", threshold))
        .select(
            "attribute",
            "group",
            "n",
            F.round(ratio_or_null(F.col("tp") + F.col("fn"), F.col("n")), 4).alias("churn_rate"),
            F.round(ratio_or_null(F.col("tp"), F.col("tp") + F.col("fn")), 4).alias("tpr"),
            F.round(ratio_or_null(F.col("fp"), F.col("fp") + F.col("tn")), 4).alias("fpr"),
        )
    )


def single_feature_auc(
    df: DataFrame,
    y: str,
    numeric: Sequence[str],
    text: Sequence[str],
    n_buckets: int | None = None,
) -> DataFrame:
    """Leakage screen: AUC of every single column, folded to >= 0.5, with its flag.

    A missing number counts as 0. A text column is screened only if it has exactly two
    values, as the indicator of the smaller one. All columns share one pass.
    """
    two_valued = _two_valued(df, text)
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numeric]
    cols += [
        F.col(c).eqNullSafe(F.lit(low)).cast("double").alias(c) for c, low in two_valued.items()
    ]
    names = [*numeric, *two_valued]
    wide = df.select(F.col(y).alias("y_"), *cols)
    edges = quantile_edges(wide, list(numeric), n_buckets) if numeric else {}
    edges.update({c: [1.0] for c in two_valued})
    counts = (
        melt_buckets(wide, names, ["y_"], edges)
        .groupBy(F.col("column").alias("feature"), "bucket", "x")
        .agg(
            _count_if(F.col("y_") == 1).cast("bigint").alias("pos"),
            _count_if(F.col("y_") == 0).cast("bigint").alias("neg"),
        )
    )
    ranked = running_totals(counts, ["feature"], "bucket", "x", ["pos", "neg"])
    auc = F.round(F.greatest(F.col("roc_auc"), 1.0 - F.col("roc_auc")), 4)
    return (
        roc_auc(ranked, ["feature"])
        .filter(F.col("roc_auc").isNotNull())
        .select("feature", auc.alias("auc"))
        .withColumn(
            "flag",
            F.when(F.col("auc") >= INVESTIGATE_AUC, "investigate")
            .when(F.col("auc") >= REVIEW_AUC, "review")
            .otherwise(""),
        )
        .orderBy(F.col("auc").desc(), "feature")
    )


def _two_valued(df: DataFrame, text: Sequence[str]) -> dict[str, str]:
    """Text columns with exactly two values, with the smaller one.

    min, max and "anything strictly between them" need constant state, unlike a distinct set.
    """
    if not text:
        return {}
    bounds = df.agg(
        *[F.min(c).alias(f"lo{i}") for i, c in enumerate(text)],
        *[F.max(c).alias(f"hi{i}") for i, c in enumerate(text)],
    ).first()
    low = {c: bounds[f"lo{i}"] for i, c in enumerate(text)}
    high = {c: bounds[f"hi{i}"] for i, c in enumerate(text)}
    spread = [c for c in text if low[c] is not None and low[c] != high[c]]
    if not spread:
        return {}
    other = df.agg(
        *[
            F.max(((F.col(c) != low[c]) & (F.col(c) != high[c])).cast("int")).alias(f"m{i}")
            for i, c in enumerate(spread)
        ]
    ).first()
    return {c: low[c] for i, c in enumerate(spread) if not other[f"m{i}"]}
