"""Population Stability Index drift against a stored reference distribution.

The reference is a long table (feature, kind, bin, lo, hi, category, expected). Numeric bins
are the reference deciles; they come to the driver (at most ``bins + 1`` edges per feature)
and go into the plan as literals, so binning is plain comparisons in the scan stage and only
(feature, bin) counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import closed_last_bin, floor_at, present
from tallyloom.operators.ordering import fitted_quantiles, quantile_edges
from tallyloom.session import small_table, stored

# Floor of a share, number of bins, status bounds, window and minimum size.
EPSILON = 1e-6
BINS = 10
WARNING, ALERT = 0.10, 0.20
WINDOW_RECORDS, MIN_RECORDS = 500, 50
RETRAIN_ALERTS = 3
FEW_VALUES = 10
OTHER = "__other__"
MISSING = "missing"
OUTSIDE = -1


def few_valued(df: DataFrame, features: Sequence[str], limit: int = FEW_VALUES) -> list[str]:
    """Numeric features with at most ``limit`` distinct values.

    A sketch rules out the others, so exact distinct sets stay small.
    """
    if not features:
        return []
    rough = df.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first()
    close = [c for c in features if rough[c] <= 2 * limit]
    if not close:
        return []
    exact = df.agg(*[F.size(F.collect_set(F.col(c))).alias(c) for c in close]).first()
    return [c for c in close if exact[c] <= limit]


def feature_cells(
    df: DataFrame,
    edges: dict[str, list[float]],
    categorical: Sequence[str],
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Counts (group..., feature, bin, category, n) of all features from one scan.

    Numeric features fill ``bin`` (-1 outside the edges), categorical ones ``category``, where
    a missing value is a category of its own. Counts are combined before the shuffle, so its
    size follows the number of cells, not of rows. Batch or streaming.
    """
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            F.coalesce(closed_last_bin(F.col(f).cast("double"), e), F.lit(OUTSIDE)).alias("bin"),
            F.lit(None).cast("string").alias("category"),
            present(F.col(f).cast("double")).alias("has_value"),
        )
        for f, e in edges.items()
        if len(e) >= 2
    ]
    cells += [
        F.struct(
            F.lit(f).alias("feature"),
            F.lit(None).cast("int").alias("bin"),
            F.coalesce(F.col(f).cast("string"), F.lit(MISSING)).alias("category"),
            F.lit(True).alias("has_value"),
        )
        for f in categorical
    ]
    if not cells:
        raise ValueError("no usable feature: numeric ones need two distinct edges")
    return (
        df.select(*group_cols, F.inline(F.array(*cells)))
        .filter("has_value")
        .groupBy(*group_cols, "feature", "bin", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fit_reference(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    bins: int = BINS,
    compat: bool = False,
) -> DataFrame:
    """Reference table of a training set.

    Numeric features with ten values or fewer are treated as categories, because deciles of
    a 0/1 column collapse to one bin that can never drift; ``compat`` keeps them numeric.
    """
    cuts = quantile_edges(df, numeric) if numeric else {}
    few: list[str] = []
    if not compat:
        # So few values have as few distinct cut points.
        few = few_valued(df, [f for f in numeric if len(cuts[f]) <= FEW_VALUES])
    numeric = [f for f in numeric if f not in few]
    probs = [i / bins for i in range(bins + 1)]
    deciles = fitted_quantiles(df, numeric, probs, edges=cuts) if numeric else {}
    edges = {f: sorted(set(v)) for f, v in deciles.items() if len(set(v)) >= 2}

    cells = stored(feature_cells(df, edges, [*categorical, *few]), "reference-cells")
    shares = cells.filter("bin is null or bin >= 0")
    totals = shares.groupBy("feature").agg(F.sum("n").alias("n_all"))
    # One row per feature.
    shares = shares.join(F.broadcast(totals), "feature").select(
        "feature", "bin", "category", (F.col("n") / F.col("n_all")).alias("expected")
    )
    known = shares.filter("category is not null").select(
        "feature",
        F.lit("categorical").alias("kind"),
        "bin",
        F.lit(None).cast("double").alias("lo"),
        F.lit(None).cast("double").alias("hi"),
        "category",
        "expected",
    )
    if not edges:
        return known
    grid = small_table(
        df.sparkSession,
        [(f, i, e[i], e[i + 1]) for f, e in edges.items() for i in range(len(e) - 1)],
        "feature string, bin int, lo double, hi double",
    )
    binned = grid.join(
        shares.filter("bin is not null").drop("category"), ["feature", "bin"], "left"
    ).select(
        "feature",
        F.lit("numeric").alias("kind"),
        "bin",
        "lo",
        "hi",
        F.lit(None).cast("string").alias("category"),
        F.coalesce("expected", F.lit(0.0)).alias("expected"),
    )
    return binned.unionByName(known)


def reference_edges(reference: DataFrame) -> dict[str, list[float]]:
    """Bin edges of the numeric features of a stored reference (``bins`` rows per feature)."""
    rows = (
        reference.filter(F.col("kind") == "numeric")
        .select("feature", "bin", "lo", "hi")
        .orderBy("feature", "bin")
        .collect()
    )
    edges: dict[str, list[float]] = {}
    for r in rows:
        edges.setdefault(r["feature"], [r["lo"]]).append(r["hi"])
    return edges


def reference_categories(reference: DataFrame) -> list[str]:
    """The features that a stored reference holds as categories."""
    named = reference.filter(F.col("kind") == "categorical").select("feature").distinct()
    return sorted(r["feature"] for r in named.collect())


def psi(cells: DataFrame, keys: Sequence[str], expected: str = "e", actual: str = "a") -> DataFrame:
    """PSI per key over rows of paired shares: floor both, renormalise both, sum.

    Written with sums only, so it is one hash aggregate: with E and A the sums of the floored
    columns, (a/A - e/E) * ln((a/A)/(e/E)) expands into sums of a*ln(a/e), e*ln(a/e), a and e.
    """
    e, a = floor_at(F.col(expected), EPSILON), floor_at(F.col(actual), EPSILON)
    sums = cells.select(*keys, e.alias("e_"), a.alias("a_")).groupBy(*keys).agg(
        F.sum("e_").alias("es"),
        F.sum("a_").alias("as"),
        F.sum(F.col("a_") * F.ln(F.col("a_") / F.col("e_"))).alias("al"),
        F.sum(F.col("e_") * F.ln(F.col("a_") / F.col("e_"))).alias("el"),
    )
    # The normalising factor ln(E/A) is the same in every term and the shares sum to one on
    # both sides, so its two contributions cancel.
    return sums.select(
        *keys, (F.col("al") / F.col("as") - F.col("el") / F.col("es")).alias("psi")
    )


def psi_of_cells(
    reference: DataFrame, cells: DataFrame, group_cols: Sequence[str] = ()
) -> DataFrame:
    """(group..., feature, kind, psi, n_out_of_range) from observed counts.

    Numbers outside the reference range are left out and counted; if all are outside, the
    observed shares are all floored, that is uniform. Categories unknown to the reference are
    pooled with expected share 0, and for categories the floor acts on counts, not shares.
    Features without any observed value are left out.
    """
    keys = [*group_cols, "feature"]
    kind = F.when(F.col("category").isNull(), "numeric").otherwise("categorical")
    seen = cells.select(
        *keys,
        kind.alias("kind"),
        F.coalesce("category", F.col("bin").cast("string")).alias("cell"),
        "n",
    )
    known = reference.select(
        "feature",
        "kind",
        F.coalesce("category", F.col("bin").cast("string")).alias("cell"),
        "expected",
    )
    pool = (
        known.filter(F.col("kind") == "categorical")
        .select("feature", "kind")
        .distinct()
        .select("feature", "kind", F.lit(OTHER).alias("cell"), F.lit(0.0).alias("expected"))
    )
    outside = (F.col("kind") == "numeric") & (F.col("cell") == str(OUTSIDE))
    per_feature = seen.groupBy(*keys, "kind").agg(
        F.sum(F.when(~outside, F.col("n")).otherwise(0)).alias("n_in"),
        F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("n_out_of_range"),
    )
    placed = (
        seen.filter(~outside)
        .join(known, ["feature", "kind", "cell"], "left")
        .select(
            *keys,
            "kind",
            F.when(F.col("expected").isNull(), OTHER).otherwise(F.col("cell")).alias("cell"),
            "n",
        )
        .groupBy(*keys, "kind", "cell")
        .agg(F.sum("n").alias("n"))
    )
    # Every observed feature meets each of its reference cells, also those without a row.
    grid = per_feature.join(known.unionByName(pool), ["feature", "kind"])
    count = F.coalesce("n", F.lit(0)).cast("double")
    paired = grid.join(placed, [*keys, "kind", "cell"], "left").withColumn(
        "actual",
        F.when(F.col("kind") == "categorical", count).otherwise(
            count / F.greatest(F.col("n_in"), F.lit(1))
        ),
    )
    return psi(paired, [*keys, "kind", "n_out_of_range"], "expected", "actual").select(
        *keys, "kind", "psi", "n_out_of_range"
    )


def observed_cells(
    reference: DataFrame, current: DataFrame, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Counts of the current rows in the cells of the reference, written as a small table.

    This is the only pass over the current rows. Features of the reference that the current
    table lacks are skipped.
    """
    edges = {f: e for f, e in reference_edges(reference).items() if f in current.columns}
    categorical = [f for f in reference_categories(reference) if f in current.columns]
    return stored(
        feature_cells(current, edges, categorical, group_cols),
        "observed-cells",
    )


def psi_numeric(
    reference: DataFrame, current: DataFrame, group_cols: Sequence[str] = ()
) -> DataFrame:
    """PSI of the numeric features only."""
    part = reference.filter(F.col("kind") == "numeric")
    return psi_of_cells(part, observed_cells(part, current, group_cols), group_cols)


def psi_categorical(
    reference: DataFrame, current: DataFrame, group_cols: Sequence[str] = ()
) -> DataFrame:
    """PSI of the categorical features only."""
    part = reference.filter(F.col("kind") == "categorical")
    return psi_of_cells(part, observed_cells(part, current, group_cols), group_cols)


def status_of(psi_col: Column, warning: float = WARNING, alert: float = ALERT) -> Column:
    return F.when(psi_col < warning, "ok").when(psi_col < alert, "warning").otherwise("alert")


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    group_cols: Sequence[str] = (),
    warning: float = WARNING,
    alert: float = ALERT,
) -> DataFrame:
    """(group..., feature, kind, psi, status, n_out_of_range); status uses the exact PSI."""
    scored = psi_of_cells(
        reference, observed_cells(reference, current, group_cols), group_cols
    )
    return scored.select(
        *group_cols,
        "feature",
        "kind",
        F.round("psi", 4).alias("psi"),
        status_of(F.col("psi"), warning, alert).alias("status"),
        "n_out_of_range",
    )


def report_if_enough(
    reference: DataFrame, current: DataFrame, minimum: int = MIN_RECORDS
) -> DataFrame | None:
    """The report, or None when there are fewer than ``minimum`` records."""
    if current.limit(minimum).count() < minimum:
        return None
    return drift_report(reference, current)


def top_features(report: DataFrame, n: int = 10) -> DataFrame:
    return report.orderBy(F.col("psi").desc(), "feature").limit(n)


def drift_summary(report: DataFrame) -> DataFrame:
    """One row: features checked, worst PSI, counts per status, alert flag."""
    return report.agg(
        F.count(F.lit(1)).alias("features_checked"),
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("worst_psi"),
        F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") == "warning").alias("n_warning"),
        F.count_if(F.col("status") == "alert").alias("n_alert"),
    ).withColumn("has_alert", F.col("n_alert") > 0)


def retrain_trigger(report: DataFrame, alerts: int = RETRAIN_ALERTS) -> DataFrame:
    return report.agg(F.count_if(F.col("status") == "alert").alias("n_alert")).withColumn(
        "retrain", F.col("n_alert") >= alerts
    )
