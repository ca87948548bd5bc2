import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import metrics as M

HAND = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1)]


def scored(spark, pairs):
    return spark.createDataFrame([(i, y, p) for i, (p, y) in enumerate(pairs)],
                                 "id long, y int, p double")


def auc_by_pairs(pairs):
    pos = [p for p, y in pairs if y]
    neg = [p for p, y in pairs if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def test_hand_case_areas(spark):
    ranked = M.ranked_counts(scored(spark, HAND), "y", "p")
    assert M.roc_auc(ranked).first()[0] == 0.75
    assert M.pr_auc(ranked).first()[0] == pytest.approx(0.8472, abs=5e-5)


def test_one_class_has_no_area(spark):
    ranked = M.ranked_counts(scored(spark, [(0.1, 1), (0.9, 1)]), "y", "p")
    assert M.roc_auc(ranked).first()[0] is None
    assert M.pr_auc(ranked).first()[0] is None


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_auc_does_not_depend_on_buckets_and_flips(spark, buckets):
    rng = random.Random(buckets)
    # A third of the rows share one score; negative zero and zero are the same score.
    pairs = [(0.5 if i % 3 == 0 else rng.choice([0.0, -0.0, round(rng.random(), 2)]),
              rng.randint(0, 1)) for i in range(600)]
    df = scored(spark, pairs)
    value = M.roc_auc(M.ranked_counts(df, "y", "p", buckets)).first()[0]
    assert value == pytest.approx(auc_by_pairs(pairs), abs=1e-12)
    flipped = df.withColumn("p", 1.0 - F.col("p"))
    other = M.roc_auc(M.ranked_counts(flipped, "y", "p", buckets)).first()[0]
    assert value + other == pytest.approx(1.0, abs=1e-12)


def test_confusion_is_inclusive_and_zero_safe(spark):
    df = scored(spark, [(0.5, 1), (0.49, 1), (0.2, 0)])
    row = M.confusion_metrics(df, "y", "p", 0.5).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 0, 1, 1)
    none = M.confusion_metrics(df, "y", "p", 0.9).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)


def test_macro_f1_drops_an_absent_class(spark):
    row = M.confusion_metrics(scored(spark, [(0.9, 1), (0.8, 1)]), "y", "p", 0.5).first()
    assert row["f1_macro"] == 1.0


def test_sweep_equals_single_thresholds_and_lowest_wins_ties(spark):
    rng = random.Random(5)
    df = scored(spark, [(rng.randint(0, 100) / 100.0, rng.randint(0, 1)) for _ in range(300)])
    sweep = {round(r["threshold"] * 100): r for r in M.threshold_sweep(df, "y", "p").collect()}
    assert len(sweep) == 81
    for h in (10, 29, 57, 58, 90):
        one = M.confusion_metrics(df, "y", "p", h / 100.0).first()
        assert [sweep[h][c] for c in ("tn", "fp", "fn", "tp")] == [
            one[c] for c in ("tn", "fp", "fn", "tp")
        ]
    flat = M.threshold_sweep(scored(spark, [(0.95, 1), (0.05, 0)]), "y", "p")
    assert M.best_threshold(flat).first()["threshold"] == 0.1


def test_calibration_edge_goes_to_the_lower_bin(spark):
    df = scored(spark, [(i / 10.0, i % 2) for i in range(11)])
    rows = {r["bin"]: r["n"] for r in M.calibration(df, "y", "p").collect()}
    # The first bin holds 0.0 and its upper edge 0.1.
    assert rows[0] == 2 and sum(rows.values()) == 11 and len(rows) == 10


def test_histogram_density_sums_to_one_per_class(spark):
    df = scored(spark, [(i / 97.0, i % 2) for i in range(97)])
    rows = M.score_histogram(df, "y", "p", 40).collect()
    for y in (0, 1):
        ps = [i / 97.0 for i in range(97) if i % 2 == y]
        width = (max(ps) - min(ps)) / 40
        assert sum(r["density"] * width for r in rows if r["y"] == y) == pytest.approx(1.0)
    constant = M.score_histogram(scored(spark, [(0.3, 1)] * 3), "y", "p", 4).collect()
    assert sorted((r["bin"], r["n"]) for r in constant) == [(0, 0), (1, 0), (2, 3), (3, 0)]
    assert len(rows) == 80


def test_fairness_has_null_rates_without_class(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.9), ("a", 1, 0.1), ("b", 0, 0.9), ("b", 1, 0.9)], "g string, y int, p double"
    )
    rows = {r["group"]: r for r in M.fairness_slices(df, ["g"], "y", "p", 0.5).collect()}
    assert rows["a"]["fpr"] is None and rows["a"]["tpr"] == 0.5
    assert rows["b"]["fpr"] == 1.0 and rows["b"]["churn_rate"] == 0.5


def test_feature_screen(spark):
    df = spark.createDataFrame(
        [(i % 2, float(i % 2), None if i % 2 else 1.0, "u" if i % 3 else "v", f"c{i}")
         for i in range(60)],
        "y int, leak double, gap double, two string, many string",
    )
    rows = {r["feature"]: r for r in
            M.single_feature_auc(df, "y", ["leak", "gap"], ["two", "many"]).collect()}
    assert set(rows) == {"leak", "gap", "two"}
    assert rows["leak"]["auc"] == 1.0 and rows["leak"]["flag"] == "investigate"
    assert rows["gap"]["auc"] == 1.0  # a missing number counts as zero
    assert rows["two"]["auc"] == 0.5 and rows["two"]["flag"] == ""


def test_metric_record_agrees_with_parts(spark):
    row = M.metric_record(scored(spark, HAND), "y", "p", 0.4).first()
    assert row["roc_auc"] == 0.75 and row["n_samples"] == 5
    assert row["confusion"].asDict() == {"tn": 1, "fp": 1, "fn": 1, "tp": 2}
    assert row["brier"] == pytest.approx(sum((p - y) ** 2 for p, y in HAND) / 5)
