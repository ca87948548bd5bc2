import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import drift as D
from tallyloom.operators import profiling as P
from tallyloom.spec import TELCO


def psi_plain(expected, actual):
    e, a = np.maximum(expected, 1e-6), np.maximum(actual, 1e-6)
    e, a = e / e.sum(), a / a.sum()
    return float(np.sum((a - e) * np.log(a / e)))


def test_facts_and_balance(accounts):
    df = accounts({"tenure": "0", "TotalCharges": " "}, {}, {"Churn": "Yes", "gender": None})
    facts = P.table_facts(df, TELCO).first()
    assert (facts["n_rows"], facts["n_columns"], facts["n_blank_total"], facts["n_zero_tenure"]) == (
        3, 21, 1, 1)
    balance = P.class_balance(df, "Churn", "Yes").first()
    assert (balance["n_positive"], balance["n_negative"], balance["imbalance_ratio"]) == (1, 2, 2.0)
    assert [(r[0], r[1]) for r in P.null_profile(df).collect()] == [("gender", 1)]
    none = P.class_balance(df.filter("Churn = 'No'"), "Churn", "Yes").first()
    assert none["imbalance_ratio"] == 2.0 and none["positive_rate"] == 0.0


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "a")], "k int, t string")
    assert P.duplicate_row_count(df).first()["n_duplicates"] == 1
    assert P.duplicate_key_count(df, "k").first()["n_duplicates"] == 2
    assert P.duplicate_text_count(df, "t").first()["n_duplicates"] == 2


def test_cardinality_ignores_nulls_and_majority_breaks_ties(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), ("a", "y"), ("b", "y")],
                               "p string, q string")
    exact = {r["column"]: r["n_distinct"] for r in P.cardinality(df, ["p", "q"]).collect()}
    rough = {r["column"]: r["n_distinct"] for r in P.cardinality(df, ["p", "q"], True).collect()}
    assert exact == rough == {"p": 2, "q": 2}
    assert P.majority_class(df, "p").first()["p"] == "a"


def test_five_numbers_and_outliers(spark):
    df = spark.createDataFrame([("a", float(x)) for x in [1, 2, 3, 4, 100]] + [("b", 1.0)],
                               "g string, x double")
    rows = {r["group"]: r for r in P.five_numbers(df, ["x"], "g").collect()}
    assert (rows["a"]["min"], rows["a"]["q1"], rows["a"]["median"], rows["a"]["q3"]) == (1, 2, 3, 4)
    assert rows["a"]["n_outliers"] == 1 and rows["b"]["n_outliers"] == 0


def test_top_rates_and_correlation(spark):
    df = spark.createDataFrame(
        [("a", "Yes", 1.0, 2.0), ("b", "Yes", 2.0, 4.0), ("c", "No", 3.0, None)],
        "s string, y string, u double, v double",
    )
    top = P.top_rates(P.rate_by_columns(df, ["s"], "y", "Yes")).orderBy("rank").collect()
    assert [r["value"] for r in top] == ["a", "b"]
    assert P.correlation_pairs(df, ["u", "v"]).first()["r"] == pytest.approx(1.0)
    red = P.redundancy(df, F.col("v"), F.col("u"), F.lit(2.0)).first()
    assert (red["n"], red["mean_relative_gap"]) == (2, 0.0)


def numbers(spark, values):
    return spark.createDataFrame([(None if v is None else float(v), "a") for v in values],
                                 "x double, c string")


def test_reference_bins_match_histogram(spark):
    values = [0, 0, 0, 1, 2, 3, 5, 8, 13, 21, 34, 34]
    edges = np.unique(np.quantile(values, np.linspace(0, 1, 11)))
    counts, _ = np.histogram(values, bins=edges)
    ref = D.fit_reference(numbers(spark, values), ["x"], [], compat=True)
    rows = sorted(ref.collect(), key=lambda r: r["bin"])
    assert [r["lo"] for r in rows] + [rows[-1]["hi"]] == pytest.approx(list(edges))
    assert [r["expected"] for r in rows] == pytest.approx(list(counts / counts.sum()))
    assert D.reference_edges(ref)["x"] == pytest.approx(list(edges))


def test_identical_data_has_no_drift(spark):
    df = numbers(spark, range(100))
    report = D.drift_report(D.fit_reference(df, ["x"], ["c"]), df).collect()
    # The pool of unknown categories is floored in counts, hence not exactly zero.
    assert {(r["feature"], r["status"]) for r in report} == {("x", "ok"), ("c", "ok")}
    assert all(r["psi"] == pytest.approx(0.0, abs=1e-4) for r in report)


def test_numeric_psi_drops_out_of_range_values(spark):
    ref = D.fit_reference(numbers(spark, range(101)), ["x"], [])
    new = [-5, 100, 101, 1000] + [3] * 20 + [55] * 10 + [None, float("nan")]
    edges = np.array(D.reference_edges(ref)["x"])
    finite = [v for v in new if v is not None and not math.isnan(v)]
    counts, _ = np.histogram(finite, bins=edges)
    expected = np.histogram(range(101), bins=edges)[0] / 101
    row = D.psi_numeric(ref, numbers(spark, new)).first()
    assert row["psi"] == pytest.approx(psi_plain(expected, counts / counts.sum()))
    assert row["n_out_of_range"] == 3


def test_all_out_of_range_acts_as_uniform(spark):
    ref = D.fit_reference(numbers(spark, range(100)), ["x"], [])
    row = D.psi_numeric(ref, numbers(spark, [-1.0, 500.0])).first()
    assert row["n_out_of_range"] == 2
    assert row["psi"] == pytest.approx(psi_plain(np.full(10, 0.1), np.full(10, 0.1)), abs=1e-6)


def test_feature_without_values_is_left_out(spark):
    ref = D.fit_reference(numbers(spark, range(100)), ["x"], [])
    assert D.psi_numeric(ref, numbers(spark, [None, None])).count() == 0


def test_constant_and_binary_features(spark):
    constant = numbers(spark, [7] * 5)
    with pytest.raises(ValueError):
        D.fit_reference(constant, ["x"], [], compat=True)
    binary = numbers(spark, [0, 0, 1] * 7)
    compat = D.fit_reference(binary, ["x"], [], compat=True)
    assert D.psi_numeric(compat, numbers(spark, [1] * 10)).first()["psi"] == pytest.approx(0.0)
    better = D.fit_reference(binary, ["x"], [])
    row = D.drift_report(better, numbers(spark, [1] * 10)).first()
    assert (row["kind"], row["status"]) == ("categorical", "alert")


def test_categorical_psi_floors_counts_and_pools_unknown(spark):
    ref_rows = ["a"] * 6 + ["b"] * 3 + [None]
    new_rows = ["a"] * 2 + ["z"] * 3 + ["y"]
    make = lambda rows: spark.createDataFrame([(r,) for r in rows], "c string")
    ref = D.fit_reference(make(ref_rows), [], ["c"])
    value = D.psi_categorical(ref, make(new_rows)).first()["psi"]
    # Order: a, b, missing, pool.
    assert value == pytest.approx(psi_plain(np.array([0.6, 0.3, 0.1, 0.0]), np.array([2.0, 0, 0, 4])))


def test_status_bounds_and_triggers(spark):
    df = spark.createDataFrame(
        [("a", 0.0999), ("b", 0.10), ("c", 0.1999), ("d", 0.2), ("e", 0.3), ("f", 9.0)],
        "feature string, psi double",
    ).withColumn("status", D.status_of(F.col("psi")))
    assert [r["status"] for r in df.orderBy("feature").collect()] == [
        "ok", "warning", "warning", "alert", "alert", "alert"]
    assert D.retrain_trigger(df).first()["retrain"]
    assert not D.retrain_trigger(df.filter("feature > 'd'")).first()["retrain"]
    summary = D.drift_summary(df).first()
    assert (summary["worst_psi"], summary["n_alert"], summary["has_alert"]) == (9.0, 3, True)
    assert [r["feature"] for r in D.top_features(df, 2).collect()] == ["f", "e"]


def test_too_few_records_give_no_report(spark):
    ref = D.fit_reference(numbers(spark, range(100)), ["x"], [])
    assert D.report_if_enough(ref, numbers(spark, range(49))) is None
    assert D.report_if_enough(ref, numbers(spark, range(50))).count() == 1
