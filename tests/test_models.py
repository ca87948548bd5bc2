import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyloom.operators import splitting as S
from tallyloom.plans import estimators as E
from tallyloom.plans import training as T
from tallyloom.plans.preprocess import (
    MedianScaler,
    full_pipeline,
    one_hot_stages,
    require_low_cardinality,
    slot_names,
)
from tallyloom.plans.scoring import score_batch
from tallyloom.sources import registry
from tallyloom.spec import TELCO

SIZE = 400


@pytest.fixture(scope="module")
def churners(spark):
    """Accounts whose label follows contract, tenure and some hash noise."""
    i = F.col("id")
    noise = F.pmod(F.xxhash64(i), F.lit(100)) / 100.0
    df = spark.range(SIZE).select(
        F.concat(F.lit("C-"), i).alias("customerID"),
        *[
            F.element_at(
                F.array(*[F.lit(v) for v in TELCO.domains[c]]),
                (F.pmod(F.xxhash64(i, F.lit(c)), F.lit(len(TELCO.domains[c]))) + 1).cast("int"),
            ).alias(c)
            for c in TELCO.categorical
        ],
        F.pmod(i, F.lit(2)).alias("SeniorCitizen"),
        F.pmod(i * 37, F.lit(73)).alias("tenure"),
        (F.pmod(i * 13, F.lit(100)) + 0.5).alias("MonthlyCharges"),
        noise.alias("noise"),
    )
    risk = (
        F.when(F.col("Contract") == "Month-to-month", 0.6).otherwise(0.0)
        + F.when(F.col("tenure") < 24, 0.5).otherwise(0.0)
        + F.col("noise") * 0.4
    )
    total = F.when(F.col("tenure") == 0, " ").otherwise(
        (F.col("tenure") * F.col("MonthlyCharges")).cast("string")
    )
    df = df.withColumns(
        {"TotalCharges": total, "Churn": F.when(risk > 0.75, "Yes").otherwise("No")}
    ).drop("noise")
    df = df.withColumn("label", (F.col("Churn") == "Yes").cast("int"))
    return S.stratified_split(df, "customerID", "Churn").persist()


@pytest.fixture(scope="module")
def final(churners):
    return T.fit_final(
        churners.filter("split = 'train'"),
        churners.filter("split = 'validation'"),
        "TELCO",
        "random_forest",
        {"n_estimators": 15, "max_depth": 6},
    )


def test_scaler_uses_exact_median_and_population_deviation(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0), (None, 5.0)],
                               "x double, k double")
    model = MedianScaler(inputCols=["x", "k"]).fit(df)
    filled = [1.0, 2.0, 3.0, 10.0, 2.5]
    mean = sum(filled) / 5
    std = (sum((v - mean) ** 2 for v in filled) / 5) ** 0.5
    got = [r["x_scaled"] for r in model.transform(df).collect()]
    assert got == pytest.approx([(v - mean) / std for v in filled])
    assert {r["k_scaled"] for r in model.transform(df).collect()} == {0.0}
    path = str(tmp_path / "m")
    PipelineModel(stages=[model]).write().save(path)
    again = [r["x_scaled"] for r in PipelineModel.load(path).transform(df).collect()]
    assert again == got


def test_one_hot_keeps_all_trained_and_zeroes_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    model = Pipeline(stages=one_hot_stages(["c"])).fit(train)
    new = spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "c string")
    rows = model.transform(new).select(vector_to_array("c_slots")).collect()
    assert [r[0] for r in rows] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]
    with pytest.raises(ValueError, match="too many"):
        require_low_cardinality(train, ["c"], 1)


def test_pipeline_output_is_finite_and_named(churners):
    fitted = full_pipeline("TELCO").fit(churners)
    vec = fitted.transform(churners.limit(20)).select(vector_to_array("features").alias("v"))
    names = slot_names(fitted, TELCO)
    for r in vec.collect():
        assert len(r["v"]) == len(names) and all(abs(x) < 1e6 for x in r["v"])


def test_quality_gates(churners, final):
    record = T.evaluate_final(final, churners.filter("split = 'test'"), "TELCO")
    row = record.first()
    assert row["f1"] >= T.GATE_F1 and row["roc_auc"] >= T.GATE_AUC
    base = T.majority_baseline(
        churners.filter("split = 'train'"), churners.filter("split = 'test'")
    ).first()
    gate = T.improvement_gate(record, base["f1"]).first()
    assert gate["passed"] and base["roc_auc"] == 0.5


def test_scoring_is_bounded_repeatable_and_row_wise(churners, final, accounts):
    odd = accounts(
        {},
        {"gender": "Unspecified", "PaymentMethod": "Cryptocurrency"},
        {"tenure": "120", "MonthlyCharges": "999", "TotalCharges": "199000"},
        {"SeniorCitizen": "5"},
        {"MonthlyCharges": "-10"},
        {"tenure": "-1"},
        {"TotalCharges": None, "tenure": "0"},
    )
    one = score_batch(odd, final, "TELCO", "customerID", "v").orderBy("customerID").collect()
    two = score_batch(odd, final, "TELCO", "customerID", "v").orderBy("customerID").collect()
    assert one == two and len(one) == 7
    assert [r["ok"] for r in one] == [True, True, True, False, False, False, True]
    for r in one:
        if r["ok"]:
            assert 0 <= r["churn_probability"] <= 1 and r["prediction"] in ("Yes", "No")
            yes = r["churn_probability"] >= final.threshold
            assert (r["prediction"] == "Yes") == yes
        else:
            assert r["churn_probability"] is None and r["prediction"] is None and r["error"]
    with pytest.raises(ValueError):
        score_batch(odd.limit(0), final, "TELCO", "customerID")
    with pytest.raises(ValueError, match="Contract"):
        score_batch(odd.drop("Contract"), final, "TELCO", "customerID")


def test_registry_round_trip_pin_and_gate(spark, churners, final, tmp_path):
    folder = str(tmp_path / "models")
    test = churners.filter("split = 'test'")
    metrics = T.evaluate_final(final, test, "TELCO").first().asDict(recursive=True)
    parts = {s: churners.filter(F.col("split") == s) for s in ("train", "test", "none")}
    meta = registry.provenance(parts, ["customerID", "Churn"], folds=5, seed=42)
    assert meta["split_sizes"] == {s: df.count() for s, df in parts.items()}
    save = lambda v, *rest: registry.save_model(spark, folder, final, v, list(TELCO.features), *rest)
    save("0.8.0", metrics)
    save("0.9.0", metrics, {k: v for k, v in meta.items() if k != "cv_folds"})
    first = save("1.0.0", metrics, meta)
    weak = {**metrics, "f1": 0.1}
    second = save("1.1.0", weak, meta)
    assert registry.resolve(spark, folder)["path"] == second
    assert registry.resolve(spark, folder, version="1.0.0")["path"] == first
    loaded, row = registry.load_model(spark, folder, path=first)
    assert row["feature_columns"] == list(TELCO.features)
    before = score_batch(test, final, "TELCO", "customerID").orderBy("customerID").collect()
    after = score_batch(test, loaded, "TELCO", "customerID").orderBy("customerID").collect()
    assert before == after
    verdicts = {
        r["version"]: r["passed"]
        for r in registry.regression_gate(registry.versions(spark, folder)).collect()
    }
    assert verdicts == {"0.8.0": False, "0.9.0": False, "1.0.0": True, "1.1.0": False}
    rows = registry.versions(spark, folder)
    for digest, passed in ((meta["data_digest"], 1), ("other", 0)):
        assert registry.regression_gate(rows, digest=digest).filter("passed").count() == passed
    with pytest.raises(registry.NoModelError):
        registry.resolve(spark, folder, version="9")


def result(name, f1):
    return T.Tuned(name, (({}, (f1,)),), 0.0)


@pytest.mark.parametrize(
    "scores, winner",
    [
        ({"random_forest": 0.640, "logreg": 0.633}, "random_forest"),
        ({"random_forest": 0.640, "logreg": 0.6385}, "logreg"),
        # Each step compares with the current winner, not with the first.
        ({"random_forest": 0.640, "hist_gb": 0.6385, "logreg": 0.637}, "logreg"),
        ({"random_forest": 0.640, "lightgbm": 0.637, "hist_gb": 0.6385}, "hist_gb"),
        ({"logreg": 0.6, "hist_gb": 0.6}, "logreg"),
    ],
)
def test_near_tie_rule(scores, winner):
    assert T.select_candidate([result(n, f) for n, f in scores.items()]).name == winner


def test_search_draws_are_seeded_and_in_range():
    draws = E.draw_params("random_forest", 30, 42)
    assert draws == E.draw_params("random_forest", 30, 42)
    assert draws != E.draw_params("random_forest", 30, 43)
    assert all(200 <= d["n_estimators"] <= 700 and d["n_estimators"] % 50 == 0 for d in draws)
    own = E.draw_params("random_forest", 30, 42, {"max_depth": ("int", 2, 5, 1)})
    assert {d["max_depth"] for d in own} == {2, 3, 4, 5} and set(own[0]) == {"random_state", "max_depth"}
    with pytest.raises(ValueError):
        E.draw_params("nope", 1, 1)
    with pytest.raises(ValueError):
        E.build_estimator("nope", {}, E.TrainingFacts(10, 2))


def test_class_weights_of_candidates(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    facts = E.training_facts(df)
    assert facts.negatives_per_positive == 3.0
    balanced = [r[0] for r in df.select(E.row_weight("logreg", facts)).collect()]
    assert balanced == pytest.approx([2.0, 2 / 3, 2 / 3, 2 / 3]) and sum(balanced) == 4
    assert [r[0] for r in df.select(E.row_weight("lightgbm", facts)).collect()] == [3, 1, 1, 1]


def test_comparison_and_out_of_fold(spark, churners):
    prepared = T.prepare(churners.filter("split = 'train'"), "TELCO")
    results = T.compare_candidates(
        prepared, "TELCO", k=2, candidates=("logreg", "hist_gb"), n_trials=1,
        spaces={"hist_gb": {"max_iter": ("choice", 3), "max_leaf_nodes": ("choice", 8)}},
    )
    table = T.comparison_table(spark, results).collect()
    assert {r["candidate"] for r in table} == {"logreg", "hist_gb"}
    assert all(0 <= r["cv_f1"] <= 1 for r in table)
    scores = T.out_of_fold(prepared, "TELCO", "logreg", {"max_iter": 10}, k=2)
    assert scores.count() == prepared.count()
    assert scores.select("customerID").distinct().count() == prepared.count()


def test_importances_sum_to_one(final):
    rows = T.feature_importances(final, "TELCO")
    assert sum(v for _, v in rows) == pytest.approx(1.0)
    assert {c for c, _ in rows} == {*TELCO.model_numeric, *TELCO.model_categorical}


def test_catalogue_searches_the_full_spaces(spark, monkeypatch):
    """Every draw of the full spaces is fitted on every fold; the winner is refitted as drawn."""
    from tallyloom.plans import queries as Q

    fitted = []
    monkeypatch.setattr(T, "fit_final", lambda *a: fitted.append(a[-2:]))
    monkeypatch.setattr(T, "evaluate_final", lambda *a: spark.range(1).select(F.lit(1).alias("confusion")))
    seen = []
    plain = T.fold_counts

    def fold_counts(folded, s, draws, k, rows):
        assert draws == {n: E.draw_params(n, E.TRIALS[n], 42) for n in E.CANDIDATES} and k == 5
        few = {n: trials if n == "logreg" else trials[:1] for n, trials in draws.items()}
        seen.append(few)
        return plain(folded, s, few, k, rows)

    monkeypatch.setattr(T, "fold_counts", fold_counts)
    monkeypatch.setattr(T, "_search_together", together_of(T._search_together, seen))
    rows = Q.cv_candidates(spark, "/root/testdata/sf0.001").collect()
    assert {r.candidate for r in rows} == set(E.CANDIDATES) and all(r.seconds > 0 for r in rows)
    assert len({r.seconds for r in rows}) == 4
    Q.select_model(spark, "/root/testdata/sf0.001")
    name, params = fitted[0]
    assert params in E.draw_params(name, E.TRIALS[name], 42)
    Q._final(spark, "/root/testdata/sf0.001")
    assert fitted[1] == ("random_forest", {})


def together_of(search, seen):
    """The search with only the trials that were fitted in its results."""

    def run(folded, spec_name, draws, k, rows):
        class Few(dict):
            def items(self):
                return seen[-1].items() if seen else super().items()

        return search(folded, spec_name, Few(draws), k, rows)

    return run


def test_candidate_of_the_user(spark, churners):
    from pyspark.ml.classification import NaiveBayes

    E.register_estimator("bayes", lambda p, facts: NaiveBayes(modelType="gaussian"), {"x": ("choice", 1)}, 1)
    try:
        prepared = T.prepare(churners.filter("split = 'train'"), "TELCO")
        found = T.compare_candidates(prepared, "TELCO", k=2, candidates=("bayes", "logreg"), n_trials=1)
        assert [r.name for r in found] == ["bayes", "logreg"] and all(r.cv_f1 > 0.4 for r in found)
        with pytest.raises(ValueError):
            E.register_estimator("logreg", None, {})
    finally:
        for table in (E.ESTIMATORS, E.SEARCH_SPACES, E.TRIALS):
            table.pop("bayes")


def test_search_encodes_each_fold_by_its_own_rows():
    import numpy as np

    from tallyloom.plans import search

    data = {
        "numbers": np.array([[1.0], [3.0], [np.nan], [9.0], [100.0]]),
        "categories": np.array([[0], [1], [0], [2], [3]]),
        "y": np.array([0.0, 1, 0, 1, 1]),
        "fold": np.array([0, 0, 0, 0, 1]),
    }
    ((x, y, held, held_y),) = search.encoded_folds(data, [1])
    filled = np.array([1.0, 3.0, 3.0, 9.0])
    assert x[:, 0] == pytest.approx((filled - filled.mean()) / filled.std())
    assert x[:, 1:].tolist() == [[1, 0, 0], [0, 1, 0], [1, 0, 0], [0, 0, 1]] and y.tolist() == [0, 1, 0, 1]
    assert held[0, 1:].tolist() == [0, 0, 0] and held_y.tolist() == [1.0]
