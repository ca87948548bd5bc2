"""Tree ensembles against a plain booster that tries every split of every leaf."""

import math

import numpy as np
import pytest

from tallyloom.plans import search as S
from tallyloom.plans import trees as T


def sample(n=160, seed=0):
    rng = np.random.default_rng(seed)
    numbers = np.column_stack([rng.normal(size=n), rng.integers(0, 9, n), rng.normal(size=n).round(1)])
    slots = np.eye(4)[rng.integers(0, 4, n)][:, :3]  # the fourth category has no slot
    flag = rng.integers(0, 2, n)[:, None]
    x = np.column_stack([numbers, slots, flag, np.ones(n)])
    y = (numbers[:, 0] + slots[:, 1] + rng.normal(size=n) * 0.7 > 0.4).astype(float)
    return x, y, np.where(y == 1, 1.7, 0.8)


def plain_boost(x, y, w, limits, rounds, rate):
    n, soft = len(x), lambda g: math.copysign(max(abs(g) - limits.l1, 0.0), g)
    mean = sum(w * y) / sum(w)
    raw = [math.log(mean / (1 - mean))] * n

    def best(rows, g, h, depth):
        score = lambda part: soft(sum(g[i] for i in part)) ** 2 / (sum(h[i] for i in part) + limits.l2)
        found = (0.0, None, None)
        if limits.depth is not None and depth >= limits.depth:
            return found
        for f in range(x.shape[1]):
            values = sorted({x[i, f] for i in range(n)})
            for a, b in zip(values, values[1:]):
                low = [i for i in rows if x[i, f] <= (a + b) / 2]
                high = [i for i in rows if x[i, f] > (a + b) / 2]
                if min(len(low), len(high)) < limits.rows:
                    continue
                if min(sum(h[i] for i in low), sum(h[i] for i in high)) < limits.curvature:
                    continue
                gain = score(low) + score(high) - score(rows)
                if gain > found[0] + 1e-9:
                    found = (gain, low, high)
        return found

    for _ in range(rounds):
        p = [1 / (1 + math.exp(-r)) for r in raw]
        g, h = [w[i] * (p[i] - y[i]) for i in range(n)], [w[i] * p[i] * (1 - p[i]) for i in range(n)]
        leaves = [(list(range(n)), 0, best(range(n), g, h, 0))]
        while len(leaves) < limits.leaves:
            at = max(range(len(leaves)), key=lambda i: leaves[i][2][0])
            rows, depth, (gain, low, high) = leaves[at]
            if gain <= 1e-12:
                break
            leaves[at : at + 1] = [(part, depth + 1, best(part, g, h, depth + 1)) for part in (low, high)]
        for rows, *_ in leaves:
            value = -soft(sum(g[i] for i in rows)) / (sum(h[i] for i in rows) + limits.l2)
            for i in rows:
                raw[i] += rate * value
    return [1 / (1 + math.exp(-r)) for r in raw]


@pytest.mark.parametrize(
    "limits",
    [
        T.Limits(6, None, 5, 0.0, 0.3, 1e-3),
        T.Limits(30, 3, 4, 0.4, 2.0, 1e-3),
        T.Limits(2, None, 1, 0.0, 0.0, 1e-3),
        T.Limits(25, None, 2, 0.0, 1.0, 0.5),
    ],
)
def test_boosting_equals_the_plain_booster(limits):
    x, y, w = sample()
    assert T.boost(x, y, w, limits, 6, 0.3).predict(x) == pytest.approx(plain_boost(x, y, w, limits, 6, 0.3))


def test_side_by_side_equals_alone():
    one, two = sample(150, 1), sample(90, 2)
    problems = [(*one, two[0]), (*two, one[0])]
    for name in ("hist_gb", "lightgbm"):
        params = {"max_iter": 8, "n_estimators": 8, "subsample": 0.7, "min_samples_leaf": 4, "min_child_samples": 4}
        both = T.FITS[name](params)(problems)
        for (model, scored), problem in zip(both, problems):
            assert model.predict(problem[3]) == pytest.approx(scored)
            ((alone, _),) = T.FITS[name](params)([problem])
            assert alone.predict(problem[0]) == pytest.approx(model.predict(problem[0]))


PARAMS = {
    "hist_gb": {
        "learning_rate": 0.02, "max_iter": 30, "max_leaf_nodes": 3, "min_samples_leaf": 30, "l2_regularization": 9.0,
    },
    "lightgbm": {
        "n_estimators": 30, "learning_rate": 0.2, "num_leaves": 3, "max_depth": 2, "min_child_samples": 30,
        "subsample": 0.6, "colsample_bytree": 0.4, "reg_alpha": 5.0, "reg_lambda": 9.0, "random_state": None,
    },
    "random_forest": {
        "n_estimators": 3, "max_depth": 2, "min_samples_leaf": 20, "max_features": 0.5, "random_state": 7,
    },
}


@pytest.mark.parametrize("name, key", [(n, k) for n, ps in PARAMS.items() for k in ps if ps[k] is not None])
def test_every_parameter_changes_the_model(name, key):
    x, y, w = sample(300, 3)
    base = {"max_iter": 12, "n_estimators": 12, "min_samples_leaf": 3, "min_child_samples": 3}
    plain, changed = (T.FITS[name](p)([(x, y, w, x)])[0][1] for p in (base, {**base, key: PARAMS[name][key]}))
    again = T.FITS[name](base)([(x, y, w, x)])[0][1]
    assert np.array_equal(plain, again) and not np.allclose(plain, changed)


def test_forest_without_draws_of_features_is_a_mean_of_gini_trees():
    x, y, w = sample(200, 4)
    model, p = T.forest(x, y, w, 40, None, 1, 1.0, 5, x)
    assert ((p >= 0.5) == (y == 1)).mean() > 0.97 and p.min() >= 0 and p.max() <= 1
    assert model.importances(x.shape[1]).sum() == pytest.approx(1.0)
    again = T.Ensemble.loads(model.dumps())
    assert np.array_equal(again.predict(x), model.predict(x)) and p == pytest.approx(model.predict(x))


def test_constant_features_and_one_class():
    x = np.ones((20, 2))
    for y in (np.zeros(20), np.ones(20)):
        for name in T.FITS:
            ((_, p),) = T.FITS[name]({"n_estimators": 3, "max_iter": 3})([(x, y, np.ones(20), x)])
            assert p == pytest.approx(y, abs=1e-6)


def test_logistic_is_the_stationary_point():
    x, y, w = sample(200, 5)
    x = x[:, :7]
    beta = S.logistic(x, y, w, 2.0, 2000)
    p = 1 / (1 + np.exp(-(x @ beta[:-1] + beta[-1])))
    slope = np.append(x.T @ (w * (p - y)) + beta[:-1] / 2.0, (w * (p - y)).sum())
    assert np.abs(slope).max() < 1e-6


def test_estimator_on_spark_equals_the_fit_and_ignores_the_layout(spark, tmp_path):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.sql import functions as F

    x, y, w = sample(120, 6)
    rows = [(row.tolist(), float(a), float(b)) for row, a, b in zip(x, y, w)]
    df = spark.createDataFrame(rows, "x array<double>, label double, weight double")
    df = df.withColumn("features", array_to_vector("x"))
    scores = []
    for parts in (1, 5):
        model = T.TreeEnsemble("hist_gb", {"max_iter": 10}).fit(df.repartition(parts))
        got = model.transform(df).select("x", vector_to_array("probability")[1].alias("p")).collect()
        scores.append({tuple(r.x): r.p for r in got})
    want = T.FITS["hist_gb"]({"max_iter": 10})([(x, y, w, x)])[0][1]
    assert scores[0] == scores[1] and [scores[0][tuple(r)] for r in x.tolist()] == pytest.approx(want.tolist())
    model.write().save(str(tmp_path / "m"))
    again = T.TreeEnsembleModel.load(str(tmp_path / "m")).transform(df).select(F.sum(vector_to_array("probability")[1]))
    assert again.first()[0] == pytest.approx(want.sum())
    few = T.TreeEnsemble("hist_gb", {"max_iter": 3}, max_rows=40).fit(df)
    assert few.transform(df.limit(0)).count() == 0
