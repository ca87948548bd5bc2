"""Candidate classifiers by name, with their search spaces.

Defaults of parameters that a draw leaves out are fixed values; those of trees are in ``trees``.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass
from typing import Any

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.trees import TreeEnsemble

FEATURES, LABEL, WEIGHT = "features", "label", "weight"


# Search ranges per candidate (kind, low, high[, step]) or choices, trials.
SEARCH_SPACES: dict[str, dict[str, tuple]] = {
    "logreg": {"C": ("log", 1e-3, 1e2), "max_iter": ("choice", 2000)},
    "random_forest": {
        "n_estimators": ("int", 200, 700, 50),
        "max_depth": ("choice", None, 8, 12, 16, 24),
        "min_samples_leaf": ("int", 1, 20, 1),
        "max_features": ("choice", "sqrt", "log2", 0.5),
    },
    "hist_gb": {
        "learning_rate": ("log", 0.01, 0.3),
        "max_iter": ("int", 200, 700, 50),
        "max_leaf_nodes": ("int", 15, 127, 1),
        "min_samples_leaf": ("int", 5, 60, 1),
        "l2_regularization": ("log", 1e-8, 10.0),
    },
    "lightgbm": {
        "n_estimators": ("int", 200, 800, 50),
        "learning_rate": ("log", 0.01, 0.3),
        "num_leaves": ("int", 15, 127, 1),
        "max_depth": ("int", 3, 12, 1),
        "min_child_samples": ("int", 5, 60, 1),
        "subsample": ("float", 0.6, 1.0),
        "colsample_bytree": ("float", 0.6, 1.0),
        "reg_alpha": ("log", 1e-8, 10.0),
        "reg_lambda": ("log", 1e-8, 10.0),
    },
}
TRIALS = {"lightgbm": 30, "hist_gb": 25, "random_forest": 20, "logreg": 12}
CANDIDATES = ("lightgbm", "hist_gb", "random_forest", "logreg")
# Simpler first; decides near-ties.
SIMPLICITY = ("logreg", "hist_gb", "lightgbm", "random_forest")


@dataclass(frozen=True)
class TrainingFacts:
    """Numbers of the training set that some candidates need."""

    n_rows: int
    n_positive: int

    @property
    def negatives_per_positive(self) -> float:
        return (self.n_rows - self.n_positive) / max(self.n_positive, 1)


def training_facts(df: DataFrame, label: str = LABEL) -> TrainingFacts:
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(label), F.lit(0)).alias("p")
    ).first()
    return TrainingFacts(int(row["n"]), int(row["p"]))


def balanced_weight(facts: TrainingFacts, label: str = LABEL) -> Column:
    """n / (2 n_class) per row."""
    pos, neg = max(facts.n_positive, 1), max(facts.n_rows - facts.n_positive, 1)
    return F.when(F.col(label) == 1, facts.n_rows / (2.0 * pos)).otherwise(
        facts.n_rows / (2.0 * neg)
    )


def positive_weight(facts: TrainingFacts, label: str = LABEL) -> Column:
    """Negatives per positive on positives, 1 on negatives."""
    return F.when(F.col(label) == 1, facts.negatives_per_positive).otherwise(1.0)


def row_weight(name: str, facts: TrainingFacts, label: str = LABEL) -> Column:
    return (positive_weight if name == "lightgbm" else balanced_weight)(facts, label)


def _logreg(p: dict[str, Any], facts: TrainingFacts):
    # Same objective as inverse strength C: the balanced weights sum to n.
    return LogisticRegression(
        regParam=1.0 / (float(p.get("C", 1.0)) * max(facts.n_rows, 1)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=int(p.get("max_iter", 2000)),
    )


def _trees(name: str):
    return lambda p, facts: TreeEnsemble(name, p)


ESTIMATORS = {
    "logreg": _logreg,
    "random_forest": _trees("random_forest"),
    "hist_gb": _trees("hist_gb"),
    "lightgbm": _trees("lightgbm"),
}


def register_estimator(name: str, build, space: dict[str, tuple], trials: int = 20) -> None:
    """Add a candidate: ``build(params, facts)`` gives a classifier like those of MLlib."""
    if name in CANDIDATES:
        raise ValueError(f"{name} is a candidate of the library")
    ESTIMATORS[name] = build
    SEARCH_SPACES[name] = space
    TRIALS[name] = trials


def build_estimator(name: str, params: dict[str, Any], facts: TrainingFacts):
    """Candidate with its columns set; an unknown name is an error."""
    if name not in ESTIMATORS:
        raise ValueError(f"unknown estimator: {name}")
    est = ESTIMATORS[name](params, facts)
    return est.setFeaturesCol(FEATURES).setLabelCol(LABEL).setWeightCol(WEIGHT)


def draw_params(
    name: str, n: int, seed: int, space: dict[str, tuple] | None = None
) -> list[dict[str, Any]]:
    """Seeded random draws from a search space, by default the candidate's own, used unchanged."""
    space = SEARCH_SPACES.get(name) if space is None else space
    if space is None:
        raise ValueError(f"no search space for {name}")
    rng = random.Random(f"{seed}:{name}")
    draws = []
    for _ in range(n):
        one: dict[str, Any] = {"random_state": seed}
        for key, (kind, *args) in space.items():
            if kind == "choice":
                one[key] = rng.choice(args)
            elif kind == "int":
                one[key] = rng.randrange(args[0], args[1] + 1, args[2])
            elif kind == "log":
                one[key] = math.exp(rng.uniform(math.log(args[0]), math.log(args[1])))
            else:
                one[key] = rng.uniform(*args)
        draws.append(one)
    return draws
