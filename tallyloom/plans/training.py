"""Cross-validated comparison, selection, final fit and evaluation.

Stateless stages run once before the folds; only what learns from data is refitted per fold.
Rows are hash-partitioned and sorted by id before every tree fit, so that bagging does not
depend on how the input happened to be split.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.metrics import (
    best_threshold,
    confusion_metrics,
    metric_record,
    threshold_sweep,
)
from tallyloom.plans.estimators import (
    CANDIDATES,
    LABEL,
    SIMPLICITY,
    TRIALS,
    WEIGHT,
    build_estimator,
    draw_params,
    row_weight,
    training_facts,
)
from tallyloom.plans.preprocess import (
    encoder_stages,
    full_pipeline,
    require_low_cardinality,
    slot_names,
    spec_by_name,
    stateless_stages,
)
from tallyloom.operators.splitting import kfold
from tallyloom.plans.search import SEARCH_ROWS, SEARCHED, fold_counts
from tallyloom.session import small_table, stored

# Near-tie distance, improvement gate, regression gate.
TIE_EPSILON = 0.002
MIN_IMPROVEMENT = 0.05
GATE_F1, GATE_AUC = 0.52, 0.80
STABLE_BAND = 0.005


@dataclass(frozen=True)
class Tuned:
    """A candidate's trials, each with its parameters and fold scores, and the seconds of its fits."""

    name: str
    trials: tuple[tuple[dict[str, Any], tuple[float, ...]], ...]
    seconds: float

    @property
    def best(self) -> tuple[dict[str, Any], tuple[float, ...]]:
        return max(self.trials, key=lambda t: _mean(t[1]))

    @property
    def cv_f1(self) -> float:
        return _mean(self.best[1])


def placed(df: DataFrame, key: str) -> DataFrame:
    """Fixed row placement for reproducible tree fits."""
    return df.repartition(key).sortWithinPartitions(key)


def prepare(df: DataFrame, spec_name: str) -> DataFrame:
    """Cleaned and engineered rows with id and label."""
    return PipelineModel(stages=stateless_stages(spec_name)).transform(df)


def score_column(df: DataFrame, out: str = "p") -> DataFrame:
    """Positive-class probability as a plain double."""
    return df.withColumn(out, vector_to_array("probability").getItem(1))


def _scored(model, rows: DataFrame, key: str) -> DataFrame:
    return score_column(model.transform(rows)).select(key, LABEL, "p")


def fold_pairs(prepared: DataFrame, spec_name: str, k: int) -> list[tuple[DataFrame, DataFrame]]:
    """Per fold: encoded training and validation rows, encoder fitted on training rows only.

    The encoded rows are reused by every candidate and trial.
    """
    s = spec_by_name(spec_name)
    require_low_cardinality(prepared, s.model_categorical)
    pairs = []
    for i in range(k):
        train, held = prepared.filter(F.col("fold") != i), prepared.filter(F.col("fold") == i)
        encoder = Pipeline(stages=encoder_stages(s)).fit(train)
        keep = [s.id_col, LABEL, "features"]
        pairs.append(
            (
                placed(encoder.transform(train).select(*keep), s.id_col).persist(),
                encoder.transform(held).select(*keep).persist(),
            )
        )
    return pairs


def release(pairs: list[tuple[DataFrame, DataFrame]]) -> None:
    for pair in pairs:
        for df in pair:
            df.unpersist()


def _mean(values: Sequence[float]) -> float:
    return sum(values) / len(values)


def _std(values: Sequence[float]) -> float:
    mean = _mean(values)
    return (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5


def _fold_scores(pair, fold: int, facts, name: str, params: dict[str, Any], key: str) -> DataFrame:
    train, held = pair
    weighted = train.withColumn(WEIGHT, row_weight(name, facts))
    model = build_estimator(name, params, facts).fit(weighted)
    return _scored(model, held, key).withColumn("fold", F.lit(fold))


def _fold_f1(parts: Sequence[DataFrame]) -> tuple[float, ...]:
    """F1 at threshold 0.5 per fold: one evaluation job for all folds of a trial."""
    scored = reduce(DataFrame.unionByName, parts)
    rows = confusion_metrics(scored, LABEL, "p", 0.5, ["fold"]).select("fold", "f1").collect()
    return tuple(r["f1"] for r in sorted(rows, key=lambda r: r["fold"]))


def _search_together(
    folded: DataFrame, spec_name: str, draws: dict[str, list[dict]], k: int, rows: int
) -> list[Tuned]:
    """Candidates of the library's own engine: all trials and folds in one Spark job."""
    counts = fold_counts(folded, spec_by_name(spec_name), draws, k, rows).collect()
    found: dict[tuple[str, int], dict[int, float]] = {}
    seconds = dict.fromkeys(draws, 0.0)
    for r in counts:
        wrong = 2 * r["tp"] + r["fp"] + r["fn"]
        found.setdefault((r["candidate"], r["trial"]), {})[r["fold"]] = 2 * r["tp"] / wrong if wrong else 0.0
        seconds[r["candidate"]] += r["seconds"]
    return [
        Tuned(
            name,
            tuple((params, tuple(found[name, t][i] for i in range(k))) for t, params in enumerate(trials)),
            seconds[name],
        )
        for name, trials in draws.items()
    ]


def _search_registered(
    folded: DataFrame, spec_name: str, draws: dict[str, list[dict]], k: int, parallelism: int
) -> list[Tuned]:
    """Candidates with an MLlib classifier of the user's: one fit after another for each fold."""
    key = spec_by_name(spec_name).id_col
    pairs = fold_pairs(folded, spec_name, k)
    try:
        facts = [training_facts(train) for train, _ in pairs]
        results = []
        with ThreadPoolExecutor(parallelism) as pool:
            for name, trials in draws.items():
                started, own = time.perf_counter(), []
                for params in trials:
                    fits = [pool.submit(_fold_scores, pairs[i], i, facts[i], name, params, key) for i in range(k)]
                    own.append((params, _fold_f1([fit.result() for fit in fits])))
                results.append(Tuned(name, tuple(own), time.perf_counter() - started))
        return results
    finally:
        release(pairs)


def compare_candidates(
    prepared: DataFrame,
    spec_name: str,
    k: int = 5,
    seed: int = 42,
    candidates: Sequence[str] = CANDIDATES,
    n_trials: int | None = None,
    spaces: dict[str, dict[str, tuple]] | None = None,
    parallelism: int = 4,
    rows: int = SEARCH_ROWS,
) -> list[Tuned]:
    """Tune every candidate on the same folds by random search.

    ``spaces`` replaces the search spaces of the candidates it names; draws are used as they are.
    All trials of the library's candidates and all their folds are one Spark job over at most
    ``rows`` labelled rows; candidates that a user registered are fitted by MLlib on all rows.
    ``seconds`` is the time of a candidate's own fits, summed over tasks.
    """
    folded = kfold(prepared, spec_by_name(spec_name).id_col, LABEL, k, seed).persist()
    draws = {n: draw_params(n, n_trials or TRIALS[n], seed, (spaces or {}).get(n)) for n in candidates}
    own = {n: d for n, d in draws.items() if n in SEARCHED}
    other = {n: d for n, d in draws.items() if n not in SEARCHED}
    try:
        found = _search_together(folded, spec_name, own, k, rows) if own else []
        found += _search_registered(folded, spec_name, other, k, parallelism) if other else []
    finally:
        folded.unpersist()
    return sorted(found, key=lambda r: list(candidates).index(r.name))


def comparison_table(spark: SparkSession, results: Sequence[Tuned]) -> DataFrame:
    """One row per candidate, best first: its best trial's mean and spread over the folds, and
    the spread of the trials that come close to it."""
    rows = []
    for r in sorted(results, key=lambda r: -r.cv_f1):
        close = [m for m in (_mean(f) for _, f in r.trials) if m >= r.cv_f1 - STABLE_BAND]
        rows.append((r.name, r.cv_f1, _std(r.best[1]), _std(close), len(r.trials), r.seconds))
    return small_table(
        spark,
        rows,
        "candidate string, cv_f1 double, fold_std double, band_std double, "
        "n_trials int, seconds double",
    )


def _plainness(name: str) -> int:
    """Place in the order of simplicity; candidates that are not listed come last."""
    return SIMPLICITY.index(name) if name in SIMPLICITY else len(SIMPLICITY)


def select_candidate(results: Sequence[Tuned]) -> Tuned:
    """Best CV F1, where a plainer candidate close to the choice so far takes its place."""

    def prefer(chosen: Tuned, other: Tuned) -> Tuned:
        close = chosen.cv_f1 - other.cv_f1 <= TIE_EPSILON
        return other if close and _plainness(other.name) < _plainness(chosen.name) else chosen

    return reduce(prefer, sorted(results, key=lambda r: (-r.cv_f1, _plainness(r.name))))


def out_of_fold(
    prepared: DataFrame, spec_name: str, name: str = "logreg", params: dict | None = None,
    k: int = 5, seed: int = 42,
) -> DataFrame:
    """(id, label, p) where every row is scored by the model that did not see it."""
    s = spec_by_name(spec_name)
    folded = kfold(prepared, s.id_col, LABEL, k, seed).persist()
    out = None
    for i in range(k):
        train = placed(folded.filter(F.col("fold") != i), s.id_col)
        facts = training_facts(train)
        stages = [*encoder_stages(s), build_estimator(name, params or {}, facts)]
        model = Pipeline(stages=stages).fit(train.withColumn(WEIGHT, row_weight(name, facts)))
        part = _scored(model, folded.filter(F.col("fold") == i), s.id_col)
        out = part if out is None else out.unionByName(part)
    scores = stored(out, "out-of-fold")
    folded.unpersist()
    return scores


@dataclass
class FinalModel:
    model: PipelineModel
    name: str
    params: dict[str, Any]
    threshold: float


def fit_final(
    train: DataFrame,
    validation: DataFrame,
    spec_name: str,
    name: str,
    params: dict[str, Any],
) -> FinalModel:
    """Refit on the training split, threshold from the validation split.

    ``train`` and ``validation`` are raw rows with ``label``; the model holds every stage.
    """
    s = spec_by_name(spec_name)
    key = s.id_col
    train = placed(require_low_cardinality(train, s.categorical), key)
    facts = training_facts(train)
    pipeline = full_pipeline(spec_name, build_estimator(name, params, facts))
    model = pipeline.fit(train.withColumn(WEIGHT, row_weight(name, facts)))
    held = _scored(model, validation, key)
    threshold = best_threshold(threshold_sweep(held, LABEL, "p")).first()["threshold"]
    return FinalModel(model, name, params, float(threshold))


def evaluate_final(final: FinalModel, test: DataFrame, spec_name: str) -> DataFrame:
    """The full metric record on the test split, which is scored once and stored."""
    scored = stored(_scored(final.model, test, spec_by_name(spec_name).id_col), "test-scores")
    return metric_record(scored, LABEL, "p", final.threshold)


def feature_importances(final: FinalModel, spec_name: str) -> list[tuple[str, float]]:
    """Tree importances folded back from vector positions to source columns."""
    totals: dict[str, float] = {}
    for (column, _), value in zip(
        slot_names(final.model, spec_by_name(spec_name)),
        final.model.stages[-1].featureImportances.toArray(),
    ):
        totals[column] = totals.get(column, 0.0) + float(value)
    return sorted(totals.items(), key=lambda kv: (-kv[1], kv[0]))


def improvement_gate(
    metrics: DataFrame, majority_f1: float, required: float = MIN_IMPROVEMENT
) -> DataFrame:
    gain = F.col("f1") - F.lit(float(majority_f1))
    return metrics.select(
        "f1",
        F.lit(float(majority_f1)).alias("majority_f1"),
        gain.alias("gain"),
        (gain >= required).alias("passed"),
    )


def majority_baseline(train: DataFrame, evaluated: DataFrame, label: str = LABEL) -> DataFrame:
    """Metrics of always predicting the most frequent training label; AUC is 0.5."""
    from tallyloom.operators.profiling import majority_class

    top = majority_class(train, label).first()
    constant = evaluated.select(
        F.col(label).alias("y"), F.lit(float(top[label])).alias("p")
    )
    return confusion_metrics(constant, "y", "p", 0.5).select(
        F.lit(int(top[label])).alias("majority"),
        "n",
        "precision",
        "recall",
        "f1",
        F.lit(0.5).alias("roc_auc"),
    )
