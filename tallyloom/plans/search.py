"""Cross-validated search: every (candidate, trial) with its folds is a task of one Spark job.

The labelled rows that the search works on are bounded (``SEARCH_ROWS``, taken by a hash of the id
where there are more), so they are sent to every executor once, as plain columns. Tasks
impute, scale and encode a fold by its own training rows alone, then fit and count what the
threshold 0.5 gives on the rows left out. Only those counts come back.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.trees import FITS
from tallyloom.spec import TabularSpec

#: Labelled rows of a search at most.
SEARCH_ROWS = 5_000
COUNTS = "candidate string, trial int, fold int, tp long, fp long, fn long, seconds double"


def weights(name: str, y: np.ndarray) -> np.ndarray:
    """Class weights of a candidate: negatives per positive on positives, or balanced classes."""
    n, positive = len(y), max(int(y.sum()), 1)
    negative = max(n - int(y.sum()), 1)
    if name == "lightgbm":
        return np.where(y == 1, (n - int(y.sum())) / positive, 1.0)
    return np.where(y == 1, n / (2.0 * positive), n / (2.0 * negative))


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, strength: float, steps: int) -> np.ndarray:
    """Weights and intercept of least weighted log loss plus squares over twice the strength."""
    one = np.column_stack([x, np.ones(len(x))])
    penalty = np.append(np.full(x.shape[1], 1.0 / strength), 0.0)
    beta = np.zeros(one.shape[1])

    def loss(b: np.ndarray) -> float:
        z = one @ b
        return float((w * (np.logaddexp(0.0, z) - y * z)).sum() + (penalty * b * b).sum() / 2)

    now = loss(beta)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(one @ beta, -500, 500)))
        slope = one.T @ (w * (p - y)) + penalty * beta
        bend = (one * (w * p * (1 - p))[:, None]).T @ one + np.diag(penalty)
        move = np.linalg.lstsq(bend, slope, rcond=None)[0]
        size = 1.0
        while size > 1e-8 and loss(beta - size * move) > now:
            size /= 2
        after = loss(beta - size * move)
        if not after < now:
            break
        beta, now = beta - size * move, after
        if np.abs(size * move).max() < 1e-9:
            break
    return beta


def logreg_fit(p: dict[str, Any]) -> Callable:
    def fit(problems: list[tuple]) -> list[tuple]:
        out = []
        for x, y, w, also in problems:
            beta = logistic(x, y, w, float(p.get("C", 1.0)), int(p.get("max_iter", 2000)))
            z = also @ beta[:-1] + beta[-1]
            out.append((beta, 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))))
        return out

    return fit


SEARCHED = {**FITS, "logreg": logreg_fit}


def encoded_folds(data: dict, folds: Sequence[int]) -> list[tuple]:
    """Per fold: training matrix and labels, matrix and labels of the rows left out.

    Median for missing numbers, then mean 0 and deviation 1, one slot for each category, all
    learned from the fold's training rows; a category they lack gives no slot. The matrices have
    the same columns: a slot that only other folds know stays empty.
    """
    trains = [data["fold"] != k for k in folds]
    known = [sorted({c for t in trains for c in np.unique(codes[t]).tolist()} - {-1}) for codes in data["categories"].T]
    out = []
    for train in trains:
        numbers = data["numbers"]
        present = [c[train & ~np.isnan(c)] for c in numbers.T]
        middle = np.array([np.median(c) if len(c) else 0.0 for c in present])
        filled = np.where(np.isnan(numbers), middle, numbers)
        mean, spread = filled[train].mean(axis=0), filled[train].std(axis=0)
        parts = [(filled - mean) / np.where(spread > 0, spread, 1.0)]
        for codes, slots in zip(data["categories"].T, known):
            own = np.isin(slots, codes[train])
            parts.append(((codes[:, None] == np.array(slots, np.int32)[None, :]) & own).astype(float))
        x = np.concatenate(parts, axis=1)
        out.append((x[train], data["y"][train], x[~train], data["y"][~train]))
    return out


def bounded_rows(folded: DataFrame, s: TabularSpec, most: int = SEARCH_ROWS) -> dict:
    """The rows of a search as arrays: numbers, category codes, label and fold."""
    numbers, categories = list(s.model_numeric), list(s.model_categorical)
    narrow = folded.select(
        F.xxhash64(F.col(s.id_col).cast("string")).alias("h"),
        *[F.col(c).cast("double").alias(c) for c in numbers],
        *[F.col(c).cast("string").alias(c) for c in categories],
        F.col("label").cast("double").alias("label"),
        F.col("fold").cast("int").alias("fold"),
    )
    frame = narrow.orderBy("h").limit(most).toPandas()
    codes = [pd.factorize(frame[c], sort=True)[0] for c in categories]
    return {
        "numbers": frame[numbers].to_numpy(float),
        "categories": np.array(codes, np.int32).T.reshape(len(frame), len(categories)),
        "y": frame["label"].to_numpy(float),
        "fold": frame["fold"].to_numpy(int),
    }


def _effort(work: tuple) -> float:
    """Roughly how long a task takes, so that long ones start first."""
    name, _, p, folds = work
    rounds = p.get("n_estimators") or p.get("max_iter") or 400
    leaves = p.get("num_leaves") or p.get("max_leaf_nodes") or 100
    return 0.0 if name == "logreg" else float(rounds) * leaves * len(folds)


def fold_counts(
    folded: DataFrame, s: TabularSpec, draws: dict[str, list[dict]], k: int, most: int = SEARCH_ROWS
) -> DataFrame:
    """Per candidate, trial and fold: hits and misses at threshold 0.5 and the seconds of the fit.

    ``folded`` has the model's columns, ``label`` and ``fold`` from 0 to ``k - 1``; ``draws`` the
    parameters of each candidate's trials. Boosting fits its folds side by side in one task,
    a forest takes a task for each fold.
    """
    spark = folded.sparkSession
    data = spark.sparkContext.broadcast(bounded_rows(folded, s, most))
    work = []
    for name, trials in draws.items():
        for trial, params in enumerate(trials):
            apart = [[f] for f in range(k)] if name == "random_forest" else [list(range(k))]
            work += [(name, trial, params, folds) for folds in apart]
    work.sort(key=_effort, reverse=True)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in frame["id"]:
                name, trial, params, folds = work[i]
                begun = time.perf_counter()
                rows = encoded_folds(data.value, folds)
                problems = [(x, y, weights(name, y), held) for x, y, held, _ in rows]
                out = []
                for fold, (_, p), (*_, y) in zip(folds, SEARCHED[name](params)(problems), rows):
                    yes = p >= 0.5
                    hits = (int((yes & (y == 1)).sum()), int((yes & (y == 0)).sum()), int((~yes & (y == 1)).sum()))
                    out.append((name, trial, fold, *hits))
                took = (time.perf_counter() - begun) / max(len(folds), 1)
                yield pd.DataFrame(
                    [(*row, took) for row in out], columns=["candidate", "trial", "fold", "tp", "fp", "fn", "seconds"]
                )

    return spark.range(0, len(work), 1, max(len(work), 1)).mapInPandas(run, COUNTS)
