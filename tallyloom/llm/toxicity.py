"""Toxicity: character n-gram linear classifier on naive Bayes log-count ratios.

The fit takes a bounded sample of labelled rows. Presence of every hashed n-gram is counted per
class; the log ratio of the smoothed presence rates is the feature's value wherever the n-gram
occurs in a text, and a regularised logistic model is fitted to these values. Both classes weigh
alike in the loss. Last, the intercept is moved so that 0.5 is the cut with the fewest errors on
the sample, each class counted as often as all labels have it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.char_grams import CharGrams
from tallyloom.llm.common import doc_text, held_out, lean, sigmoid
from tallyloom.llm.words import distinct, steps
from tallyloom.session import ship_by_value, stored

ship_by_value(__name__)

ORDERS = (5, 7, 8)
BITS = 20
#: Labelled rows of each class that a fit reads at most.
ROWS_PER_CLASS = 8000
#: N-grams that the model keeps, those whose class rates differ most surely.
FEATURES = 3000
#: An n-gram must occur in so many sampled texts.
MIN_TEXTS = 8
RIDGE = 1e-4
#: Bytes of text whose n-grams are in memory at a time.
STEP_BYTES = 1 << 19


@dataclass(frozen=True)
class ToxicityModel:
    """Hash buckets in ascending order, the weight of each one's presence, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float


def _present(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs; with ``wanted`` the places of the buckets in that list."""
    grams = CharGrams(texts)
    table = None
    if wanted is not None:
        table = np.full(1 << BITS, -1, np.int32)
        table[wanted] = np.arange(len(wanted))
    found = []
    for n in ORDERS:
        buckets, rows = grams.buckets(n, BITS)
        if table is not None:
            places = table[buckets]
            hit = np.flatnonzero(places >= 0)
            buckets, rows = places[hit].astype(np.int64), rows[hit]
        found.append(distinct((rows << BITS) | buckets))
    pairs = distinct(np.concatenate(found))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each class hold each bucket, per task."""
    counts = np.zeros((2, 1 << BITS), np.int32)
    for batch in batches:
        for part in steps(batch, limit=STEP_BYTES):
            rows, buckets = _present(part.column("text"))
            label = part.column("label").to_numpy(zero_copy_only=False)[rows]
            np.add.at(counts, (label, buckets), 1)
    seen = np.flatnonzero(counts.any(axis=0)).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(counts[0, seen]), pa.array(counts[1, seen])], ["bucket", "clean", "toxic"]
    )


def _presence_rows(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, limit=STEP_BYTES):
                rows, places = _present(part.column("text"), wanted)
                cuts = np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(places.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("label"), lists], ["label", "places"])

    return run


def _fit_logistic(places: np.ndarray, rows: np.ndarray, values: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Accelerated gradient descent on the class-balanced logistic loss with a ridge penalty."""
    n, k = len(y), len(values)
    x = values[places]
    size = np.bincount(rows, x * x, n)
    share = np.where(y > 0, n / (2 * max(1.0, y.sum())), n / (2 * max(1.0, n - y.sum())))
    step = 0.5 / (0.25 * max(1.0, float(np.percentile(size, 99)) if n else 1.0) + RIDGE)
    w, b = np.zeros(k), 0.0
    wm, bm, momentum = w.copy(), b, 1.0
    for _ in range(250):
        error = share * (sigmoid(np.bincount(rows, x * wm[places], n) + bm) - y)
        w_next = wm - step * (np.bincount(places, x * error[rows], k) / n + RIDGE * wm)
        b_next = bm - step * error.mean()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        wm = w_next + (momentum - 1) / following * (w_next - w)
        bm = b_next + (momentum - 1) / following * (b_next - b)
        w, b, momentum = w_next, b_next, following
    return w, float(b)


def _best_cut(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the range of cuts with the least weighted number of errors."""
    order = np.argsort(logits, kind="stable")
    logits, y, weight = logits[order], y[order], weight[order]
    missed = np.concatenate([[0.0], np.cumsum(weight * y)])  # errors if the first i rows are below
    wrong = np.concatenate([np.cumsum((weight * (1 - y))[::-1])[::-1], [0.0]])
    bounds = np.concatenate([[logits[0] - 1], (logits[1:] + logits[:-1]) / 2, [logits[-1] + 1]])
    errors = np.round(missed + wrong, 6)
    best = np.flatnonzero(errors == errors.min())
    return float((bounds[best[0]] + bounds[best[-1]]) / 2)


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> ToxicityModel:
    """Fit on at most ``rows_per_class`` labelled documents of each class.

    Rows kept out by ``held_out`` are never read, nor are labels other than 0 and 1. An id that is
    labelled more than once counts as toxic if one label says so. The sample is the rows of the
    smallest id hashes, so a fit repeats. Without labels of both classes the model is the class
    rate alone (0.5 without any label).
    """
    truth = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    totals = {r["label"]: r["n"] for r in truth.groupBy("label").agg(F.count("*").alias("n")).collect()}
    none = np.zeros(0, np.int64)
    if len(totals) < 2:
        rate = 0.5 if not totals else (0.99 if 1 in totals else 0.01)
        return ToxicityModel(none, np.zeros(0), float(np.log(rate / (1 - rate))))
    picked = [
        truth.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        for c in (0, 1)
    ]
    # the picked ids are bounded by the parameter, so every executor can hold them
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    sample = stored(doc_text(docs).join(chosen, "doc_id").select("text", "label"), "toxicity-sample")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        rate = totals[1] / (totals[0] + totals[1])
        return ToxicityModel(none, np.zeros(0), float(np.log(rate / (1 - rate))))
    n0, n1 = sizes[0], sizes[1]
    counts = (
        sample.mapInArrow(lean(_class_counts), "bucket int, clean int, toxic int")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    share = (F.col("clean") + F.col("toxic")) / F.lit(float(n0 + n1))
    surely = F.abs(F.col("toxic") / n1 - F.col("clean") / n0) / F.sqrt(share * (1.001 - share))
    top = (
        counts.filter(F.col("clean") + F.col("toxic") >= min(MIN_TEXTS, 1 + (n0 + n1) // 50))
        .orderBy(surely.desc(), "bucket")
        .limit(FEATURES)
        .collect()
    )
    top.sort(key=lambda r: r["bucket"])
    buckets = np.array([r["bucket"] for r in top], np.int64)
    p = (np.array([r["toxic"] for r in top], float) + 1) / (n1 + 2)
    q = (np.array([r["clean"] for r in top], float) + 1) / (n0 + 2)
    ratios = np.log(p / q)
    # bounded: a row for each sampled text, of at most FEATURES places
    rows = sample.mapInArrow(lean(_presence_rows(buckets)), "label int, places array<int>").toArrow()
    lists = rows.column("places").combine_chunks()
    places = lists.flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    y = rows.column("label").to_numpy().astype(float)
    w, b = _fit_logistic(places, owner, ratios, y)
    logits = np.bincount(owner, (w * ratios)[places], len(y)) + b
    b -= _best_cut(logits, y, np.where(y > 0, totals[1] / n1, totals[0] / n0))
    return ToxicityModel(buckets, w * ratios, b)


def _scorer(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, limit=STEP_BYTES):
                rows, places = _present(part.column("text"), model.buckets)
                sums = np.bincount(rows, model.weights[places], part.num_rows)
                score = sigmoid(sums[: part.num_rows] + model.intercept)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return run


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per document: ``doc_id`` and ``score`` from 0 to 1, null and empty texts included.

    The text alone decides, so repeated texts score alike. Nothing is shuffled. A null id stays
    null, other columns are ignored, and an empty table gives no rows.
    """
    return doc_text(docs).mapInArrow(lean(_scorer(model)), "doc_id long, score double")


def keep_clean(docs: DataFrame, model: ToxicityModel, cut: float = 0.5) -> DataFrame:
    """The rows whose text scores below ``cut``, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, limit=STEP_BYTES):
                rows, places = _present(part.column("text"), model.buckets)
                sums = np.bincount(rows, model.weights[places], part.num_rows)
                yield part.filter(pa.array(sigmoid(sums[: part.num_rows] + model.intercept) < cut))

    return docs.mapInArrow(lean(run), docs.schema)
