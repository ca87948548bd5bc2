"""Quality classifier by learning from positives and unlabelled text.

Trusted positives are documents labelled good; every document is an unlabelled example. A first
linear model tells positives from unlabelled text. Its score gives the class prior: among texts
over a score, the share of all texts divided by the share of positives is the prior plus what bad
texts reach that score, so the smallest value of that ratio, with a margin for its uncertainty, is
taken. The classifier then minimises the non-negative unbiased risk: with the prior ``c``,

    c E_pos[loss(f)] + max(0, E_all[loss(-f)] - c E_pos[loss(-f)])

with the logistic loss and a small ridge. While the second part is positive the risk is convex and
a Newton step is taken; where it is negative, the step goes against that part, as it is then
over-fitted. Every step is one pass over a stored table of features and sums one matrix per task,
in two levels, so that the driver gets about the square root of the number of partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import doc_text, held_out, partitions, sigmoid
from tallyloom.llm.words import Words, blank_separated, gram_places, grams, steps, text_bytes
from tallyloom.session import ship_by_value, stored

ship_by_value(__name__)

#: Kinds of bytes: everything else, capitals, digits, blanks, line ends, stops, marks, symbols, bars, non-ASCII.
KINDS = ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r\v\f", ".,;:'\"-()", "!?", "#*$%&", "|<>~^_`@\\/{}[]+=")
_K = len(KINDS) + 1
EXTRA = 12
FEATURES = _K * _K + EXTRA
NEWTON_STEPS = 8
RIDGE = 1e-3
#: Share of positives above a score that is needed to read the prior there.
CONFIDENCE = 0.05


def _kind_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for k, letters in enumerate(KINDS):
        table[[ord(c) for c in letters]] = k
    table[0x80:] = _K - 1
    return table


def _repeat_share(owner: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    """Share of each row's hashes that are equal to another one of the row."""
    order = np.argsort(hashes)
    order = order[np.argsort(owner[order].astype(np.uint16 if rows < 65536 else np.int64), kind="stable")]
    h, o = hashes[order], owner[order]
    same = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
    again = np.zeros(len(h), bool)
    again[1:] |= same
    again[:-1] |= same
    return np.bincount(o[again], minlength=rows) / np.maximum(1, np.bincount(o, minlength=rows))


def text_features(texts: pa.Array) -> np.ndarray:
    """One line of ``FEATURES`` numbers for each text."""
    raw, ends = text_bytes(texts)
    rows = len(ends)
    sizes = np.diff(ends, prepend=0)
    kinds = _kind_table()[raw]
    row = np.repeat(np.arange(rows), sizes)
    pairs = np.zeros((rows, _K * _K))
    if len(raw) > 1:
        inside = np.flatnonzero(row[1:] == row[:-1])
        cell = row[inside] * (_K * _K) + kinds[inside] * _K + kinds[inside + 1]
        pairs = np.bincount(cell, minlength=rows * _K * _K).reshape(rows, -1).astype(float)
    pairs = np.sqrt(pairs / np.maximum(1, pairs.sum(axis=1, keepdims=True)))
    words = Words(texts, blank_separated())
    hashes, n = words.hashes(), words.counts
    length = (words.ends - words.starts).astype(float)
    total = np.bincount(words.owner, length, rows)
    squares = np.bincount(words.owner, length * length, rows)
    mean = total / np.maximum(1, n)
    spread = np.sqrt(np.maximum(0, squares / np.maximum(1, n) - mean**2))
    fives = gram_places(words, 5)
    repeats = _repeat_share(words.owner[fives], grams(hashes, 5)[fives], rows)
    next_same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (words.owner[1:] == words.owner[:-1]))
    stutter = np.bincount(words.owner[next_same], minlength=rows) / np.maximum(1, n)
    marks = np.ones(256, bool)
    marks[0x0A] = False
    lines = Words(texts, marks)
    twice = _repeat_share(lines.owner, lines.hashes(), rows)
    extra = [
        np.log1p(n),
        1.0 / (1.0 + n),
        n < 10,
        mean,
        np.log1p(mean),
        spread,
        repeats,
        repeats > 0.2,
        stutter,
        twice,
        np.log1p(n / np.maximum(1, lines.counts)),
        np.bincount(words.owner, length > 14, rows) / np.maximum(1, n),
    ]
    return np.concatenate([pairs, np.stack(extra, axis=1)], axis=1).astype(np.float32)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch):
            values = text_features(part.column("text"))
            packed = pa.array([v.tobytes() for v in values], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), packed], ["doc_id", "features"])


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, features) of every document, features as 32-bit floats in a binary column."""
    return doc_text(docs).mapInArrow(_feature_rows, "doc_id long, features binary")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("features")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(np.float32).reshape(len(column), FEATURES).astype(float) if len(column) else np.zeros((0, FEATURES))


@dataclass(frozen=True)
class QualityModel:
    """Centre and scale of the features, weights, intercept and the estimated class prior."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights + self.intercept


def _summed(table: DataFrame, make) -> np.ndarray:
    """The sum over all rows of the array that ``make(features, positive)`` gives for a batch."""
    fan = max(1, math.isqrt(partitions(table.sparkSession)))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x, p = _matrix(batch), batch.column("positive").to_numpy(zero_copy_only=False).astype(bool)
            part = make(x, p)
            total = part if total is None else total + part
        if total is not None:
            slot = TaskContext.get().partitionId() % fan
            yield pa.RecordBatch.from_arrays(
                [pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slot", "sums"]
            )

    def merge(part: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(v.as_buffer()) for v in part.column("sums"))
        return pa.table({"sums": pa.array([sums.tobytes()], pa.binary())})

    rows = (
        table.select("features", "positive")
        .mapInArrow(partial, "slot int, sums binary")
        .groupBy("slot")
        .applyInArrow(merge, "sums binary")
        .collect()
    )
    parts = [np.frombuffer(r["sums"]) for r in rows]
    # in a fixed order, so that equal data give equal sums
    return sum(sorted(parts, key=lambda v: v.tobytes()))


def _moments(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(x), p.sum()], x.sum(axis=0), (x * x).sum(axis=0)])


def _terms(model: QualityModel):
    """Sums over all texts and over positives: loss(-f), s(f) z, s(1-s) zz', z; s is the sigmoid."""

    def make(x: np.ndarray, p: np.ndarray) -> np.ndarray:
        z = np.hstack([np.clip((x - model.centre) / model.scale, -8, 8), np.ones((len(x), 1))])
        f = z[:, :-1] @ model.weights + model.intercept
        s = sigmoid(f)
        out = []
        for own in (np.ones(len(x), bool), p):
            zo, so = z[own], s[own]
            curve = (zo * (so * (1 - so))[:, None]).T @ zo
            out += [[np.logaddexp(0, f[own]).sum()], so @ zo, curve.ravel(), zo.sum(axis=0)]
        return np.concatenate(out)

    return make


def _unpack(sums: np.ndarray, n: float, m: float):
    d = FEATURES + 1
    cuts = np.cumsum([1, d, d * d, d] * 2)[:-1]
    parts = np.split(sums, cuts)
    every = [v / n for v in parts[:4]]
    positive = [v / m for v in parts[4:]]
    return every, positive


def _step(model: QualityModel, gradient: np.ndarray, curve: np.ndarray, prior: float) -> QualityModel:
    w = np.append(model.weights, model.intercept)
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 1e-6
    move = np.linalg.solve(curve + np.diag(ridge), gradient + ridge * w)
    move *= min(1.0, 6.0 / (np.abs(move).max() + 1e-12))
    w = w - move
    return QualityModel(model.centre, model.scale, w[:-1], float(w[-1]), prior)


def _class_prior(table: DataFrame, model: QualityModel, n: float, m: float) -> float:
    """The smallest ratio of shares above a score, each with a margin for chance."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.minimum((sigmoid(model.logits(_matrix(batch))) * 1000).astype(np.int32), 999)
            yield pa.RecordBatch.from_arrays([pa.array(s), batch.column("positive")], ["bin", "positive"])

    # at most a thousand rows
    rows = (
        table.select("features", "positive")
        .mapInArrow(score, "bin int, positive boolean")
        .groupBy("bin")
        .agg(F.count("*").alias("n"), F.sum(F.col("positive").cast("long")).alias("m"))
        .orderBy(F.col("bin").desc())
        .collect()
    )
    above_all = np.cumsum([r["n"] for r in rows]) / n
    above_positive = np.cumsum([r["m"] for r in rows]) / m
    seen = above_positive > 0
    above_all, above_positive = above_all[seen], above_positive[seen]
    margin = math.sqrt(math.log(4 / CONFIDENCE) / (2 * n)) + math.sqrt(math.log(4 / CONFIDENCE) / (2 * m))
    best = int(np.argmin((above_all + margin) / above_positive))
    return float(np.clip(above_all[best] / above_positive[best], 0.02, 0.98))


def _positives(labels: DataFrame) -> DataFrame:
    return (
        labels.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
        .select("doc_id", F.lit(True).alias("positive"))
    )


def fit_quality(table: DataFrame) -> QualityModel:
    """Fit on a stored table of ``features`` and ``positive``; see the module's description.

    Without rows or positives the model knows nothing and scores every text 0.5.
    """
    zero, one = np.zeros(FEATURES), np.ones(FEATURES)
    if table.isEmpty():
        return QualityModel(zero, one, zero, 0.0, 0.5)
    sums = _summed(table, _moments)
    n, m = sums[0], sums[1]
    if m == 0:
        return QualityModel(zero, one, zero, 0.0, 0.5)
    centre = sums[2 : 2 + FEATURES] / n
    scale = np.sqrt(np.maximum(sums[2 + FEATURES :] / n - centre**2, 0))
    scale = np.where(scale < 1e-6, 1.0, scale)
    model = QualityModel(centre, scale, zero, 0.0, 0.5)
    for _ in range(NEWTON_STEPS - 2):  # positives against all, as if equally many
        (_, grad_all, curve_all, _), (_, grad_pos, curve_pos, mean_pos) = _unpack(_summed(table, _terms(model)), n, m)
        d = FEATURES + 1
        model = _step(model, grad_all + grad_pos - mean_pos, (curve_all + curve_pos).reshape(d, d), 0.5)
    prior = _class_prior(table, model, n, m)
    model = QualityModel(centre, scale, zero, 0.0, prior)
    for _ in range(NEWTON_STEPS):
        every, positive = _unpack(_summed(table, _terms(model)), n, m)
        d = FEATURES + 1
        negative_risk = every[0][0] - prior * positive[0][0]
        if negative_risk >= 0:
            model = _step(model, every[1] - prior * positive[3], every[2].reshape(d, d), prior)
        else:  # the part for bad texts is over-fitted: undo some of it
            away = prior * positive[1] - every[1]
            model = _step(model, 0.5 * away, every[2].reshape(d, d), prior)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every document: the chance, from 0 to 1, that it is good.

    The text alone decides. Held-out rows' labels are not read. Null and empty texts are scored
    like any other; repeated rows score alike; a null id is never a positive; an id with several
    labels is a positive only if all say so. Other columns are ignored and an empty table gives
    no rows.
    """
    table = stored(
        feature_table(docs)
        .join(_positives(labels), "doc_id", "left")
        .select("doc_id", "features", F.coalesce("positive", F.lit(False)).alias("positive")),
        "quality-features",
    )
    model = fit_quality(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = sigmoid(model.logits(_matrix(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return table.select("doc_id", "features").mapInArrow(score, "doc_id long, score double")
