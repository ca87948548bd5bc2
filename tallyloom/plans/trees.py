"""Tree ensembles on quantised features: boosting and forests, grown from histograms in a task.

Features are cut into at most ``BINS`` bins on the training rows; two-valued features that are
never on together (the slots of one category) share a column. A split comes from sums of
gradients, curvatures and rows per bin. Only the smaller child of a split is counted, the other is
the rest of its parent. Leaves are split best first up to ``leaves``; several of them are expanded
in one numpy step, and a forest grows several trees at once.

A fit works on a bounded number of rows (``FIT_ROWS``, taken by a hash of the row where there are
more), so it is one Spark job that ends in one task; scoring runs on all rows in parallel.
"""

from __future__ import annotations

import base64
import copy
import heapq
import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of a feature (in boosting, in forests), rows of a fit, leaves expanded in one step,
#: forest trees grown at once (more while their rows stay below the last).
BINS, FOREST_BINS, FIT_ROWS, AT_ONCE, TREES_AT_ONCE, ROWS_AT_ONCE = 255, 64, 200_000, 16, 8, 60_000
MIN_CURVATURE = 1e-3


def bin_edges(values: np.ndarray, most: int) -> np.ndarray:
    """Borders halfway between distinct values, or between quantiles if there are too many."""
    distinct = np.unique(values)
    if len(distinct) > most:
        distinct = np.unique(np.quantile(values, np.linspace(0, 1, most), method="lower"))
    return (distinct[1:] + distinct[:-1]) / 2


class Bins:
    """How features fall into cells: one cell for each bin, numbered through all columns."""

    def __init__(self, x: np.ndarray, most: int = BINS):
        self.columns: list[tuple] = []  # (features, their thresholds, first cell)
        feature, threshold, numeric_end = [], [], 0
        slots, used, at = [], None, 0
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            if len(values) < 2:
                continue
            if len(values) == 2:
                slots.append((f, float(values.mean())))
                continue
            edges = bin_edges(x[:, f], most)
            self.columns.append(([f], edges, at))
            feature += [f] * (len(edges) + 1)
            threshold += [*edges, np.inf]
            at += len(edges) + 1
        numeric_end = at
        for f, middle in slots:
            on = x[:, f] > middle
            if used is None or (used & on).any():
                used = np.zeros(len(x), bool)
                self.columns.append(([], [], at))
                feature.append(-1)  # the cell of rows for which no slot is on
                threshold.append(np.inf)
                at += 1
            used |= on
            self.columns[-1][0].append(f)
            self.columns[-1][1].append(middle)
            feature.append(f)
            threshold.append(middle)
            at += 1
        self.cells, self.numeric_end = at, numeric_end
        self.feature, self.threshold = np.array(feature, int), np.array(threshold, float)
        sizes = np.diff([*(c[2] for c in self.columns), at]) if self.columns else np.zeros(0, int)
        self.column_of = np.repeat(np.arange(len(self.columns)), sizes)
        self.numeric = [(first, first + len(edges) + 1) for _, edges, first in self.columns if first < numeric_end]

    def refitted(self, x: np.ndarray) -> Bins:
        """The same columns and cells with the edges of other rows; cells may stay empty."""
        own = copy.copy(self)
        own.columns, own.threshold = [], self.threshold.copy()
        for features, edges, first in self.columns:
            if first < self.numeric_end:
                found = bin_edges(x[:, features[0]], len(edges) + 1)
                edges = np.concatenate([found, np.full(len(edges) - len(found), np.inf)])
                own.threshold[first : first + len(edges)] = edges
            own.columns.append((features, edges, first))
        return own

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The cell of every row in every column."""
        out = np.zeros((len(self.columns), len(x)), np.int32)
        for row, (features, edges, first) in zip(out, self.columns):
            if first < self.numeric_end:
                row[:] = first + np.searchsorted(edges, x[:, features[0]], "left")
            else:
                row[:] = first
                for i, (f, middle) in enumerate(zip(features, edges)):
                    row[x[:, f] > middle] = first + 1 + i
        return out


@dataclass
class Limits:
    """Bounds of a tree and penalties of its leaf values."""

    leaves: int | None = None
    depth: int | None = None
    rows: int = 1
    l1: float = 0.0
    l2: float = 0.0
    curvature: float = 0.0


@dataclass(eq=False)
class _Node:
    tree: int
    path: int
    depth: int
    rows: np.ndarray
    sums: np.ndarray
    cells: np.ndarray | None = None
    gain: float = -np.inf
    cell: int = -1
    kids: tuple | None = None
    split: bool = False


@dataclass
class Tree:
    """Nodes in arrays: a row goes left where its feature is at most the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    leaves: list = field(default_factory=list)  # (value, rows) of the training run

    def values(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        while True:
            inner = np.flatnonzero(self.feature[at] >= 0)
            if not len(inner):
                return self.value[at]
            node = at[inner]
            low = x[inner, self.feature[node]] <= self.threshold[node]
            at[inner] = np.where(low, self.left[node], self.right[node])


def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return g if not l1 else np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _score(g, h, limits: Limits):
    return _shrunk(g, limits.l1) ** 2 / np.maximum(h + limits.l2, 1e-300)


class Grower:
    """Grows trees over one set of coded rows.

    ``row_of`` maps the rows that trees are given to rows of ``codes``; trees that draw their
    rows apart thus have rows, gradients and counts of their own.
    """

    def __init__(self, bins: Bins, codes: np.ndarray, limits: Limits, allowed: Callable | None = None):
        self.bins, self.codes, self.limits, self.allowed = bins, codes, limits, allowed

    def grow(self, roots: list[np.ndarray], sums: np.ndarray, row_of: np.ndarray | None = None, thresholds=None) -> list[Tree]:
        """One tree for each root. ``sums`` holds gradient, curvature and count of each row."""
        self.sums, self.row_of = sums, row_of
        self.thresholds = thresholds or [self.bins.threshold] * len(roots)
        limit = self.limits.leaves
        tops = [_Node(t, 1, 0, rows, sums[:, rows].sum(axis=1)) for t, rows in enumerate(roots)]
        if self.bins.cells:
            self._count(tops)
            self._choose(tops)
        waiting = [[] for _ in roots]
        left = [(limit or 1) - 1 for _ in roots]
        for top in tops:
            self._push(waiting[top.tree], top)
        while True:
            batch = []
            for t, heap in enumerate(waiting):
                if limit is None:  # every split is made, so their order does not matter
                    for *_, node in heap:
                        node.split = True
                        batch.append(node)
                    heap.clear()
                    continue
                while heap and left[t] > 0 and heap[0][2].kids is not None:
                    node = heapq.heappop(heap)[2]
                    node.split = True
                    left[t] -= 1
                    for kid in node.kids:
                        self._push(heap, kid)
                if heap and left[t] > 0:
                    batch += [n for *_, n in heapq.nsmallest(min(AT_ONCE, left[t]), heap) if n.kids is None]
            if not batch:
                return [self._tree(top) for top in tops]
            batch.sort(key=lambda n: (n.tree, n.path))
            for i in range(0, len(batch), 256):
                self._expand(batch[i : i + 256])
            if limit is None:
                for node in batch:
                    for kid in node.kids:
                        self._push(waiting[node.tree], kid)

    @staticmethod
    def _push(heap: list, node: _Node) -> None:
        if node.gain > 1e-12:
            heapq.heappush(heap, (-node.gain, node.path, node))

    def _codes(self, columns, rows):
        return self.codes[columns, rows if self.row_of is None else self.row_of[rows]]

    def _count(self, nodes: list[_Node]) -> None:
        """Sums per cell of each node's rows."""
        rows = np.concatenate([n.rows for n in nodes])
        owner = np.repeat(np.arange(len(nodes)), [len(n.rows) for n in nodes])
        counted = self.sums[2, rows] > 0
        rows, owner = rows[counted], owner[counted]
        cells, columns = self.bins.cells, len(self.bins.columns)
        keys = (self._codes(slice(None), rows) + (owner * cells)[None, :]).ravel()
        found = np.stack(
            [np.bincount(keys, np.tile(self.sums[k, rows], columns), len(nodes) * cells) for k in range(3)]
        ).reshape(3, len(nodes), cells)
        for i, node in enumerate(nodes):
            node.cells = found[:, i]

    def _choose(self, nodes: list[_Node]) -> None:
        """The best split of each node."""
        limits, bins = self.limits, self.bins
        nodes = [n for n in nodes if n.sums[2] >= 2 * limits.rows and (limits.depth is None or n.depth < limits.depth)]
        if not nodes:
            return
        low = np.stack([n.cells for n in nodes], axis=1)
        total = np.stack([n.sums for n in nodes], axis=1)[:, :, None]
        for a, b in bins.numeric:
            np.cumsum(low[:, :, a:b], axis=2, out=low[:, :, a:b])
        low[:, :, bins.numeric_end :] = total - low[:, :, bins.numeric_end :]
        high = total - low
        good = (low[2] >= limits.rows) & (high[2] >= limits.rows) & (bins.feature >= 0)
        if limits.curvature:
            good &= (low[1] >= limits.curvature) & (high[1] >= limits.curvature)
        gain = _score(low[0], low[1], limits) + _score(high[0], high[1], limits)
        gain -= _score(total[0], total[1], limits)
        gain[~good] = -np.inf
        if self.allowed is not None:
            drawn = np.where(self.allowed(len(nodes))[:, bins.feature], gain, -np.inf)
            some = np.isfinite(drawn).any(axis=1)
            gain[some] = drawn[some]
        best = gain.argmax(axis=1)
        for node, cell, value in zip(nodes, best.tolist(), gain[np.arange(len(nodes)), best].tolist()):
            node.cell, node.gain = cell, value

    def _expand(self, nodes: list[_Node]) -> None:
        """Children of each node, with sums per cell and best splits."""
        bins = self.bins
        sizes = [len(n.rows) for n in nodes]
        rows = np.concatenate([n.rows for n in nodes])
        cell = np.repeat([n.cell for n in nodes], sizes)
        code = self._codes(bins.column_of[cell], rows)
        is_low = np.where(cell < bins.numeric_end, code <= cell, code != cell)
        side = 2 * np.repeat(np.arange(len(nodes)), sizes) + ~is_low
        sums = np.stack([np.bincount(side, self.sums[k, rows], 2 * len(nodes)) for k in range(3)])
        parts = np.split(rows[np.argsort(side, kind="stable")], np.cumsum(np.bincount(side, minlength=2 * len(nodes)))[:-1])
        kids, count, rest, limits = [], [], [], self.limits
        for i, node in enumerate(nodes):
            low, high = (
                _Node(node.tree, 2 * node.path + k, node.depth + 1, parts[2 * i + k], sums[:, 2 * i + k]) for k in (0, 1)
            )
            node.kids = (low, high)
            most = max(low.sums[2], high.sums[2])
            if most >= 2 * limits.rows and (limits.depth is None or low.depth < limits.depth):
                small, other = (low, high) if len(low.rows) <= len(high.rows) else (high, low)
                count.append(small)
                rest.append((node, small, other))
                kids += node.kids
        if count:
            self._count(count)
            for node, small, other in rest:
                other.cells = node.cells - small.cells
            self._choose(kids)
        for node in nodes:
            node.cells = None

    def _tree(self, top: _Node) -> Tree:
        order, at = [top], 0
        while at < len(order):
            node = order[at]
            if node.split:
                order += node.kids
            at += 1
        place = {id(n): i for i, n in enumerate(order)}
        limits, bins = self.limits, self.bins
        value = np.array([-float(_shrunk(n.sums[0], limits.l1)) / max(n.sums[1] + limits.l2, 1e-300) for n in order])
        kid = [[place[id(n.kids[side])] if n.split else -1 for n in order] for side in (0, 1)]
        return Tree(
            np.array([bins.feature[n.cell] if n.split else -1 for n in order]),
            np.array([self.thresholds[top.tree][n.cell] if n.split else 0.0 for n in order]),
            np.array(kid[0]), np.array(kid[1]), value,
            np.array([n.gain if n.split else 0.0 for n in order]),
            [(value[i], n.rows) for i, n in enumerate(order) if not n.split],
        )


@dataclass
class Ensemble:
    """Trees and how their sum becomes a probability."""

    trees: list[Tree]
    base: float
    logistic: bool

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(raw, -500, 500))) if self.logistic else np.clip(raw, 0.0, 1.0)

    def predict(self, x: np.ndarray) -> np.ndarray:
        raw = np.full(len(x), self.base)
        for tree in self.trees:
            raw += tree.values(x)
        return self.probability(raw)

    def importances(self, n: int) -> np.ndarray:
        total = np.zeros(n)
        for tree in self.trees:
            inner = tree.feature >= 0
            own = np.bincount(tree.feature[inner], tree.gain[inner], n)
            total += own if self.logistic or not own.sum() else own / own.sum()
        return total / (total.sum() or 1.0)

    def dumps(self) -> str:
        sizes = [len(t.feature) for t in self.trees]
        names = ("feature", "threshold", "left", "right", "value", "gain")
        joined = {k: np.concatenate([getattr(t, k) for t in self.trees] or [np.zeros(0)]) for k in names}
        out = io.BytesIO()
        np.savez_compressed(out, sizes=sizes, base=self.base, logistic=self.logistic, **joined)
        return base64.b64encode(out.getvalue()).decode()

    @staticmethod
    def loads(text: str) -> Ensemble:
        data = np.load(io.BytesIO(base64.b64decode(text)))
        names = ("feature", "threshold", "left", "right", "value", "gain")
        ends = np.cumsum(data["sizes"]).astype(int)
        parts = [np.split(data[k], ends[:-1]) if len(ends) else [] for k in names]
        trees = [Tree(f.astype(int), t, a.astype(int), b.astype(int), v, g) for f, t, a, b, v, g in zip(*parts)]
        return Ensemble(trees, float(data["base"]), bool(data["logistic"]))


def boost_together(
    problems: list[tuple], limits: Limits, rounds: int, rate: float,
    seed: int = 42, rows: float = 1.0, columns: float = 1.0,
) -> list[tuple[Ensemble, np.ndarray]]:
    """Logistic boosting of several (x, y, w, also) with the same features, side by side.

    Gives each one's model and its probabilities of the rows ``also``. Every round draws a share
    of ``rows`` without replacement, every tree a share of ``columns``. Each problem has bins of
    its own training rows; the steps of numpy are shared, the results are as if run alone.
    """
    shared = Bins(np.concatenate([x for x, *_ in problems]))
    own = [shared.refitted(x) for x, *_ in problems]
    wholes = [np.concatenate([x, also]) for x, _, _, also in problems]
    codes = np.concatenate([b.codes(whole) for b, whole in zip(own, wholes)], axis=1)
    ends = np.cumsum([len(whole) for whole in wholes])
    roots = [np.arange(end - len(whole), end) for end, whole in zip(ends, wholes)]
    trained = np.concatenate([r[: len(x)] for r, (x, *_) in zip(roots, problems)])
    y, w = (np.concatenate([p[k] for p in problems]).astype(float) for k in (1, 2))
    base = []
    for _, own_y, own_w, _ in problems:
        mean = float(np.clip((own_w * own_y).sum() / max(own_w.sum(), 1e-300), 1e-12, 1 - 1e-12))
        base.append(float(np.log(mean / (1 - mean))))
    raw = np.repeat(base, [len(r) for r in roots])
    draw_rows = [np.random.default_rng([seed, 0]) for _ in problems]
    draw_columns = np.random.default_rng([seed, 1])
    features = problems[0][0].shape[1]
    sums, trees = np.zeros((3, len(raw))), [[] for _ in problems]
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-raw[trained]))
        sums[0, trained], sums[1, trained], sums[2, trained] = w * (p - y), w * p * (1 - p), 1.0
        if rows < 1.0:
            for rng, root, (x, *_) in zip(draw_rows, roots, problems):
                sums[:, root[rng.permutation(len(x))[max(1, int(rows * len(x))) :]]] = 0.0
        allowed = None
        if columns < 1.0:
            drawn = np.zeros(features + 1, bool)
            drawn[draw_columns.permutation(features)[: max(1, round(columns * features))]] = True
            allowed = _always(drawn)
        grown = Grower(shared, codes, limits, allowed).grow(roots, sums, thresholds=[b.threshold for b in own])
        for tree, kept in zip(grown, trees):
            tree.value = rate * tree.value
            for value, leaf in tree.leaves:
                raw[leaf] += rate * value
            tree.leaves = []
            kept.append(tree)
    models = [Ensemble(kept, b, True) for kept, b in zip(trees, base)]
    return [(m, m.probability(raw[r[len(x) :]])) for m, r, (x, *_) in zip(models, roots, problems)]


def boost(x, y, w, limits: Limits, rounds: int, rate: float, seed=42, rows=1.0, columns=1.0) -> Ensemble:
    """``boost_together`` of one problem."""
    return boost_together([(x, y, w, x[:0])], limits, rounds, rate, seed, rows, columns)[0][0]


def _always(drawn: np.ndarray) -> Callable:
    return lambda k: np.broadcast_to(drawn, (k, len(drawn)))


def forest(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int, depth: int | None, least: int,
    features: str | float, seed: int = 42, also: np.ndarray | None = None,
) -> tuple[Ensemble, np.ndarray | None]:
    """A forest of trees on drawn rows, each split among drawn features; leaves hold shares.

    Splits lower the weighted Gini impurity: for two classes that is the sum of squares of the
    positive weight over the weight, so gradients are minus the positive weights.
    """
    bins, n = Bins(x, FOREST_BINS), len(x)
    every = x if also is None else np.concatenate([x, also])
    codes, rng = bins.codes(every), np.random.default_rng(seed)
    d = x.shape[1]
    k = {"sqrt": int(np.sqrt(d)), "log2": int(np.log2(max(d, 2)))}.get(features) if isinstance(features, str) else int(
        features * d
    )
    k = max(1, min(d, k))

    def allowed(nodes: int) -> np.ndarray:
        rank = rng.random((nodes, d)).argpartition(k - 1, axis=1)[:, :k]
        mask = np.zeros((nodes, d + 1), bool)
        np.put_along_axis(mask, rank, True, axis=1)
        return mask

    grower = Grower(bins, codes, Limits(None, depth, least), None if k == d else allowed)
    found, score = [], np.zeros(len(every))
    size = len(every)
    at_once = max(TREES_AT_ONCE, min(64, ROWS_AT_ONCE // max(size, 1)))
    for first in range(0, trees, at_once):
        many = min(at_once, trees - first)
        drawn = np.stack([np.bincount(rng.integers(0, n, n), minlength=n) for _ in range(many)])
        sums = np.zeros((3, many, size))
        sums[0, :, :n], sums[1, :, :n], sums[2, :, :n] = -w * y * drawn, w * drawn, drawn
        row_of = np.tile(np.arange(size), many)
        roots = []
        for t in range(many):
            present = np.concatenate([np.flatnonzero(drawn[t]), np.arange(n, size)])
            roots.append(t * size + present)
        grown = grower.grow(roots, sums.reshape(3, -1), row_of)
        for tree in grown:
            tree.value = tree.value / trees
            for value, own in tree.leaves:
                score[row_of[own]] += value / trees
            tree.leaves = []
        found += grown
    model = Ensemble(found, 0.0, False)
    return model, None if also is None else model.probability(score[n:])


# --- as estimators ---------------------------------------------------------------------


def hist_gb_fit(p: dict[str, Any]) -> Callable:
    """Boosting bounded by leaves, with an L2 penalty."""
    limits = Limits(
        int(p.get("max_leaf_nodes", 31)), None, int(p.get("min_samples_leaf", 20)), 0.0,
        float(p.get("l2_regularization", 0.0)), MIN_CURVATURE,
    )
    rounds, rate = int(p.get("max_iter", 300)), float(p.get("learning_rate", 0.1))
    return lambda problems: boost_together(problems, limits, rounds, rate, int(p.get("random_state", 42)))


def lightgbm_fit(p: dict[str, Any]) -> Callable:
    """Boosting with drawn rows and columns, both penalties, bounds on leaves and depth."""
    depth = int(p.get("max_depth", -1))
    limits = Limits(
        int(p.get("num_leaves", 31)), depth if depth > 0 else None, int(p.get("min_child_samples", 20)),
        float(p.get("reg_alpha", 0.0)), float(p.get("reg_lambda", 0.0)), MIN_CURVATURE,
    )
    rounds, rate = int(p.get("n_estimators", 400)), float(p.get("learning_rate", 0.05))
    rows, columns = float(p.get("subsample", 1.0)), float(p.get("colsample_bytree", 1.0))
    seed = int(p.get("random_state", 42))
    return lambda problems: boost_together(problems, limits, rounds, rate, seed, rows, columns)


def random_forest_fit(p: dict[str, Any]) -> Callable:
    """A forest, one problem after the other; its trees already grow side by side."""
    depth = p.get("max_depth")
    args = (
        int(p.get("n_estimators", 400)), None if depth is None else int(depth), int(p.get("min_samples_leaf", 5)),
        p.get("max_features", "sqrt"), int(p.get("random_state", 42)),
    )
    return lambda problems: [forest(x, y, w, *args, also) for x, y, w, also in problems]


#: Fits by name: parameters -> problems (x, y, weights, rows to score) -> models and scores.
FITS = {"hist_gb": hist_gb_fit, "lightgbm": lightgbm_fit, "random_forest": random_forest_fit}


class _Columns(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0 or 1", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight of a row", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", weightCol="weight")

    def setFeaturesCol(self, v: str):
        return self._set(featuresCol=v)

    def setLabelCol(self, v: str):
        return self._set(labelCol=v)

    def setWeightCol(self, v: str):
        return self._set(weightCol=v)


class TreeEnsemble(Estimator, _Columns):
    """Fits one of ``FITS`` on at most ``max_rows`` rows."""

    def __init__(self, kind: str, params: dict[str, Any], max_rows: int = FIT_ROWS):
        super().__init__()
        self.kind, self.drawn, self.max_rows = kind, dict(params), max_rows

    def _fit(self, dataset: DataFrame) -> TreeEnsembleModel:
        get, kind, drawn = self.getOrDefault, self.kind, self.drawn
        rows = dataset.select(
            vector_to_array(get(self.featuresCol)).alias("x"),
            F.col(get(self.labelCol)).cast("double").alias("y"),
            F.col(get(self.weightCol)).cast("double").alias("w"),
        )

        def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            whole = pd.concat(list(frames), ignore_index=True)
            x = np.stack(whole["x"].to_numpy())
            ((model, _),) = FITS[kind](drawn)([(x, whole["y"].to_numpy(), whole["w"].to_numpy(), x[:0])])
            yield pd.DataFrame({"trees": [model.dumps()], "importances": [model.importances(x.shape[1]).tolist()]})

        # the bounded rows come to one task in an order that does not depend on the input's
        bounded = rows.orderBy(F.xxhash64("x"), "y", "w").limit(self.max_rows).coalesce(1)
        found = bounded.mapInPandas(fit, "trees string, importances array<double>").first()
        if found is None:
            raise ValueError("no rows to fit on")
        return TreeEnsembleModel()._set(
            featuresCol=get(self.featuresCol), trees=found["trees"], importances=list(found["importances"])
        )


class TreeEnsembleModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the vector column ``probability`` of both classes."""

    trees = Param(Params._dummy(), "trees", "packed trees", TypeConverters.toString)
    importances = Param(Params._dummy(), "importances", "share of gains", TypeConverters.toListFloat)

    def __init__(self):
        super().__init__()

    @property
    def featureImportances(self):
        return Vectors.dense(self.getOrDefault(self.importances))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        packed, cache = self.getOrDefault(self.trees), {}

        @F.pandas_udf("array<double>")
        def probability(x: pd.Series) -> pd.Series:
            if "model" not in cache:
                cache["model"] = Ensemble.loads(packed)
            if not len(x):
                return pd.Series([], dtype=object)
            p = cache["model"].predict(np.stack(x.to_numpy()))
            return pd.Series(list(np.stack([1.0 - p, p], axis=1)))

        scores = probability(vector_to_array(self.getOrDefault(self.featuresCol)))
        return dataset.withColumn("probability", array_to_vector(scores))
