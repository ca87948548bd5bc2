"""Connected components of a graph given as a table of edges, and of small graphs in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import scratch_dir, ship_by_value

ship_by_value(__name__)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each place's component, for ``n`` places and edges ``a``-``b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            break
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def _with_smallest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest node ``m`` among u and all its neighbours v.

    The sum per node is combined before the shuffle; a node of very many edges is a skewed join
    key that Spark splits.
    """
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(smallest, "u").select("u", "v", F.least("u", "m").alias("m"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of the edges (u, v); the component is its smallest node.

    Alternates two steps until nothing changes: every node links its larger neighbours to its
    smallest one, then every node links itself and its smaller neighbours to its smallest one.
    Each round is written to the shared scratch folder, which keeps the lineage short. Two folders
    take turns, so no more than two rounds lie there; only row counts and check sums come to the
    driver.
    """
    spark = edges.sparkSession
    folders = [scratch_dir(spark, f"{name}-{i}") for i in range(2)]

    def written(round_edges: DataFrame, turn: int) -> DataFrame:
        _distinct(round_edges.filter("u <> v")).write.mode("overwrite").parquet(folders[turn % 2])
        return spark.read.schema("u long, v long").parquet(folders[turn % 2])

    state, turn, seen = written(edges, 0), 0, None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
        hung = _with_smallest(down)
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            hung.select("u", F.col("m").alias("v"))
        )
        turn += 1
        state = written(small, turn)
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
