"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import ship_by_value

ship_by_value(__name__)


def doc_text(docs: DataFrame) -> DataFrame:
    """The two columns the operators read; other columns, whatever their names, are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def held_out(doc_id: Column) -> Column:
    """Rows kept out of every fit: crc32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def partitions(spark: SparkSession) -> int:
    """The cluster's number of shuffle partitions, which follows the size of the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker, for tables reused by later tasks."""
    name = "_text_operator_store"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def give_back() -> None:
    """Hands memory that this Python worker has freed back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task function on batches that gives back freed memory at its end.

    Python workers outlive stages: without it, what one stage needed adds to the next one's need.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def lean_group(run: Callable[[pa.Table], pa.Table]):
    """The same for a function of one group."""

    def task(table: pa.Table) -> pa.Table:
        out = run(table)
        del table
        give_back()
        return out

    return task


class RecentlyUsed(dict):
    """A dictionary in two generations, so that it holds about twice ``size`` entries at most.

    When the young one is full it becomes the old one; entries asked for again move over.
    """

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def missing(self, keys: set) -> set:
        """The keys that neither generation has; those of the old one become young again."""
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()
        absent = keys - self.keys()
        again = absent & self.old.keys()
        self.update((k, self.old[k]) for k in again)
        return absent - again


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))
