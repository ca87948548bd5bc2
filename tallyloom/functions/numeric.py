"""Small numeric expressions shared by metrics and drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as a double, 0.0 where the denominator is zero or missing."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def ratio_or_null(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def present(col: Column) -> Column:
    """True for a usable number: neither NULL nor NaN."""
    return col.isNotNull() & ~F.isnan(col)


def floor_at(col: Column, eps: float) -> Column:
    return F.greatest(col, F.lit(eps))


def edges_at_or_below(x: Column, edges: list[float]) -> Column:
    """How many of a short edge list are <= x, as plain comparisons inside codegen."""
    return _count([(x >= F.lit(float(e))) for e in edges])


def edges_below(x: Column, edges: list[float]) -> Column:
    """How many of a short edge list are < x."""
    return _count([(x > F.lit(float(e))) for e in edges])


def _count(tests: list[Column]) -> Column:
    if not tests:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [t.cast("int") for t in tests])


def closed_last_bin(x: Column, edges: list[float]) -> Column:
    """0-based histogram bin: left-closed, the last bin closed on both sides.

    Values outside the edges and missing values give NULL.
    """
    if len(edges) < 2:
        return F.lit(None).cast("int")
    lo, hi = float(edges[0]), float(edges[-1])
    inside = present(x) & (x >= F.lit(lo)) & (x <= F.lit(hi))
    return F.when(inside, edges_at_or_below(x, edges[1:-1]))


def decision(p: Column, threshold: float, yes: str = "Yes", no: str = "No") -> Column:
    """Inclusive decision rule."""
    return F.when(p >= F.lit(threshold), F.lit(yes)).otherwise(F.lit(no))
