"""Stateless cleaning: trim text, coerce numbers, derive the label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.features import derived_columns
from tallyloom.functions.numeric import present
from tallyloom.functions.text import to_integer, to_number, trim_strings
from tallyloom.spec import TabularSpec

MISSING = "missing"


def clean(df: DataFrame, spec: TabularSpec) -> DataFrame:
    """Model-ready types: integer tenure and flags, double charges, trimmed text.

    A blank or unparsable number becomes NULL and is imputed by the fitted stage.
    """
    typed = {c: to_integer(F.col(c)) for c in (*spec.int_numeric, *spec.flags)}
    typed |= {c: to_number(F.col(c)) for c in (*spec.float_numeric, *spec.text_numeric)}
    return trim_strings(df).withColumns({c: e for c, e in typed.items() if c in df.columns})


def engineer(df: DataFrame, spec: TabularSpec) -> DataFrame:
    """Adds the four derived features."""
    return df.select("*", *derived_columns(spec))


def fill_categories(df: DataFrame, columns: Sequence[str], value: str = MISSING) -> DataFrame:
    """Missing categories become their own category."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in columns})


def with_label(df: DataFrame, spec: TabularSpec, out: str = "label") -> DataFrame:
    return df.withColumn(
        out, F.col(spec.label_col).eqNullSafe(F.lit(spec.positive)).cast("int")
    )


def features_and_label(df: DataFrame, spec: TabularSpec) -> DataFrame:
    """Label derived, target column dropped; the id stays for alignment, not as a feature."""
    return with_label(df, spec).drop(spec.label_col)


def drop_missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(present(F.col(column)))
