"""Typed CSV scan and sinks. Types are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.operators.contracts import raw_contract, require_valid
from tallyloom.spec import TabularSpec


def csv_schema(spec: TabularSpec, columns: list[str]) -> T.StructType:
    """Declared types by role; number-or-blank text stays text."""
    kinds: dict[str, T.DataType] = {
        **{c: T.LongType() for c in (*spec.int_numeric, *spec.flags)},
        **{c: T.DoubleType() for c in spec.float_numeric},
    }
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in columns])


def read_csv(
    spark: SparkSession,
    path: str,
    spec: TabularSpec,
    columns: list[str],
    validate: bool = False,
) -> DataFrame:
    """Header CSV under the declared schema; single blanks survive as text."""
    df = (
        spark.read.schema(csv_schema(spec, columns))
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("enforceSchema", False)
        .csv(path)
    )
    return require_valid(df, raw_contract(spec), spec.id_col) if validate else df


def write_csv(df: DataFrame, path: str) -> str:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_assignments(split: DataFrame, key: str, path: str) -> str:
    """The id -> split map, kept for audit."""
    split.select(key, "split").write.mode("overwrite").parquet(path)
    return path
