"""A fingerprint of a table's rows that does not depend on their order or placement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 15 hex digits: a number that a BIGINT holds
_DIGITS = 15


def _field(f: T.StructField) -> Column:
    """Length and text of a value, so that neighbours cannot run together; NULL has its own mark."""
    col = F.col(f"`{f.name}`")
    text = F.hex(col) if isinstance(f.dataType, T.BinaryType) else col.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def table_digest(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """(by..., n_rows, digest) of the named columns, by default all, in the given order.

    Hashes of the rows are added as wide whole numbers, so tasks add up their own rows and only
    totals are shuffled. A changed, lost or repeated row changes the digest; names, order and
    partitions do not.
    """
    fields = {f.name: f for f in df.schema.fields}
    row = F.md5(F.concat_ws(",", *[_field(fields[c]) for c in columns or df.columns]))
    part = lambda k: F.conv(F.substring("row_", 1 + k * _DIGITS, _DIGITS), 16, 10)
    total = lambda k: F.sum(part(k).cast("decimal(20,0)"))
    sums = (
        df.select(*by, row.alias("row_"))
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_rows"), total(0).alias("s0"), total(1).alias("s1"))
    )
    whole = [F.coalesce(F.col(s).cast("string"), F.lit("0")) for s in ("s0", "s1")]
    return sums.select(
        *by, "n_rows", F.sha2(F.concat_ws(":", F.col("n_rows").cast("string"), *whole), 256).alias("digest")
    )
