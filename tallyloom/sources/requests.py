"""Scoring requests as nested JSON, flattened to one row per item.

A body is either a batch, ``{"items": [...]}``, or one record, ``{"customer_id", "features"}``.
Each level is parsed into a map, so keys outside the contract are seen wherever they stand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.contracts import MAX_BATCH
from tallyloom.spec import TabularSpec

_OBJECT = "map<string,string>"
_OBJECTS = f"array<{_OBJECT}>"
_BATCH_KEYS, _RECORD_KEYS = ("items",), ("customer_id", "features")


def request_json(id_col: str, features: Sequence[Column]) -> Column:
    """One request record as JSON text."""
    return F.to_json(
        F.struct(F.col(id_col).cast("string").alias("customer_id"),
                 F.struct(*features).alias("features"))
    )


def _foreign(keys: Column, allowed: Sequence[str]) -> Column:
    """Keys outside the allowed ones, sorted; none for a missing object."""
    known = F.array(*[F.lit(c) for c in allowed])
    return F.array_sort(F.coalesce(F.array_except(keys, known), F.array().cast("array<string>")))


def _record(m: Column) -> Column:
    return F.struct(
        m["customer_id"].alias("customer_id"),
        F.from_json(m["features"], _OBJECT).alias("features"),
        _foreign(F.map_keys(m), _RECORD_KEYS).alias("extra_keys"),
    )


def parse_batches(df: DataFrame, body: str) -> DataFrame:
    """Adds the parsed ``items`` and ``batch_error``.

    A batch is refused as a whole if it cannot be parsed, has keys beside ``items``, no items, or
    more than the cap. A single record is a batch of one.
    """
    top = F.col("top_")
    batch = F.array_contains(F.map_keys(top), "items")
    records = F.when(batch, F.from_json(top["items"], _OBJECTS)).when(
        F.array_contains(F.map_keys(top), "features"), F.array(top)
    )
    parsed = (
        df.withColumn("top_", F.from_json(F.col(body), _OBJECT))
        .withColumn("items", F.transform(records, _record))
        .withColumn("extra_", F.when(batch, _foreign(F.map_keys(top), _BATCH_KEYS)))
    )
    size = F.size("items")
    extra = F.concat(F.lit("batch: extra keys: "), F.concat_ws(",", "extra_"))
    return parsed.withColumn(
        "batch_error",
        F.when(F.col("items").isNull(), "batch: not parsable")
        .when(F.size("extra_") > 0, extra)
        .when(size < 1, "batch: no items")
        .when(size > MAX_BATCH, f"batch: more than {MAX_BATCH} items"),
    ).drop("top_", "extra_")


def flatten_items(
    parsed: DataFrame, spec: TabularSpec, keep: Sequence[str] = (), refused: bool = False
) -> DataFrame:
    """One row per item of accepted batches, in item order, features as text columns.

    Keys outside the contract, in the record or its features, are named in ``extra_keys``. With
    ``refused`` the items of refused batches come too, and a batch without items as one row
    whose ``index`` is NULL.
    """
    batches = parsed if refused else parsed.filter(F.col("batch_error").isNull())
    items = batches.select(*keep, F.posexplode_outer("items").alias("index", "item"))
    features = F.col("item.features")
    foreign = F.concat(F.col("item.extra_keys"), _foreign(F.map_keys(features), spec.features))
    return items.select(
        *keep,
        "index",
        F.col("item.customer_id").alias("customer_id"),
        *[features[c].alias(c) for c in spec.features],
        F.array_sort(F.array_distinct(foreign)).alias("extra_keys"),
    )
