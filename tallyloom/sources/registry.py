"""Model registry: saved pipeline models plus one append-only table of versions."""

from __future__ import annotations

import json
import platform
import uuid
from functools import reduce
from operator import and_
from typing import Any

import pyspark
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.digest import table_digest
from tallyloom.plans.training import GATE_AUC, GATE_F1, FinalModel

_TABLE = "versions"
_ROW = (
    "version string, path string, trained_at timestamp, estimator string, threshold double, "
    "classes array<string>, feature_columns array<string>, params string, metrics string, "
    "meta string, libraries map<string,string>, f1 double, roc_auc double"
)


class NoModelError(FileNotFoundError):
    """The registry is empty or lacks the wanted version."""


def library_versions() -> dict[str, str]:
    return {"python": platform.python_version(), "pyspark": pyspark.__version__}


def save_model(
    spark: SparkSession,
    folder: str,
    final: FinalModel,
    version: str,
    feature_columns: list[str],
    metrics: dict[str, Any],
    meta: dict[str, Any] | None = None,
) -> str:
    """Write the pipeline under a new path, then append its registry row (the switch)."""
    path = f"{folder.rstrip('/')}/model-{version}-{uuid.uuid4().hex}"
    final.model.write().save(path)
    row = (
        version,
        path,
        None,
        final.name,
        float(final.threshold),
        ["No", "Yes"],
        list(feature_columns),
        json.dumps(final.params, default=str),
        json.dumps(metrics, default=str),
        json.dumps(meta or {}, default=str),
        library_versions(),
        metrics.get("f1"),
        metrics.get("roc_auc"),
    )
    (
        spark.createDataFrame([row], _ROW)
        .withColumn("trained_at", F.current_timestamp())
        .write.mode("append")
        .parquet(f"{folder.rstrip('/')}/{_TABLE}")
    )
    return path


def versions(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_ROW).parquet(f"{folder.rstrip('/')}/{_TABLE}")


def resolve(
    spark: SparkSession, folder: str, version: str | None = None, path: str | None = None
) -> dict[str, Any]:
    """The registry row to serve: an explicit path wins, then a pinned version, then the latest."""
    rows = versions(spark, folder)
    if path is not None:
        rows = rows.filter(F.col("path") == path)
    elif version is not None:
        rows = rows.filter(F.col("version") == version)
    columns = rows.columns
    found = rows.agg(F.max_by(F.struct(*columns), F.struct("trained_at", "path")).alias("r"))
    row = found.select("r.*").first()
    if row is None or row["path"] is None:
        raise NoModelError(f"no registered model for version={version} path={path}")
    return row.asDict()


def load_model(
    spark: SparkSession, folder: str, version: str | None = None, path: str | None = None
) -> tuple[FinalModel, dict[str, Any]]:
    row = resolve(spark, folder, version, path)
    model = PipelineModel.load(row["path"])
    return (
        FinalModel(model, row["estimator"], json.loads(row["params"]), row["threshold"]),
        row,
    )


# What the ``meta`` of a registered model has to name.
PROVENANCE = ("data_digest", "data_rows", "split_sizes", "cv_folds", "random_state")


def provenance(
    parts: dict[str, DataFrame], columns: list[str], folds: int, seed: int
) -> dict[str, Any]:
    """What a model was trained and judged on: digest and rows of the data, splits, folds.

    One row for each split comes to the driver. The digest depends on the rows of every split,
    not on their order.
    """
    named = [df.select(*columns).withColumn("split_", F.lit(n)) for n, df in parts.items()]
    rows = reduce(DataFrame.unionByName, named)
    whole = table_digest(rows).first()
    sizes = {r["split_"]: r["count"] for r in rows.groupBy("split_").count().collect()}
    return {
        "data_digest": whole["digest"],
        "data_rows": whole["n_rows"],
        "split_sizes": {n: sizes.get(n, 0) for n in parts},
        "cv_folds": folds,
        "random_state": seed,
    }


def regression_gate(
    rows: DataFrame, f1: float = GATE_F1, auc: float = GATE_AUC, digest: str | None = None
) -> DataFrame:
    """Versions with their verdict: quality bounds met and provenance present.

    With ``digest`` a version also has to come from the data of that digest.
    """
    named = lambda key: F.get_json_object("meta", f"$.{key}")
    complete = reduce(and_, [named(k).isNotNull() for k in PROVENANCE])
    if digest is not None:
        complete = complete & (named("data_digest") == digest)
    complete = complete & (
        F.col("trained_at").isNotNull()
        & (F.size("libraries") > 0)
        & F.col("params").isNotNull()
        & F.col("metrics").isNotNull()
    )
    good = (F.col("f1") >= f1) & (F.col("roc_auc") >= auc)
    return rows.select(
        "version",
        "path",
        "estimator",
        "threshold",
        "f1",
        "roc_auc",
        F.coalesce(good & complete, F.lit(False)).alias("passed"),
    )
