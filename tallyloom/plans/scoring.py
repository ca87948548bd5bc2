"""Batch scoring: check, score the good rows, keep the bad ones with their error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import decision
from tallyloom.operators.contracts import (
    Rule,
    require_columns,
    require_rows,
    scoring_contract,
    with_verdict,
)
from tallyloom.plans.preprocess import spec_by_name
from tallyloom.plans.training import FinalModel, score_column


def score_rows(
    df: DataFrame,
    final: FinalModel,
    spec_name: str,
    key: str,
    model_version: str = "unknown",
    rules: Sequence[Rule] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One output row per input row, keys carried through, batch or streaming.

    Rejected rows pass through the same plan with their probability blanked, so no second
    scan and no join is needed. The fitted stages accept missing and unseen values, hence a
    bad row cannot fail its neighbours.
    """
    s = spec_by_name(spec_name)
    narrow = require_columns(df, [*dict.fromkeys([key, *keep, *s.features])])
    judged = with_verdict(narrow, rules if rules is not None else scoring_contract(s))
    scored = score_column(final.model.transform(judged), "p_")
    ok = F.col("ok")
    return scored.select(
        key,
        *[c for c in keep if c != key],
        *[c for c in s.features if c not in keep and c != key],
        "ok",
        "error",
        F.when(ok, F.round("p_", 6)).alias("churn_probability"),
        F.when(ok, decision(F.col("p_"), final.threshold)).alias("prediction"),
        F.lit(float(final.threshold)).alias("applied_threshold"),
        F.lit(model_version).alias("model_version"),
    )


def score_batch(
    df: DataFrame, final: FinalModel, spec_name: str, key: str, model_version: str = "unknown"
) -> DataFrame:
    """``score_rows`` for a finite table; an empty one is an error."""
    return score_rows(require_rows(df), final, spec_name, key, model_version)
