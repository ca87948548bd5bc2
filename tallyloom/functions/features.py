"""The four derived features as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import to_number
from tallyloom.spec import TENURE_LABELS, TENURE_UPPER_BOUNDS, TabularSpec


def tenure_group(tenure: Column) -> Column:
    """Right-closed lifecycle bins; a negative or missing tenure is NULL, imputed later."""
    months = tenure.cast("double")
    chain = F.when((months < -0.001) | months.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(TENURE_UPPER_BOUNDS, TENURE_LABELS):
        chain = chain.when(months <= F.lit(float(bound)), F.lit(label))
    return chain.otherwise(F.lit(TENURE_LABELS[-1]))


def _is(col: str, value: str) -> Column:
    return F.col(col).eqNullSafe(F.lit(value))


def service_count(spec: TabularSpec) -> Column:
    """Add-ons taken + primary service + access service (missing access counts as one)."""
    parts = [_is(c, "Yes").cast("int") for c in (*spec.addons, spec.primary_service)]
    parts.append((~_is(spec.access_service, "No")).cast("int"))
    return reduce(lambda a, b: a + b, parts).cast("bigint")


def avg_monthly_charges(spec: TabularSpec) -> Column:
    """Missing stays missing; a tenure of -1 (a rejected row) gives NULL instead of failing."""
    return F.try_divide(
        to_number(F.col(spec.total)), F.col(spec.tenure).cast("double") + F.lit(1.0)
    )


def no_security_support(spec: TabularSpec) -> Column:
    lacking = [~_is(c, "Yes") for c in spec.guard_addons]
    return reduce(lambda a, b: a & b, lacking, ~_is(spec.access_service, "No")).cast("bigint")


def derived_columns(spec: TabularSpec) -> list[Column]:
    return [
        tenure_group(F.col(spec.tenure)).alias("tenure_group"),
        service_count(spec).alias("service_count"),
        avg_monthly_charges(spec).alias("avg_monthly_charges"),
        no_security_support(spec).alias("no_security_support"),
    ]
