"""Data contracts: named column predicates, every violation reported, bad rows set aside.

A rule passes when its predicate is true or NULL (missing values are the business of the
``not_null`` rule), so one bad cell is reported once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import NUMBER_PATTERN, to_integer, to_number, trimmed
from tallyloom.spec import TabularSpec

Predicate = Callable[[Column], Column]

MAX_BATCH = 64
MAX_ID_LENGTH = 64
TOP_VIOLATIONS = 20


class MissingColumnsError(ValueError):
    """The table lacks columns its contract names."""


class ContractViolationError(ValueError):
    """Raised by ``require_valid`` with the number of violations found."""


@dataclass(frozen=True)
class Rule:
    """One named check of one column; ``ok`` builds the predicate that must not be false."""

    name: str
    column: str
    ok: Predicate

    def broken(self) -> Column:
        return ~F.coalesce(self.ok(F.col(self.column)), F.lit(True))


def not_null(column: str) -> Rule:
    return Rule("not_null", column, lambda c: c.isNotNull())


def one_of(column: str, domain: Sequence) -> Rule:
    return Rule("one_of", column, lambda c: c.isin(*domain))


def in_range(column: str, low: float, high: float) -> Rule:
    """Inclusive bounds on the coerced number."""
    return Rule("in_range", column, lambda c: to_number(c).between(low, high))


def coercible_integer(column: str) -> Rule:
    return Rule("coercible", column, lambda c: c.isNull() | to_integer(c).isNotNull())


def coercible_number(column: str) -> Rule:
    return Rule("coercible", column, lambda c: c.isNull() | to_number(c).isNotNull())


def number_or_blank(column: str) -> Rule:
    return Rule(
        "number_or_blank",
        column,
        lambda c: (trimmed(c) == "") | trimmed(c).rlike(NUMBER_PATTERN),
    )


def non_empty(column: str) -> Rule:
    return Rule("non_empty", column, lambda c: F.length(c.cast("string")) > 0)


def max_length(column: str, size: int) -> Rule:
    return Rule("max_length", column, lambda c: F.length(c.cast("string")) <= size)


def size_between(column: str, low: int, high: int) -> Rule:
    """Bounds on the number of items of an array column (batch cap)."""
    return Rule("size_between", column, lambda c: F.size(c).between(low, high))


def raw_contract(spec: TabularSpec) -> list[Rule]:
    """Full table: identifier and label present, closed domains, number-or-blank totals."""
    rules = [not_null(spec.id_col), non_empty(spec.id_col)]
    for c in spec.flags:
        rules += [not_null(c), coercible_integer(c), Rule("one_of", c, _zero_or_one)]
    for c in spec.int_numeric:
        rules += [not_null(c), coercible_integer(c), in_range(c, *spec.raw_bounds[c])]
    for c in spec.float_numeric:
        rules += [not_null(c), coercible_number(c), in_range(c, *spec.raw_bounds[c])]
    rules += [number_or_blank(c) for c in spec.text_numeric]
    for c in (*spec.categorical, spec.label_col):
        rules += [not_null(c), one_of(c, spec.domains[c])]
    return rules


def _zero_or_one(c: Column) -> Column:
    return to_number(c).isin(0.0, 1.0)


def scoring_contract(spec: TabularSpec, refuse_text: bool = False) -> list[Rule]:
    """Model inputs: categories must be present but may be new, bounds are wide.

    Numbers kept as text are coerced first: what is blank or no number is missing, which the
    model imputes, unless ``refuse_text`` makes it a violation.
    """
    rules: list[Rule] = []
    for c in spec.flags:
        rules += [not_null(c), coercible_integer(c), Rule("one_of", c, _zero_or_one)]
    for c in spec.int_numeric:
        rules += [not_null(c), coercible_integer(c), in_range(c, *spec.scoring_bounds[c])]
    for c in spec.float_numeric:
        rules += [not_null(c), coercible_number(c), in_range(c, *spec.scoring_bounds[c])]
    for c in spec.text_numeric:
        rules += [coercible_number(c)] if refuse_text else []
        rules.append(in_range(c, *spec.scoring_bounds[c]))
    rules += [not_null(c) for c in spec.categorical]
    return rules


def request_contract(spec: TabularSpec, id_col: str = "customer_id") -> list[Rule]:
    """Edge contract: closed domains, wide bounds, short ids."""
    return [
        *scoring_contract(spec, refuse_text=True),
        *[one_of(c, spec.domains[c]) for c in spec.categorical],
        max_length(id_col, MAX_ID_LENGTH),
    ]


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Contract projection: fixed columns in fixed order, or an error naming what is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")
    return df.select(*columns)


def _check_columns(df: DataFrame, rules: Sequence[Rule]) -> None:
    missing = sorted({r.column for r in rules if r.column not in df.columns})
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")


def _broken_cells(rules: Sequence[Rule]) -> Column:
    cells = [
        F.when(
            r.broken(),
            F.struct(
                F.lit(r.column).alias("column"),
                F.lit(r.name).alias("rule"),
                F.col(r.column).cast("string").alias("value"),
            ),
        )
        for r in rules
    ]
    return F.array_compact(F.array(*cells))


def violations(df: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """Every broken rule of every row as (key, column, rule, value), one pass, no shuffle."""
    _check_columns(df, rules)
    return df.select(F.col(key), F.inline(_broken_cells(rules)))


def unique_violations(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once, in the same long form.

    Counts are combined before the shuffle, and only repeated keys meet their rows again, so
    a key that fills a third of the table is not gathered by a window.
    """
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_")).filter(F.col("n_") > 1)
    return df.select(key).join(repeated.select(key), key, "left_semi").select(
        key,
        F.lit(key).alias("column"),
        F.lit("unique").alias("rule"),
        F.col(key).cast("string").alias("value"),
    )


def violation_summary(report: DataFrame) -> DataFrame:
    return report.groupBy("column", "rule").agg(F.count(F.lit(1)).alias("n"))


def top_violations(report: DataFrame, key: str, n: int = TOP_VIOLATIONS) -> DataFrame:
    return report.orderBy(key, "column", "rule").limit(n)


def with_verdict(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``ok`` and ``error`` (NULL when ok) to every row in the same pass."""
    _check_columns(df, rules)
    messages = [F.when(r.broken(), F.lit(f"{r.column}: {r.name}")) for r in rules]
    text = F.concat_ws("; ", *messages)
    return df.withColumn("error", F.when(F.length(text) > 0, text)).withColumn(
        "ok", F.col("error").isNull()
    )


def accept_and_quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows fit for scoring, and the others with their errors."""
    judged = with_verdict(df, rules)
    return judged.filter("ok").drop("ok", "error"), judged.filter("not ok").drop("ok")


def require_valid(df: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """Fail-fast form for batch jobs: one count, an error if anything is broken."""
    n = violations(df, rules, key).count()
    if n:
        raise ContractViolationError(f"contract broken ({n} violations)")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("empty input: at least one record is required")
    return df


def unknown_keys(json_col: Column, allowed: Sequence[str]) -> Column:
    """Keys of a JSON object outside the allowed set, as an array."""
    keys = F.map_keys(F.from_json(json_col, "map<string,string>"))
    return F.array_except(keys, F.array(*[F.lit(a) for a in allowed]))
