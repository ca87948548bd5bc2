"""Deterministic splits, folds and samples keyed by a seeded hash of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import hash_number, seeded_hash
from tallyloom.operators.ordering import bucketed_row_number

# Test share, validation share of the remainder, number of folds, seed.
TEST_SHARE = 0.15
VALIDATION_SHARE = 0.1765
FOLDS = 5
SEED = 42
_SCALE = 1_000_000


class DuplicateKeyError(ValueError):
    """The id column is not unique, so rows of one id could land in several splits."""


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Ids that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    if not duplicate_keys(df, key).isEmpty():
        raise DuplicateKeyError(f"duplicate values in {key}; refusing to split")
    return df


def with_stratum_rank(
    df: DataFrame, key: str, stratum: str | None, seed: int = SEED, prefix_digits: int = 3
) -> DataFrame:
    """Adds the 1-based hash rank inside the stratum and the stratum size.

    Hash prefixes are uniform whatever the ids look like, so each stratum is cut into
    ``16 ** prefix_digits`` even pieces that are ordered in parallel.
    """
    keyed = df.withColumn("hash_", seeded_hash(seed, F.col(key))).withColumn(
        "prefix_", hash_number(F.col("hash_"), prefix_digits)
    )
    if stratum is None:
        keyed = keyed.withColumn("stratum_", F.lit("all"))
    else:
        keyed = keyed.withColumn(
            "stratum_", F.coalesce(F.col(stratum).cast("string"), F.lit("missing"))
        )
    return bucketed_row_number(
        keyed, ["stratum_"], "prefix_", ["hash_", key], "rank_", total="size_"
    ).drop("hash_", "prefix_")


def _named_split(rank: Column, n_test: Column, n_validation: Column) -> Column:
    return (
        F.when(rank <= n_test, "test")
        .when(rank <= n_test + n_validation, "validation")
        .otherwise("train")
    )


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    test_share: float = TEST_SHARE,
    validation_share: float = VALIDATION_SHARE,
    seed: int = SEED,
    stratify: bool = True,
    check_unique: bool = True,
) -> DataFrame:
    """Adds ``split``; sizes per class are the rounded shares of that class."""
    if check_unique:
        require_unique(df, key)
    ranked = with_stratum_rank(df, key, label if stratify else None, seed)
    size = F.col("size_")
    n_test = F.floor(size * test_share + 0.5)
    n_validation = F.floor((size - n_test) * validation_share + 0.5)
    return ranked.withColumn("split", _named_split(F.col("rank_"), n_test, n_validation)).drop(
        "rank_", "size_", "stratum_"
    )


def hash_split(
    df: DataFrame,
    key: str,
    test_share: float = TEST_SHARE,
    validation_share: float = VALIDATION_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Adds ``split`` from the id hash alone: no shuffle, and stable as the table grows.

    Sizes follow the shares only approximately.
    """
    point = hash_number(seeded_hash(seed, F.col(key))) % _SCALE
    cut = round(test_share * _SCALE)
    second = cut + round(validation_share * (_SCALE - cut))
    return df.withColumn(
        "split",
        F.when(point < cut, "test").when(point < second, "validation").otherwise("train"),
    )


def kfold(
    df: DataFrame, key: str, label: str | None, k: int = FOLDS, seed: int = SEED
) -> DataFrame:
    """Adds a stratified fold number 0 ... k-1."""
    ranked = with_stratum_rank(df, key, label, seed)
    return ranked.withColumn("fold", (F.col("rank_") % k).cast("int")).drop(
        "rank_", "size_", "stratum_"
    )


def assignments(split: DataFrame, key: str) -> DataFrame:
    return split.select(key, "split")


def union_assignments(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """UNION ALL of separately kept splits into one (id, split) map."""
    named = [df.select(key, F.lit(name).alias("split")) for name, df in parts.items()]
    out = named[0]
    for part in named[1:]:
        out = out.unionByName(part)
    return out


def join_assignments(df: DataFrame, assigned: DataFrame, key: str) -> DataFrame:
    """Attach a stored assignment map to its table."""
    return df.join(assigned.select(key, "split"), key)


def split_overlap(assigned: DataFrame, key: str) -> DataFrame:
    """Ids found in more than one split (empty when the splits are disjoint)."""
    return (
        assigned.groupBy(key)
        .agg(F.min("split").alias("first_split"), F.max("split").alias("last_split"))
        .filter(F.col("first_split") != F.col("last_split"))
    )


def split_balance(split: DataFrame, label: str, positive: str) -> DataFrame:
    """Size and positive rate of every split."""
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(label).eqNullSafe(F.lit(positive)).cast("double")).alias("positive_rate"),
    )


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """Exactly n rows (or all, if fewer) without replacement; every task keeps only its top n."""
    return (
        df.withColumn("hash_", seeded_hash(seed, F.col(key)))
        .orderBy("hash_", key)
        .limit(n)
        .drop("hash_")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (classes * n_class) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("classes"))
    row = totals.first()
    return counts.withColumn(
        "weight", F.lit(float(row["n_all"] or 0)) / (F.lit(row["classes"]) * F.col("n"))
    )
