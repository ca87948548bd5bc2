import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import ordering as O
from tallyloom.operators import splitting as S


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_quantiles_match_numpy(spark, buckets):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b"]), None if i % 17 == 0 else float(rng.choice([3, rng.random()])))
            for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    whole = [x for _, x in rows if x is not None]
    assert O.fitted_quantiles(df, ["x"], probs, buckets)["x"] == pytest.approx(
        list(np.quantile(whole, probs))
    )
    for r in O.exact_quantiles(df, ["x"], probs, ["g"], buckets).collect():
        part = [x for g, x in rows if g == r["g"] and x is not None]
        assert r["value"] == pytest.approx(np.quantile(part, r["prob"])) and r["n"] == len(part)


def test_quantiles_of_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(None, 2.0), (None, 2.0)], "e double, c double")
    assert O.fitted_quantiles(df, ["e", "c"], [0.0, 0.5, 1.0]) == {"e": [], "c": [2.0] * 3}


def test_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert O.fitted_quantiles(df, ["x"], [0.5])["x"] == [2.5]


def test_bucketed_row_number_equals_plain_rank(spark):
    df = spark.range(1000).select(
        (F.col("id") % 3).alias("g"), F.col("id"), (F.col("id") * 7919 % 1000).alias("v")
    ).withColumn("b", F.expr("v div 100"))
    ranked = O.bucketed_row_number(df, ["g"], "b", ["v"], "r", "n").collect()
    for g in range(3):
        mine = sorted((r["r"], r["v"]) for r in ranked if r["g"] == g)
        assert [r for r, _ in mine] == list(range(1, len(mine) + 1))
        assert [v for _, v in mine] == sorted(v for _, v in mine)
        assert {r["n"] for r in ranked if r["g"] == g} == {len(mine)}


def people(spark, n=2000):
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 4 == 0, "Yes").otherwise("No").alias("churn")
    )


def test_split_is_complete_disjoint_and_balanced(spark):
    split = S.stratified_split(people(spark), "id", "churn")
    assert split.count() == 2000 and split.select("id").distinct().count() == 2000
    assert S.split_overlap(split, "id").count() == 0
    rows = {r["split"]: r for r in S.split_balance(split, "churn", "Yes").collect()}
    assert rows["test"]["n"] == 300 and rows["validation"]["n"] == 300
    for r in rows.values():
        assert abs(r["positive_rate"] - 0.25) < 0.02


def test_split_is_repeatable_and_seeded(spark):
    df = people(spark)
    one = dict(S.stratified_split(df, "id", "churn").select("id", "split").collect())
    two = dict(
        S.stratified_split(df.repartition(7), "id", "churn").select("id", "split").collect()
    )
    other = dict(S.stratified_split(df, "id", "churn", seed=1).select("id", "split").collect())
    assert one == two and one != other


def test_duplicate_ids_are_refused(spark):
    df = people(spark, 10).unionByName(people(spark, 1))
    with pytest.raises(S.DuplicateKeyError):
        S.stratified_split(df, "id", "churn")


def test_unstratified_and_hash_splits(spark):
    df = people(spark)
    plain = S.stratified_split(df, "id", "churn", stratify=False)
    assert plain.filter("split = 'test'").count() == 300
    shares = dict(S.hash_split(df, "id").groupBy("split").count().collect())
    assert abs(shares["test"] / 2000 - 0.15) < 0.03 and sum(shares.values()) == 2000


def test_folds_differ_by_one_per_class(spark):
    counts = S.kfold(people(spark, 1003), "id", "churn").groupBy("churn", "fold").count().collect()
    for c in ("Yes", "No"):
        sizes = [r["count"] for r in counts if r["churn"] == c]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_assignments_union_and_join(spark):
    split = S.stratified_split(people(spark, 100), "id", "churn")
    parts = {s: split.filter(F.col("split") == s) for s in ("train", "validation", "test")}
    union = S.union_assignments(parts, "id")
    assert union.count() == 100
    assert S.join_assignments(people(spark, 100), union, "id").count() == 100
    torn = union.unionByName(union.limit(1).withColumn("split", F.lit("other")))
    assert S.split_overlap(torn, "id").count() == 1


def test_sample_and_weights(spark):
    df = people(spark, 100)
    sample = {r["id"] for r in S.seeded_sample(df, "id", 30).collect()}
    assert len(sample) == 30
    assert sample == {r["id"] for r in S.seeded_sample(df.repartition(5), "id", 30).collect()}
    assert S.seeded_sample(df, "id", 300).count() == 100
    weights = {r["churn"]: r["weight"] for r in S.class_weights(df, "churn").collect()}
    assert weights == {"Yes": pytest.approx(2.0), "No": pytest.approx(100 / 150)}
