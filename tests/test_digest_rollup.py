import datetime
import math
import random

from pyspark.sql import functions as F

from tallyloom.operators.digest import table_digest
from tallyloom.operators.rollup import exact_percentiles, request_rollup


def digest(df, **kwargs):
    return table_digest(df, **kwargs).first()["digest"]


def test_digest_tells_rows_not_their_order(spark):
    rows = [(i, f"t{i % 7}", None if i % 5 else i / 3, bytes([i % 9]), [i]) for i in range(200)]
    schema = "i int, t string, x double, b binary, a array<int>"
    first = digest(spark.createDataFrame(rows, schema))
    mixed = list(rows)
    random.Random(1).shuffle(mixed)
    assert digest(spark.createDataFrame(mixed, schema).repartition(5)) == first
    changed = [*rows[:-1], (*rows[-1][:2], 0.5, *rows[-1][3:])]
    for other in (changed, [*rows, rows[0]], rows[1:], [*rows[1:], rows[1]], []):
        assert digest(spark.createDataFrame(other, schema)) != first
    # values do not run together, and NULL is not a text
    pairs = [[("ab", "c")], [("a", "bc")], [("-", None)], [(None, "-")], [("", None)], [(None, None)]]
    assert len({digest(spark.createDataFrame(p, "a string, b string")) for p in pairs}) == len(pairs)
    df = spark.createDataFrame(rows, schema)
    by = {r["t"]: (r["n_rows"], r["digest"]) for r in table_digest(df, ["i"], ["t"]).collect()}
    assert len(by) == 7 and by["t3"] == (
        df.filter("t = 't3'").count(), digest(df.filter("t = 't3'"), columns=["i"]))


def nearest(values, percent):
    return sorted(values)[max(0, -(-len(values) * percent // 100) - 1)]


def test_percentiles_of_a_group_with_many_values(spark):
    rng = random.Random(5)
    groups = {"hot": [rng.random() for _ in range(30_000)], None: [3.0, 1.0, 2.0], "one": [7.5],
              "tied": [1.0] * 5000 + [2.0] * 263, "none": [None, math.nan]}
    rows = [(g, x) for g, xs in groups.items() for x in xs]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: (r["p50"], r["p95"], r["p100"])
           for r in exact_percentiles(df, ["g"], "x", (50, 95, 100)).collect()}
    want = {g: tuple(nearest(xs, p) for p in (50, 95, 100)) for g, xs in groups.items() if g != "none"}
    assert got == want


def test_rollup_keeps_groups_without_latency(spark):
    day = datetime.datetime(2024, 1, 1)
    rows = [(day, "a", 1.0, True), (day, "a", 3.0, False), (day, None, 2.0, False), (None, "b", None, True)]
    df = spark.createDataFrame(rows, "t timestamp, p string, ms double, bad boolean")
    got = {(r["window_start"], r["path"]): tuple(r)[2:]
           for r in request_rollup(df, F.col("t"), "p", F.col("bad"), "ms").collect()}
    assert got == {(day, "a"): (2, 0.5, 1.0, 3.0), (day, None): (1, 0.0, 2.0, 2.0),
                   (None, "b"): (1, 1.0, None, None)}
    assert request_rollup(df.filter("false"), F.col("t"), "p", F.col("bad"), "ms").count() == 0
