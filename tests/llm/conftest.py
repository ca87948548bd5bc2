import random

import pytest


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null and empty texts, null ids, repeated rows, ties, a long text, columns of clashing names."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["the", "The", "of", "é", "ünd"]
    passage = " ".join(rng.choices(words, k=60))
    base = [" ".join(rng.choices(words, k=80)) for _ in range(12)]
    texts = [None, "", " \n\t ", "one", "one two three", "a" * 5000, " ".join(rng.choices(words, k=30_000))]
    texts += base
    texts += [f"{base[0]} {passage}", f"{passage}\n{base[1]} tail", base[2], base[2].upper(), base[3] + " more"]
    texts += [base[4].replace("w1", "x1", 1), "\n".join(["same line again"] * 40)]
    rows = [(i, t, f"n{i % 3}", "s", 0, i) for i, t in enumerate(texts)]
    rows += [(3, "one", "n", "s", 0, 1)] * 2 + [(None, base[5], "n", "s", 0, 1), (None, None, "n", "s", 0, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, node long"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame([], schema)


@pytest.fixture(scope="session")
def some_labels(spark):
    rows = [(i, i % 2, int(i % 5 == 0)) for i in range(26)] + [(3, None, None), (None, 1, 1), (4, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
