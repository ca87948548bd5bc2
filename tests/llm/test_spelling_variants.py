import random
import re
import zlib
from collections import Counter

import pytest

from tallyloom.llm import spelling_variants as V
from tallyloom.llm.queries import QUERIES


def plain_words(rows, every):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc}:{word}".encode())
            if every and doc is not None and h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words):
    letters = {c for v in words for c in v}

    def ones(w):
        around = {w[:i] + w[i + 1 :] for i in range(len(w))}
        around |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        around |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        return [v for v in around - {w} if v in words]

    form, near = {}, {}
    for w, n in words.items():
        found = ones(w)
        near[w] = len(found)
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, near[w], words[form[w]] if form[w] else None))
    return sorted(map(repr, out))


def of(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("ranges", ["1", "3", "7"])
def test_equals_brute_force_over_any_number_of_ranges(spark, ranges):
    rng = random.Random(int(ranges))
    stems = ["aaaaaaaa", "abababab", "aabbaabb", "straßen", "édition", "connection", "x" * 60]
    words = Counter()
    for _ in range(900):
        w = list(rng.choice(stems))
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(w))
            w[i : i + rng.randrange(2)] = rng.choice(["", "a", "b", "é", "ß"])
        words["".join(w)] += rng.choice([1, 1, 2, 30, 400])
    words = {w: n for w, n in words.items() if len(w) >= 7}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        table = spark.createDataFrame([(w, n) for w, n in words.items()], "word string, n long").repartition(3)
        assert of(V.variant_groups(table)) == plain_groups(words)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_very_long_words(spark):
    words = {"x" * 4000: 50, "x" * 3999: 2, "x" * 2000 + "y" + "x" * 1999: 3}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.n: r for r in V.variant_groups(table).collect()}
    assert [got[n].n_near for n in (50, 2, 3)] == [2, 2, 2] and got[2].form_n == got[3].form_n == 50


def test_chains_of_forms_and_ties(spark):
    words = {"kitchens": 4000, "kitchen": 300, "kitchan": 20, "kitchon": 2, "kitchin": 2, "mountain": 5, "mountaim": 5}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: r for r in V.variant_groups(table).collect()}
    assert of(V.variant_groups(table)) == plain_groups(words)
    assert got["kitchon"].root == "kitchens" and got["kitchon"].form == "kitchen"
    assert got["mountain"].form is None and got["mountain"].n_near == 1


@pytest.mark.parametrize("every", [None, 3])
def test_words_of_edge_documents(spark, edge_docs, every):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()] + [(50, "STRASSEN×ÿx strassenĀstrassen " * 3)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r.n for r in V.word_counts(more, every=every).collect()}
    assert got == plain_words(rows, every)


def test_empty_table(spark, no_docs):
    words = V.word_counts(no_docs, every=31)
    assert words.count() == 0 and V.variant_groups(words).count() == 0


def test_near_relation_itself():
    assert one_apart("abc", "abd") and one_apart("abc", "ab") and not one_apart("abc", "abc")


def test_query_on_the_tables(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert of(QUERIES["op11_spelling_variants"](spark, folder)) == plain_groups(plain_words(rows, 31))
