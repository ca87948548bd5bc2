import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm.connected import components, local_components
from tallyloom.llm.signature_join import SignatureTree, linked_documents, one_of_each, parts_of, size_classes
from tallyloom.llm.substring_dedup import duplicate_spans

WORD = r"[^\x20\x09-\x0D]+"


def plain_spans(rows, window=13):
    first, out = {}, []
    known = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    for i, text in known:
        words = re.findall(WORD, text or "")
        for k in range(len(words) - window + 1):
            first.setdefault(tuple(words[k : k + window]), i)
    for i, text in rows:
        words, gone = re.findall(WORD, text or ""), set()
        if i is not None:
            for k in range(len(words) - window + 1):
                if first[tuple(words[k : k + window])] < i:
                    gone |= set(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((repr(i), len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_spans_equal_brute_force(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    found = duplicate_spans(edge_docs).collect()
    got = sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in found)
    assert got == plain_spans(rows)
    assert sum(r.n_removed for r in found) > 100
    for r in found:
        assert sum(s.length for s in r.spans) == r.n_removed and all(s.length >= 13 for s in r.spans)
    assert duplicate_spans(no_docs).count() == 0


def shingles(text, size):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def plain_components(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    lowest = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            lowest[find(k)] = min(i, lowest.get(find(k), i))
    return sorted((repr(i), len(s), repr(lowest.get(find(k)))) for k, (i, s) in enumerate(sets))


@pytest.fixture(scope="module")
def near_docs(spark, edge_docs):
    """Edge rows and chains of documents that change a little from one to the next."""
    rng = random.Random(8)
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    for c in range(6):
        words = [f"c{c}v{i}" for i in range(rng.choice([6, 9, 30, 90]))]
        for k in range(9):
            words = list(words)
            words[rng.randrange(len(words))] = f"z{c}_{k}"
            rows.append((1000 + c * 20 + rng.randrange(15), " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows


@pytest.mark.parametrize("size,percent,chunk", [(4, 85, 3000), (5, 80, 2), (3, 50, 3)])
def test_components_equal_brute_force(near_docs, size, percent, chunk):
    docs, rows = near_docs
    got = linked_documents(docs, size, percent, chunk).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == plain_components(
        rows, size, percent
    )


def test_one_of_each_keeps_first_rows(edge_docs, no_docs):
    kept = one_of_each(edge_docs, 5, 80)
    assert kept.columns == edge_docs.columns
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    firsts = {(i, c) for i, n, c in plain_components(rows, 5, 80) if n and i == c and i != "None"}
    free = [r for r in rows if r[0] is None or not (r[1] or "").strip()]
    assert kept.count() == len(firsts) + len(free)
    assert one_of_each(no_docs).count() == 0 and linked_documents(no_docs).count() == 0


def test_tree_equals_all_pairs():
    rng = np.random.default_rng(2)
    base = [np.sort(rng.choice(10_000, 60, replace=False)).astype(np.uint64) for _ in range(5)]
    sets = []
    for b in base:
        for _ in range(12):
            keep = b[rng.random(60) > 0.06]
            sets.append(np.unique(np.concatenate([keep, rng.choice(10**6, 3).astype(np.uint64)])))
    sets = list({s.tobytes(): s for s in sets}.values())
    tree = SignatureTree(sets, 80)
    edges = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    ]
    a, b = np.array(edges).T
    assert tree.roots() == local_components(len(sets), a, b).tolist()


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_size_classes_hold_linked_sizes(percent):
    bounds = size_classes(400, percent)
    of = lambda n: int(np.searchsorted(bounds, n, "right")) - 1
    for small in range(1, 300):
        for large in range(small, min(400, small * 100 // percent) + 1):
            assert of(large) - of(small) in (0, 1)
    parts, spare = parts_of(np.array([1, 7, 100]), percent)
    assert (parts > spare).all()


def test_components_of_a_table(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500 + i, 501 + i) for i in range(60)]
    found = components(spark.createDataFrame(edges, "u long, v long"), "test")
    parent = defaultdict(lambda: None)
    nodes = sorted({n for e in edges for n in e if e[0] != e[1]})
    place = {n: i for i, n in enumerate(nodes)}
    real = [(place[a], place[b]) for a, b in edges if a != b]
    label = local_components(len(nodes), *np.array(real).T)
    assert parent is not None
    assert {(r.node, r.component) for r in found.collect()} == {(n, nodes[label[place[n]]]) for n in nodes}
    assert found.groupBy("node").count().filter(F.col("count") > 1).count() == 0


def test_one_of_each_with_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, 7, 8, 9), (2, text + " more", 7, 8, 9), (3, "other words here that stand alone", 7, 8, 9), (4, None, 7, 8, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id long, keep_node long, set_node long")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
