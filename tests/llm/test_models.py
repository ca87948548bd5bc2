import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import pu_quality, quality_rules, toxicity, url_filter
from tallyloom.llm.common import held_out
from tallyloom.sources.tables import table

BIG = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, BIG, "documents"), table(spark, BIG, "labels")
    model = toxicity.fit_toxicity(docs, labels)
    rows = toxicity.toxicity_scores(docs, model).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    wrong = sum((r.score >= 0.5) != bool(r.toxic) for r in rows)
    assert len(rows) > 50 and wrong <= 0.1 * len(rows)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == toxicity.toxicity_scores(docs, model).filter("score < 0.5").count()


def test_toxicity_without_labels(spark, edge_docs, no_docs, some_labels):
    none = some_labels.filter("false")
    assert toxicity.fit_toxicity(edge_docs, none).intercept == 0
    one_sided = toxicity.fit_toxicity(edge_docs, some_labels.filter("toxic = 0"))
    assert toxicity.toxicity_scores(edge_docs, one_sided).filter("score >= 0.5").count() == 0
    model = toxicity.fit_toxicity(edge_docs, some_labels)
    rows = toxicity.toxicity_scores(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity_scores(no_docs, model).count() == 0


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, BIG, "documents"), table(spark, BIG, "labels")
    rows = pu_quality.quality_scores(docs, labels).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.9
    assert (good >= 0.3).mean() > 0.95


def test_quality_of_edge_rows(spark, edge_docs, no_docs, some_labels):
    rows = pu_quality.quality_scores(edge_docs, some_labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    blind = pu_quality.quality_scores(edge_docs, some_labels.filter("false")).collect()
    assert {r.score for r in blind} == {0.5}
    assert pu_quality.quality_scores(no_docs, some_labels).count() == 0


def test_features_do_not_depend_on_neighbours():
    texts = ["A b!\nc", None, "x x x x x x", "", "word### word|"]
    together = pu_quality.text_features(pa.array(texts))
    for i, t in enumerate(texts):
        alone = pu_quality.text_features(pa.array([t], pa.string()))
        assert np.array_equal(together[i], alone[0])


@pytest.mark.parametrize("n,k", [(10, 0), (10, 1), (50, 2), (400, 3), (3000, 20), (3000, 29), (5, 4)])
def test_binomial_sum_is_exact(spark, n, k):
    rate = 0.01
    got = spark.range(1).select(
        quality_rules.at_most(F.lit(k).cast("long"), F.lit(n).cast("long"), rate).alias("p")
    ).first().p
    exact = sum(math.comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1))
    assert got == pytest.approx(1.0 if k >= n * rate else exact, rel=1e-9)


def test_rules_on_edge_rows(spark, edge_docs, no_docs, some_labels):
    rows = quality_rules.quality_verdicts(edge_docs, some_labels).collect()
    assert len(rows) == edge_docs.count()
    repeated = [r for r in rows if r.n_words == 120]
    assert repeated and all(r.n_repeat_words == 120 and r.n_dup_lines == 39 and r.base_failed for r in repeated)
    empty = [r for r in rows if r.n_words == 0]
    assert len(empty) == 4 and all(r.base_failed and not r.kept for r in empty)
    assert quality_rules.quality_verdicts(no_docs, some_labels).count() == 0


def plain_chance(k, n, rate):
    """Of a binomial count of k or less, in whole numbers and fractions."""
    from fractions import Fraction
    from math import comb

    p = Fraction(rate).limit_denominator(10_000)
    return float(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def test_cutoffs_are_those_that_pass_exact_tests(spark):
    from zlib import crc32

    rules = quality_rules.RULES
    rate = quality_rules.RATE / len(rules)
    level = quality_rules.LEVEL / (len(quality_rules.STRATA) * sum(map(len, rules.values())))
    held = lambda i: crc32(str(i).encode()) % 5 == 0
    sizes = {0: 1000, 1: 700, 2: 1600}  # no cutoff can pass in stratum 1, and stratum 3 is empty
    most = {s: max((k for k in range(9) if plain_chance(k, n, rate) <= level), default=-1) for s, n in sizes.items()}
    assert most[0] >= 0 and most[1] == -1 and most[2] > most[0]
    rows, i = [], 0
    for s, n in sizes.items():
        for j in range(n):
            while held(i):
                i += 1
            k = max(most[s], 0)
            rows.append((i, s, False, {
                "symbols": 1000 if j <= k else 0,  # one too many at every cutoff
                "dup_lines": 200,  # equal to a cutoff, which does not reject
                "repeats": 21 if j < k else 20,  # as many as may be at the lowest
                "word_length": 81 if j < k else 71 if j == k else 70,  # one too many at the lowest
                "capitals": 0,
            }))
            i += 1
    good = [r[0] for r in rows]
    worst = dict.fromkeys(rules, 10_000)
    bad = range(i, i + 900)
    rows += [(b, s, False, worst) for b in bad for s in sizes]
    base, several = i + 1000, i + 1001
    rows += [(good[0], 0, True, worst)] * 50 + [(several, 0, False, worst)] * 50 + [(None, 0, False, worst)] * 50
    labels = [(g, 1) for g in good] + [(b, 0) for b in bad if b % 2] + [(b, 1) for b in bad if held(b)]
    labels += [(several, 1), (several, 0), (None, 1), (base, None)]
    measured = spark.createDataFrame(
        [(d, s, f, *[m[r] for r in rules]) for d, s, f, m in rows],
        "doc_id long, stratum int, base_failed boolean, " + ", ".join(f"{r} long" for r in rules),
    )
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {(c.stratum, c.rule): (c.cutoff, c.n, c.rejected) for c in quality_rules.safe_cutoffs(measured, table).collect()}
    want = {}
    for s, n in sizes.items():
        mine = [m for d, t, f, m in rows if t == s and not f and d in set(good)]
        assert len(mine) == n
        for rule, cutoffs in rules.items():
            for c in cutoffs:
                k = sum(m[rule] > c for m in mine)
                if plain_chance(k, n, rate) <= level:
                    want[s, rule] = (c, n, k)
                    break
    assert got == want
    assert {r for s, r in want if s == 0} == {"dup_lines", "repeats", "word_length", "capitals"}
    assert want[0, "repeats"][0] == 20 and want[0, "word_length"][0] == 80 and want[0, "dup_lines"][0] == 200
    assert quality_rules.safe_cutoffs(measured, table.filter("false")).count() == 0


def test_url_rules(spark):
    cases = {
        "http://a.com/x?y": ("a.com", "/x", "com/", "allow"),
        "http://Example.COM/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
        "http://b.www.example.com/en/": ("b.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://x.net/fr/#a://b": ("x.net", "/fr/", "net/fr/", "block"),
        "http://com": ("com", "", None, None),
        "x://y.com?q=/": ("y.com", "", None, None),
        "no host": ("", "", None, None),
        None: ("", "", None, None),
        "a\n://z.org/\n/p": ("z.org", "/\n/p", None, None),
    }
    rows = [(i, u, "x", "y") for i, u in enumerate(cases)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, shape string, gram string")
    got = url_filter.url_verdicts(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = list(cases.values())[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert url_filter.url_verdicts(pages.filter("false")).count() == 0


def test_url_filter_is_native(spark, folder):
    plan = url_filter.url_verdicts(table(spark, folder, "pages"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_url_scores(urls, decided):
    """The scores of ``url_verdicts`` by plain counting over every row."""
    from zlib import crc32

    def steps(u):
        t = f"^{u}$"
        return [t[max(0, i - url_filter.ORDER) : i + 1] for i in range(1, len(t))]

    counts = {"allow": {}, "block": {}}
    for u, d in zip(urls, decided):
        if d and crc32(u.encode()) % 5:
            for g in steps(u):
                for own in (g[-k - 1 :] for k in range(url_filter.ORDER + 1) if len(g) > k):
                    counts[d][own] = counts[d].get(own, 0) + 1
    around = {}
    for d, seen in counts.items():
        around[d] = {}
        for own, n in seen.items():
            around[d][own[:-1]] = around[d].get(own[:-1], 0) + n

    def chance(g, d):
        p = url_filter.UNIFORM
        for own in (g[-k - 1 :] for k in range(url_filter.ORDER + 1) if len(g) > k):
            p = (counts[d].get(own, 0) + url_filter.SMOOTHING * p) / (around[d].get(own[:-1], 0) + url_filter.SMOOTHING)
        return p

    return {
        u: np.mean([math.log(chance(g, "allow")) - math.log(chance(g, "block")) for g in steps(u)])
        for u, d in zip(urls, decided)
        if not d
    }


def test_url_scores_use_whole_urls_of_all_pages(spark):
    allowed = [f"http://a{i}.com/p?good={i}" for i in range(9)] + ["http://often.com/?x=7"] * 40
    blocked = [f"http://b{i}.net/fr/q#bad-{i}" for i in range(9)]
    other = ["http://c.org/p?good=1", "http://c.org/p?bad-9", "http://c.org/p?x=7", "good=1", "bad-9", "http://c.org/p?x=8"]
    urls = allowed + blocked + other
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {urls[r.page_id]: r.score for r in url_filter.url_verdicts(pages).collect() if r.rule is None}
    want = plain_url_scores(urls, ["allow"] * len(allowed) + ["block"] * len(blocked) + [None] * len(other))
    assert got == pytest.approx(want, rel=1e-9)
    assert len(set(got.values())) == len(other)
    assert got["http://c.org/p?good=1"] > got["http://c.org/p?bad-9"] and got["good=1"] > got["bad-9"]
