import random
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate
from tallyloom.llm.secret_scan import BASE62, KINDS, checksum62, find_spans, mask_secrets, secret_spans

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_base(text):
    found = []
    for m in re.finditer(
        r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text
    ):
        if len(m[2]) >= 8:
            found.append((m.start(), m.end(), "assign"))
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def test_base_spans_equal_a_scan_of_the_whole_text():
    rng = random.Random(3)
    bits = ["password", "Token", "api_key", "APIKEY", "secret", "=", ": ", "'", '"', " ", "é", "日", "AKIA", "akia"]
    bits += ["deadbeef" * 3, "0123456789abcdef", "ABCDEF123456", "abcdefgh", "x", "\n", "=abcd1234"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        assert [s for s in find_spans(text) if s[2] in ("assign", "access", "hex")] == plain_base(text)


def test_vendor_tokens_need_their_checksum():
    part = (BASE62 * 2)[5:35]
    good = f"x ghp_{part}{checksum62(part)} y npm_{part}{checksum62(part)}"
    assert [s[2] for s in find_spans(good)] == ["github", "npm"]
    assert find_spans(f"x ghp_{part}000000 y") == []


def test_spans_of_edge_rows(spark, edge_docs, no_docs):
    rows = secret_spans(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert secret_spans(no_docs).count() == 0
    assert all(r.spans.startswith("hex:0:") or not r.spans for r in rows)


def test_masking_leaves_other_text(spark):
    key = "0f" * 20
    docs = spark.createDataFrame([(1, f'a token = "{key}" b'), (2, None), (3, "clean")], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in mask_secrets(docs).collect()}
    assert rows == {1: 'a [SECRET]" b', 2: None, 3: "clean"}


def plain_contamination(docs, items, window=10):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    windows = {}
    for name, text in items:
        words = re.findall(WORD, lower(text))
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(name))
    out = []
    for _, text in docs:
        words, hit, names = re.findall(WORD, lower(text)), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    names |= found
        out.append((len(words), len(hit), sorted(names - {"None"})))
    return out


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 300])
def test_contamination_equals_brute_force(spark, edge_docs, block_bytes):
    texts = [(r.doc_id, r.text) for r in edge_docs.collect()]
    words = [t for _, t in texts if t and len(t.split()) > 60]
    items = [(i, " ".join(w.split()[5 * i : 5 * i + 14])) for i, w in enumerate(words[:9])]
    items += [(50, "One, TWO three!"), (51, ""), (52, None), (53, "nowhere to be found at all"), (1, "same line again")]
    # an item without id counts, an item that comes twice is one
    items += [(None, "one"), (50, "One, TWO three!"), (None, "one")]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.verbatim_matches(edge_docs, table, block_bytes=block_bytes)
    rows = found.select("doc_id", "text", "n_words", "matches").collect()
    got = sorted(
        (
            repr((r.doc_id, r.text)),
            r.n_words,
            len({k for m in r.matches for k in range(m.start, m.start + m.length)}),
            sorted({m["item"] for m in r.matches} - {None}),
        )
        for r in rows
    )
    expected = plain_contamination(texts, [i for i in items if i[1] is not None])
    assert got == sorted((repr(t), *e) for t, e in zip(texts, expected))
    kept = decontaminate.drop_contaminated(edge_docs, table)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(not e[1] for e in expected)
    counts = decontaminate.contamination(edge_docs, table).select("n_words", "n_hit", "items").collect()
    assert sorted(map(repr, map(tuple, counts))) == sorted(map(repr, expected))


def test_longest_match_and_places(spark):
    item = " ".join(f"q{i}" for i in range(25))
    doc = "before " + " ".join(f"Q{i}" for i in range(3, 21)) + " after"
    docs = spark.createDataFrame([(1, doc)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    (m,) = decontaminate.verbatim_matches(docs, items).select(F.explode("matches").alias("m")).select("m.*").collect()
    assert (m.start, m.length, m.item, m.item_start) == (1, 18, "7", 3)


def test_without_benchmark_or_documents(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(edge_docs, none).filter("n_hit > 0").count() == 0
    assert decontaminate.drop_contaminated(edge_docs, none).count() == edge_docs.count()
    one = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(no_docs, one).count() == 0
