import re

import numpy as np

import corpus_pipeline
from tallyloom.llm.secret_scan import find_spans


def test_stages_on_edge_rows(spark, edge_docs, no_docs, folder):
    for docs in (edge_docs.select(*corpus_pipeline.COLUMNS), no_docs):
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, docs, folder)
            if name == corpus_pipeline.STAGES[-1][0]:
                assert set(kept.columns) >= {"doc_id", "ids", "n_tokens"}
            else:
                assert kept.columns == corpus_pipeline.COLUMNS
            assert kept.count() <= docs.count()
    assert len(corpus_pipeline.STAGES) == 5


def test_run_keeps_what_each_rule_allows(spark, folder):
    result = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    documents = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    split = lambda t: re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t))
    windows = set()
    for item in items:
        words = split(item)
        size = min(10, len(words))
        windows |= {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
    assert 0 < len(result) < len(documents)
    own = __import__("tallyloom.llm.trie_bpe", fromlist=["TrieBpe"])
    bpe = own.TrieBpe(open(__import__("public_tokenizers").path("byte_bpe_50k.json"), encoding="utf-8").read())
    for i, r in result.items():
        words = split(documents[i])
        assert not any(tuple(words[k : k + n]) in windows for n in {len(w) for w in windows} for k in range(len(words) - n + 1))
        text = bpe.decode(np.frombuffer(r.ids, "<u4"))
        assert not find_spans(text)
        if not find_spans(documents[i]):
            assert text == documents[i]
