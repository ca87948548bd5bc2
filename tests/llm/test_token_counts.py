import json
import random

import public_tokenizers
import pytest

from tallyloom.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(path=PATH):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def test_equals_the_library_on_edge_cases(spark, edge_docs):
    tokenizer = library()
    got = token_counts.token_counts(edge_docs, PATH).collect()
    rows = edge_docs.select("doc_id", "text").collect()
    want = [
        (r.doc_id, len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False).ids))
        for r in rows
    ]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty_table(no_docs):
    assert token_counts.token_counts(no_docs, PATH).count() == 0


@pytest.mark.parametrize("size", [1, 3, 16])
def test_cuts_change_nothing(size):
    tokenizer = library()
    rng = random.Random(size)
    alphabet = ["a", "Zé", "7", "'", "s", "'re", " ", "  ", "\n", "\n\n", "\t", "　", "\x1c", "<|endoftext|>", "!?", "日本"]
    for _ in range(400):
        text = "".join(rng.choices(alphabet, k=rng.randrange(30)))
        cut = token_counts.pieces(text, size)
        assert "".join(cut) == text
        whole = tokenizer.encode(text, add_special_tokens=False).ids
        assert [i for c in cut for i in tokenizer.encode(c, add_special_tokens=False).ids] == whole


def test_long_texts_and_special_strings():
    counter, tokenizer = token_counts.Counter(PATH), library()
    texts = ["word " * 30_000, "x" * 100_000, "a<|endoftext|>b" * 5_000, "one\ntwo " * 9_000, ""]
    assert counter.cut
    assert counter.counts(texts).tolist() == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_tokenizers_that_look_further_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    counter = token_counts.Counter(path)
    assert not counter.cut
    text = "Some Words, and MORE " * 2_000
    assert counter.counts([text]).tolist() == [len(library(path).encode(text, add_special_tokens=False).ids)]
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"][0]["lstrip"] = True
    assert not token_counts.may_cut(spec)


def test_sentencepiece_model():
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    texts = ["", "one two", "Ünd <s> " * 500]
    assert token_counts.Counter(path).counts(texts).tolist() == [len(model.encode(t)) for t in texts]


def test_query_covers_every_document(spark, folder):
    from tallyloom.llm.queries import QUERIES

    tokenizer = library()
    got = {r.doc_id: r for r in QUERIES["op13_token_counts"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (n, n > 512)
