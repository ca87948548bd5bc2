import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import token_files
from tallyloom.llm.trie_bpe import TrieBpe, decode_documents, encode_documents, token_count

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_trie_equals_the_library_on_odd_text():
    rng = random.Random(1)
    bits = [*"abcAB 12  \n\t'.,!?%-—éßñ日本😀\u3000\u00a0\u0085\x1c\x00Σς"]
    bits += ["'s", "'ll", "<|endoftext|>", "the ", " The", "ing", "\r\n"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 50))) for _ in range(1500)]
    texts += ["", " ", "a" * 3000, "=" * 700, "\n\n  x", "deed " * 400]
    library, own = tokenizers.Tokenizer.from_file(BYTES), TrieBpe(open(BYTES, encoding="utf-8").read())
    for text, coded in zip(texts, own.encode_batch(texts)):
        ids = np.frombuffer(coded, "<u4")
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_kept_units_do_not_change_results(monkeypatch):
    texts = ["some words here", "other words there", "some words here"]
    first = TrieBpe(open(BYTES, encoding="utf-8").read()).encode_batch(texts)
    monkeypatch.setattr("tallyloom.llm.trie_bpe.KEPT_UNITS", 1)
    small = TrieBpe(open(BYTES, encoding="utf-8").read())
    assert [small.encode_batch([t])[0] for t in texts * 2] == first * 2
    monkeypatch.setattr("tallyloom.llm.token_files.KEPT_WORDS", 1)
    words = token_files.WordCodes(WORDS, wide=True)
    assert [words.ids([t])[0] for t in texts * 2] == token_files.WordCodes(WORDS, True).ids(texts * 2)


def test_units_are_kept_without_stops_and_lines_and_texts_stay_in_order():
    library, own = tokenizers.Tokenizer.from_file(BYTES), TrieBpe(open(BYTES, encoding="utf-8").read())
    own.encode_batch(["Some words, words. some\nwords", "words words,\nwords"])
    assert set(own._kept) == {"Some", " words", " some", "\nwords", "words", ".", ","}
    rng = random.Random(3)
    bits = ["\n", "\n", " ", " ", "\n\n", " \n", "\n ", "x", "É.", "ab,", "a.,", ".", "\x85", "\t", "<|endoftext|>", "٣", "ñ", "d's"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(9))) for _ in range(4000)] + [None, "", "\n", "\n\n\n", " a", "a ", "\na\n"]
    rng.shuffle(texts)
    for part in (texts, [], [None], texts[:1]):
        column = pa.array(part, pa.string())
        coded = own.encode_column(column)
        want = [library.encode(t or "", add_special_tokens=False).ids for t in part]
        assert [np.frombuffer(c, "<u4").tolist() for c in coded.to_pylist()] == want
        assert own.decode_batch(coded).to_pylist() == [t or "" for t in part]
    assert own.encode_column(pa.array(texts).slice(7, 50)).equals(own.encode_column(pa.array(texts)).slice(7, 50))


def test_decoding_of_parts_of_characters():
    library, own = tokenizers.Tokenizer.from_file(BYTES), TrieBpe(open(BYTES, encoding="utf-8").read())
    rng = random.Random(4)
    lists = [[rng.randrange(50257) for _ in range(rng.randrange(8))] for _ in range(500)]
    lists += [[rng.randrange(256) for _ in range(rng.randrange(8))] for _ in range(500)]
    coded = pa.array([np.array(i, "<u4").tobytes() for i in lists], pa.binary())
    want = [library.decode(i, skip_special_tokens=False) for i in lists]
    assert own.decode_batch(coded).to_pylist() == want
    assert own.decode_batch(coded.slice(400, 200)).to_pylist() == want[400:600]


def test_round_trip_of_edge_rows(edge_docs, no_docs):
    rows = decode_documents(encode_documents(edge_docs, BYTES), BYTES).withColumn("n", token_count()).collect()
    assert sorted((repr(r.doc_id), r.decoded) for r in rows) == sorted(
        (repr(r.doc_id), r.text or "") for r in edge_docs.collect()
    )
    assert all(r.n * 4 == len(r.ids) for r in rows)
    assert encode_documents(no_docs, BYTES).count() == 0


def test_files_hold_the_stream_in_order(spark, edge_docs, no_docs):
    files = token_files.write_tokens(edge_docs, WORDS, end_id=2, row=64)
    found = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_documents(spark, files).collect())
    library = tokenizers.Tokenizer.from_file(WORDS)
    rows = edge_docs.select("doc_id", "text").collect()
    expected = {}
    for r in rows:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    ids = [f[1] for f in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [f[0] for f in found] == np.cumsum([0] + [f[2] for f in found])[:-1].tolist()
    got = {}
    for _, i, n, crc in found:
        got.setdefault(i, []).append((n, crc))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in expected.items()}
    empty = token_files.write_tokens(no_docs, WORDS, end_id=2)
    assert token_files.read_documents(spark, empty).count() == 0


def test_rows_are_fixed_size_lists_without_copies(spark, edge_docs):
    files = token_files.write_tokens(edge_docs, WORDS, end_id=2, row=32)
    total = 0
    for _, name, before, docs in files.parts:
        part = token_files.PartReader(files.folder, name)
        assert part.file.schema.field("tokens").type == pa.list_(pa.uint16(), 32)
        assert before == total and len(part.docs) == docs
        for k in range(part.file.num_record_batches):
            tokens, mask, last = part.batch(k)
            assert tokens.base is not None and tokens.shape[1] == mask.shape[1] == 32
            assert not last[~mask].any()
            total += int(mask.sum())


def test_word_codes_equal_the_library_on_odd_words():
    codes, library = token_files.WordCodes(WORDS, True), tokenizers.Tokenizer.from_file(WORDS)
    parts = ["<|EndOfText|>", "<|STARTOFTEXT|>", "<|endoftext|>", "<|startoftext|>", "İ.", "İ", "é", "É.", "é,", "ß",
             "Don't", "'S", "STOP.", "a,b", "x1y", "...", "<|", "|>", "</w>", "ΑΣ.", "µ.", "ÿ,", "Ÿ", "\t", "\u3000", "word"]
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices(parts, k=rng.randrange(4))) for _ in range(rng.randrange(12))) for _ in range(500)]
    texts += [p + sep + q for p in parts for q in parts for sep in ("", " ", "\n", " \n ")]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [np.frombuffer(c, "<u4").tolist() for c in codes.ids(texts)] == want


def test_words_are_kept_once_whatever_their_case_and_stop():
    codes, library = token_files.WordCodes(WORDS, False), tokenizers.Tokenizer.from_file(WORDS)
    texts = ["Word word. WORD, wOrd word, word..", None, "", "ÀÉÖØÞ àéöøþ. ÀÉÖØÞ,\nÀéöØþ", " \n. ,"]
    flat, sizes = codes.stream(pa.array(texts))
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and flat.tolist() == sum(want, [])
    assert set(codes.codes) == {"word", "word..", "àéöøþ", "", ".", ","}


def test_every_letter_is_coded_as_the_library_does():
    letters = [c for c in map(chr, range(0x250)) if token_files._LETTERS.fullmatch(c)]
    texts = [f"{c}{d}{stop} {c}" for c in letters for d in ("", "a", "É") for stop in ("", ".", ",", "!")]
    library = tokenizers.Tokenizer.from_file(WORDS)
    coded = token_files.WordCodes(WORDS, True).ids(texts)
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [
        e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)
    ]
