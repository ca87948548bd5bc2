"""Token counts of whole texts: Arrow functions that encode in batches and return lengths only.

Texts of a partition are cut into pieces of limited size at boundaries across which the tokenizer
never joins anything, and the pieces are put into calls of about equal bytes, so that neither one
long text nor many short ones make a call large. Only the lengths of the encodings leave a call;
the pieces' lengths are added up to those of their texts.

A boundary is safe for byte-level BPE where white space follows something that is no white space:
no piece of the pre-tokenizer reaches from the one into the other, none looks back, and the cut is
in no added token. Where a tokenizer does more (a normalizer, a blank put before the text, added
tokens with white space or that swallow it), texts are encoded whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallyloom.llm.common import doc_text, worker_store
from tallyloom.session import ship_by_value

ship_by_value(__name__)

#: Code points of a piece, beyond which the next safe boundary ends it.
PIECE = 8_192
#: Code points of one call of the tokenizer, at most one piece more.
CALL = 131_072

_BORDER = re.compile(r"(?<=\S)(?=[ \n])")


def pieces(text: str, size: int = PIECE) -> list[str]:
    """The text cut at the first safe boundary after every ``size`` code points."""
    out, at = [], 0
    while len(text) - at > size:
        border = _BORDER.search(text, at + size)
        if border is None:
            break
        out.append(text[at : border.start()])
        at = border.start()
    out.append(text[at:])
    return out


def may_cut(spec: dict) -> bool:
    """Whether a tokenizer file describes one that never joins across white space after a word."""
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    tokens = spec.get("added_tokens") or []
    closed = all(
        not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])) for t in tokens
    )
    return spec.get("normalizer") is None and plain and closed


class Counter:
    """Counts the tokens of texts with the library that the file's ending names."""

    def __init__(self, path: str):
        self.cut, self.lengths = self._piece_model(path) if path.endswith(".model") else self._word_model(path)

    @staticmethod
    def _word_model(path: str) -> tuple[bool, Callable[[list[str]], list[int]]]:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            content = f.read()
        tokenizer = Tokenizer.from_str(content)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def lengths(texts: list[str]) -> list[int]:
            return list(map(len, tokenizer.encode_batch_fast(texts, add_special_tokens=False)))

        return may_cut(json.loads(content)), lengths

    @staticmethod
    def _piece_model(path: str) -> tuple[bool, Callable[[list[str]], list[int]]]:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        return False, lambda texts: list(map(len, model.encode(texts, num_threads=1)))

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, by calls of about equal size."""
        out = np.zeros(len(texts), np.int64)
        waiting, owners, size = [], [], 0
        for i, text in enumerate(texts):
            for piece in pieces(text) if self.cut else [text]:
                waiting.append(piece)
                owners.append(i)
                size += len(piece)
                if size >= CALL:
                    np.add.at(out, owners, self.lengths(waiting))
                    waiting, owners, size = [], [], 0
        if waiting:
            np.add.at(out, owners, self.lengths(waiting))
        return out


def _counter(path: str) -> Counter:
    """The counter of a tokenizer file, built once per Python worker."""
    store = worker_store()
    if ("token counter", path) not in store:
        store["token counter", path] = Counter(path)
    return store["token counter", path]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tallyloom.llm.words import steps

        counter = _counter(path)
        for batch in batches:
            for part in steps(batch):
                texts = pc.fill_null(part.column("text"), "")
                n_bytes = pc.cast(pc.binary_length(texts), pa.int64())
                n_tokens = pa.array(counter.counts(texts.to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), n_bytes, n_tokens], ["doc_id", "n_bytes", "n_tokens"]
                )

    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes`` of its UTF-8 text and its ``n_tokens``.

    ``path`` names a tokenizer file that every executor can open: ``.json`` for ``tokenizers``,
    ``.model`` for ``sentencepiece``. No special tokens are put around a text; special strings
    inside one count as the library's default has it. Null counts as an empty text: 0 and 0.
    Repeated rows give repeated rows, a null id stays null, an empty table gives none, and other
    columns are ignored whatever their names. Nothing is shuffled.
    """
    return doc_text(docs).mapInArrow(_count(path), "doc_id long, n_bytes long, n_tokens long")
