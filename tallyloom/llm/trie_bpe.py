"""Byte-level BPE encoding over a trie of distinct words, and decoding.

The encoding of a string's prefix is the encoding of a shorter prefix plus one last token, and
which token that is can be told from the pair it forms with the token before: the pair must be
what the merges make of the two tokens' bytes. So each trie node holds one state, its last token,
and words that share a prefix share the states along it. Distinct words of a batch are walked in
sorted order, which is the depth-first order of their trie: the stack holds the states of the path
to the current word and is cut back to what the next word has in common with it. Beside its last
token a node has its ending, the longest end of the path that some token starts with; the tokens
that the path may end with follow from it, and endings and their successors are kept once found.

Texts are cut into units (a run of white space and the word after it) that the pre-tokenizer never
joins. Arrow finds the distinct units of a batch and puts their ids in the texts' order. Encoded
units are kept in the Python worker, up to a fixed number, so that later batches and tasks reuse
them; the result doesn't depend on what is kept.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import RecentlyUsed, doc_text, lean, worker_store
from tallyloom.llm.words import LATIN, joined, steps, with_stops, without_stops
from tallyloom.session import ship_by_value

ship_by_value(__name__)

#: White space as the pre-tokenizer knows it (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: How the pre-tokenizer cuts text (fixed values of the published byte-level scheme).
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: A blank beside other white space: units can't be told by blanks alone.
_DOUBTFUL = re.compile(rf"[{SPACE}] | [{SPACE}]")
_UNITS = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: A line feed between words, where a unit starts too.
_BREAK = rf"([^{SPACE}])\n([^{SPACE}])"
#: A unit that is one piece.
_WORD = re.compile(f" ?{LATIN}")

#: Encoded units in each of two generations that a Python worker keeps.
KEPT_UNITS = 150_000
#: Pairs of tokens and successors of endings that a Python worker keeps.
KEPT_PAIRS = 300_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable bytes for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokens:
    """The bytes of the tokens of one tokenizer file, and decoding."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = pre["type"] == "ByteLevel" and not pre["add_prefix_space"] and spec["normalizer"] is None
        if model["type"] != "BPE" or not plain:
            raise ValueError("expected a byte-level BPE tokenizer without normalizer or prefix blank")
        letters = byte_letters()
        to_bytes = lambda token: bytes(letters[c] for c in token)
        self.ids = {to_bytes(t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or need word bounds are not supported")
        self._load(spec, to_bytes)
        table = {i: t for t, i in self.ids.items()}
        table |= {i: t.encode() for t, i in self.specials.items()}
        self.table = pa.array([table.get(i) for i in range(max(table) + 1)], pa.large_binary())

    def _load(self, spec: dict, to_bytes) -> None:
        """Reads what else is needed of the file."""

    def decode(self, ids: np.ndarray) -> str:
        """The text of a list of ids; bytes that are no UTF-8 become replacement characters."""
        return self.decode_batch(pa.array([np.asarray(ids, "<u4").tobytes()], pa.large_binary()))[0].as_py()

    def decode_batch(self, coded: pa.Array) -> pa.Array:
        """The text of each list of ids, given as little-endian unsigned 32-bit integers."""
        bounds, data = joined(coded.cast(pa.large_binary()))
        tokens = self.table.take(pa.array(data.view("<u4")))
        if tokens.null_count:
            raise ValueError("ids that are in no token list")
        texts = _parted(tokens, bounds // 4)
        try:
            return texts.cast(pa.large_string())
        except pa.ArrowInvalid:  # a token of part of a character stands alone
            return pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.large_string())


def _parted(strings: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Strings of bytes put together: those from each bound to the next."""
    ends, data = joined(strings)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(ends[bounds]), pa.py_buffer(data)]
    )


class TrieBpe(Tokens):
    """Encoder and decoder of one tokenizer file."""

    def _load(self, spec: dict, to_bytes) -> None:
        import regex

        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        size = max(self.ids.values()) + 2
        #: stands for the start of a word where a pair has no left token
        self.start = size - 1
        self._sizes = {i: len(t) for t, i in self.ids.items()}
        self._four = {i: i.to_bytes(4, "little") for i in self.ids.values()}
        self._special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        self._pieces = regex.compile(PIECES)
        # a pair of ids is one number; how each token came about: rank and halves of its last merge
        self.ranks: dict[int, int] = {}
        self._made, self._left, self._right = [-1] * size, [0] * size, [0] * size
        for rank, (a, b) in enumerate(pairs):
            a, b = to_bytes(a), to_bytes(b)
            left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
            if self._made[whole] >= 0:
                raise ValueError("expected one merge for each token")
            self.ranks[left << 32 | right] = self._made[whole] = rank
            self._left[whole], self._right[whole] = left, right
        self._unreachable = {
            i
            for t, i in self.ids.items()
            if len(t) > 1 and (self._made[i] < 0 or not self._border(self._left[i], self._right[i], self._made[i]))
        }
        self._known: dict[int, bool] = {}
        #: beginnings of tokens
        self._heads = {t[:n] for t in self.ids for n in range(1, len(t) + 1)}
        self._forget_endings()
        self._kept = RecentlyUsed(KEPT_UNITS)
        self._kept.update(self._encoded({".", ","}))
        self._stops = {stop: self._kept[stop] for stop in (".", ",")}

    def _border(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge of a rank below the limit joins across two tokens while they are made.

        The merges that made the two are undone, latest first. If at some time a merge across
        the border was possible that comes before the one undone, the border would not have held.
        Of two equal merges the left one comes first.
        """
        ranks, made = self.ranks, self._made
        while True:
            rank = ranks.get(left << 32 | right)
            if rank is not None and rank < limit:
                return False
            a, b = made[left], made[right]
            if a > b:
                limit, left = a, self._right[left]
            elif b >= 0:
                limit, right = b + 1, self._left[right]
            else:
                return True

    def stable(self, left: int, right: int) -> bool:
        """Whether these tokens stay as they are next to each other."""
        if left == self.start:
            return right not in self._unreachable
        return self._border(left, right, len(self.ranks))

    def _forget_endings(self) -> None:
        # an ending has its bytes and, by the next byte, the tokens at the end of its successor (length
        # and id, longest first) and that successor
        self._root: dict = {-1: b""}
        self._endings = {b"": ((), self._root)}
        self._steps = 0

    def _successor(self, ending: dict, byte: int) -> tuple[tuple[tuple[int, int], ...], dict]:
        tail = ending[-1] + bytes([byte])
        while tail and tail not in self._heads:
            tail = tail[1:]
        if tail not in self._endings:
            ends = ((n, self.ids.get(tail[-n:])) for n in range(len(tail), 0, -1))
            self._endings[tail] = (tuple((n, i) for n, i in ends if i is not None), {-1: tail})
        ending[byte] = self._endings[tail]
        self._steps += 1
        return ending[byte]

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Token ids of distinct words as 32-bit integers, by a depth-first walk of their trie."""
        out: dict[bytes, bytes] = {}
        if len(self._known) > KEPT_PAIRS:
            self._known.clear()
        if self._steps > KEPT_PAIRS:
            self._forget_endings()
        known, stable, successor, four, sizes = self._known, self.stable, self._successor, self._four, self._sizes
        path, last, endings = b"", [self.start], [self._root]  # last token and ending of each node on the path
        for word in sorted(words):
            shared = 0
            for a, b in zip(path, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], endings[shared + 1 :]
            end, ending = shared, endings[shared]
            for byte in word[shared:]:
                end += 1
                tokens, ending = ending.get(byte) or successor(ending, byte)
                for size, token in tokens:
                    pair = last[end - size] << 32 | token
                    good = known.get(pair)
                    if good is None:
                        good = known[pair] = stable(last[end - size], token)
                    if good:
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
                last.append(token)
                endings.append(ending)
            path, at, tokens = word, len(word), []
            while at:
                tokens.append(four[last[at]])
                at -= sizes[last[at]]
            tokens.reverse()
            out[word] = b"".join(tokens)
        return out

    def _encoded(self, units: set[str]) -> dict[str, bytes]:
        """The ids of units that aren't kept."""
        single = {u: u.encode() for u in filter(_WORD.fullmatch, units)}
        other = {u: [p.encode() for p in self._pieces.findall(u)] for u in units.difference(single)}
        coded = self.encode_words(list({*single.values(), *(p for pieces in other.values() for p in pieces)}))
        out = {u: coded[piece] for u, piece in single.items()}
        out.update((u, b"".join([coded[p] for p in pieces])) for u, pieces in other.items())
        return out

    def _looked_up(self, units: list[str]) -> list[bytes]:
        """The ids of units, of which new ones are encoded."""
        self._kept.update(self._encoded(self._kept.missing(set(units))))
        return list(map(self._kept.__getitem__, units))

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """The ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, _DOUBTFUL.pattern)
        for special in self.specials:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        plain = self._plain(texts.filter(pc.invert(odd)))
        if len(plain) == len(texts):
            return plain
        cut = pa.array([self._cut(t) for t in texts.filter(odd).to_pylist()], pa.large_binary())
        # a stable sort by kind gives where each text has gone
        places = np.argsort(np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable"))
        return pa.concat_arrays([plain, cut]).take(pa.array(places))

    def _plain(self, texts: pa.Array) -> pa.Array:
        """Texts that blanks, and line feeds between words, cut into units."""
        lists = pc.split_pattern(pc.replace_substring_regex(texts, _BREAK, "\\1 \n\\2"), " ")
        words = lists.flatten().dictionary_encode()
        index, distinct = words.indices.to_numpy().astype(np.int64), words.dictionary
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
        # all but a text's first unit have their blank back, where it isn't the added one
        heads = np.concatenate([np.zeros(min(1, len(ends)), np.int64), ends[:-1]])
        first, index[heads] = np.unique(index[heads], return_inverse=True)
        index[heads] += len(distinct)
        blank = pc.if_else(pc.starts_with(distinct, "\n"), pa.scalar("", pa.large_string()), " ")
        later = pc.binary_join_element_wise(blank, distinct, pa.scalar("", pa.large_string()))
        units = pa.concat_arrays([later, distinct.take(pa.array(first))])
        used = np.zeros(len(units), bool)
        used[index] = True
        units, index = units.filter(pa.array(used)), (np.cumsum(used) - 1)[index]
        letters, stems = without_stops(units, "[ \n]?")
        shared = stems.dictionary_encode()
        codes = pa.array(self._looked_up(shared.dictionary.to_pylist()), pa.large_binary()).take(shared.indices)
        coded = with_stops(codes, units, letters, self._stops).take(pa.array(index))
        return _parted(coded, np.concatenate([np.zeros(1, np.int64), ends]))

    def _cut(self, text: str) -> bytes:
        """A text with special strings or blanks beside other white space."""
        cuts = [(m.start(), m.end()) for m in self._special.finditer(text)]
        edges = [0, *(e for c in cuts for e in c), len(text)]
        units = [_UNITS.findall(text[a:b]) for a, b in zip(edges[::2], edges[1::2])]
        specials = [self.specials[text[a:b]].to_bytes(4, "little") for a, b in cuts]
        parts = [b"".join(self._looked_up(us)) for us in units]
        return b"".join(part + special for part, special in zip(parts, [*specials, b""]))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return self.encode_column(pa.array(texts, pa.large_string())).to_pylist()

    def rest(self) -> None:
        """Gives up what is kept beside the young generation, between tasks."""
        self._known.clear()
        self._forget_endings()
        self._kept.old = {}


def _of_worker(kind: type[Tokens], path: str) -> Tokens:
    """The encoder or decoder of a tokenizer file, built once per Python worker."""
    store = worker_store()
    if (kind.__name__, path) not in store:
        with open(path, encoding="utf-8") as f:
            store[kind.__name__, path] = kind(f.read())
    return store[kind.__name__, path]


def encoder(path: str) -> TrieBpe:
    return _of_worker(TrieBpe, path)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            for part in steps(batch):
                coded = bpe.encode_column(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), coded.cast(pa.binary())], ["doc_id", "ids"])
        bpe.rest()

    return run


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: ``doc_id`` and ``ids``, its token ids as little-endian 32-bit binary.

    ``path`` names the tokenizer file, which every executor must be able to open. A null or empty
    text has no ids. Repeated rows give repeated results and a null id stays null. Nothing is
    shuffled; other columns are ignored.
    """
    return doc_text(docs).mapInArrow(lean(_encode(path)), "doc_id long, ids binary")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _of_worker(Tokens, path)
        for batch in batches:
            for part in steps(batch, "ids"):
                texts = tokens.decode_batch(part.column("ids"))
                yield pa.RecordBatch.from_arrays([*part.columns, texts.cast(pa.string())], ["doc_id", "ids", "decoded"])

    return run


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Adds the ``decoded`` text to rows of ``encode_documents``."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, ids binary, decoded string")


def token_count(ids: str = "ids"):
    return (F.octet_length(ids) / 4).cast("long")
