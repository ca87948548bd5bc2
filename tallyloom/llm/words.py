"""Words, word hashes and shingles of Arrow text columns, in numpy.

Everything works on UTF-8 bytes: the word separators used here are ASCII, so bytes of longer
characters always belong to words. Hashes are 64 bits wide and depend on the words alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyloom.session import ship_by_value

ship_by_value(__name__)

#: Separators of ``[^\x20\x09-\x0D]+``.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Bytes of text that one numpy step takes at most (a longer document is a step of its own).
STEP_BYTES = 2 << 20

#: A run of Latin letters (fixed values).
LATIN = "[A-Za-zÀ-ÖØ-öø-ÿ]+"

_LANES = 32  # words of more than eight times as many bytes are hashed one by one


def blank_separated() -> np.ndarray:
    """Marks the bytes of words between white space."""
    marks = np.ones(256, bool)
    marks[list(BLANKS)] = False
    return marks


def alphanumeric() -> np.ndarray:
    """Marks ASCII digits and lower-case letters and every byte of non-ASCII characters."""
    marks = np.zeros(256, bool)
    marks[0x30:0x3A] = True
    marks[0x61:0x7B] = True
    marks[0x80:] = True
    return marks


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each text ends; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends[1:] - ends[0]


def without_stops(words: pa.Array, before: str = "") -> tuple[pa.Array, pa.Array]:
    """Which words are Latin letters, at most with a full stop or comma after them, and all words without it."""
    letters = pc.match_substring_regex(words, rf"\A{before}{LATIN}[.,]?\z")
    return letters, pc.if_else(letters, pc.utf8_rtrim(words, ".,"), words)


def with_stops(codes: pa.Array, words: pa.Array, letters: pa.Array, stops: dict[str, bytes]) -> pa.Array:
    """The codes of words, from those that ``without_stops`` gives and the codes of stops."""
    none = pa.scalar(b"", pa.large_binary())
    for stop, code in stops.items():
        cut = pc.and_(letters, pc.ends_with(words, stop))
        codes = pc.binary_join_element_wise(codes, pc.if_else(cut, pa.scalar(code, pa.large_binary()), none), none)
    return codes


def joined(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings of a large binary column start and end in all their bytes, and those."""
    if not len(strings):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, bounds, data = strings.buffers()
    bounds = np.frombuffer(bounds, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return bounds - bounds[0], raw[bounds[0] : bounds[-1]]


def steps(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch that hold at most ``limit`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, first = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total + n > limit and i > first:
            yield batch.slice(first, i - first)
            total, first = 0, i
        total += n
    yield batch.slice(first)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Words:
    """The words of a text column in order: byte spans, hashes and owning rows."""

    def __init__(self, texts: pa.Array, marks: np.ndarray, lower: bool = False):
        raw, ends = text_bytes(texts)
        self.rows = len(ends)
        # one separator after each text keeps words of neighbours apart; spare bytes for lanes
        separator = int(np.flatnonzero(~marks)[0])
        padded = np.full(len(raw) + self.rows + 8 * _LANES + 8, separator, np.uint8)
        if self.rows:
            keep = np.ones(len(raw) + self.rows, bool)
            keep[ends + np.arange(self.rows)] = False
            padded[: len(keep)][keep] = raw
            del keep
        if lower:
            fold = np.arange(256, dtype=np.uint8)
            fold[0x41:0x5B] += 0x20
            padded = fold[padded]
        self.bytes = padded
        inside = marks[padded].view(np.int8)
        turns = np.flatnonzero(np.diff(inside, prepend=np.int8(0)))
        self.starts, self.ends = turns[0::2], turns[1::2]
        bounds = np.searchsorted(self.starts, ends + np.arange(self.rows))
        self.counts = np.diff(bounds, prepend=0)
        self.firsts = bounds - self.counts
        self.owner = np.repeat(np.arange(self.rows), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        buf = self.bytes
        lanes = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
        sizes = self.ends - self.starts
        out = mix(sizes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        at, left, who = self.starts, sizes, None
        for _ in range(_LANES):
            lane = lanes[at].astype(np.uint64)
            short = left < 8
            lane[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
            if who is None:
                out = mix(out ^ lane)
            else:
                out[who] = mix(out[who] ^ lane)
            more = np.flatnonzero(left > 8)
            if not len(more):
                return out
            who = more if who is None else who[more]
            at, left = at[more] + 8, left[more] - 8
        for i in who.tolist():
            word = buf[self.starts[i] : self.ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out

    def word(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.ends[i]].tobytes()


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` neighbouring word hashes (runs may cross rows)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0x2545F4914F6CDD1D)
        out += hashes[j : j + n]
    return mix(out)


def gram_places(words: Words, k: int) -> np.ndarray:
    """Which words start a run of ``k`` words of one row."""
    n = len(words.owner) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.owner[:n] == words.owner[k - 1 :])


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; a plain sort is many times faster here than ``numpy.unique``."""
    values = np.sort(values)
    return values[np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))]


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Marks the places below ``n`` that lie in a span ``[start, start + length)``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0
