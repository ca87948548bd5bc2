"""Hashed character n-grams of Arrow text columns, as byte n-grams of UTF-8."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallyloom.llm.words import mix, text_bytes
from tallyloom.session import ship_by_value

ship_by_value(__name__)


class CharGrams:
    """Byte n-grams of each row, white space folded to one blank, ASCII letters lower-cased."""

    def __init__(self, texts: pa.Array):
        raw, ends = text_bytes(texts)
        fold = np.arange(256, dtype=np.uint8)
        fold[0x41:0x5B] += 0x20
        fold[0x09:0x0E] = 0x20
        self.rows = len(ends)
        # a blank before and after each text, so that n-grams see where words begin and end
        keep = np.ones(len(raw) + 2 * self.rows, bool)
        self.last = ends + 2 * np.arange(1, self.rows + 1)  # one past each padded text
        self.first = np.concatenate([np.zeros(min(1, self.rows), np.int64), self.last[:-1]])
        keep[self.first] = False
        keep[self.last - 1] = False
        self.bytes = np.full(len(keep) + 8, 0x20, np.uint8)
        self.bytes[: len(keep)][keep] = fold[raw]
        self.lanes = np.ndarray((len(self.bytes) - 7,), "<u8", self.bytes, strides=(1,))

    def buckets(self, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The bucket of every n-gram (n <= 8) with its row."""
        counts = np.maximum(self.last - self.first - n + 1, 0)
        total = int(counts.sum())
        starts = np.repeat(self.first - (np.cumsum(counts) - counts), counts) + np.arange(total)
        keys = self.lanes[starts] & np.uint64((1 << (8 * n)) - 1)
        keys ^= np.uint64(n) << np.uint64(59)
        return (mix(keys) >> np.uint64(64 - bits)).astype(np.int64), np.repeat(np.arange(self.rows), counts)
