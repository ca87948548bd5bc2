"""Benchmark decontamination with suffix arrays of the training text.

The training documents are cut into shards. Each shard gets a suffix array over its words, sorted
by as many words as the longest window has, and every suffix of every benchmark item is looked up
in it by binary search. Hits on neighbouring words of the same item join into the longest verbatim
matches, with their places.

Words are numbered by rank in the vocabulary of the benchmark; a training suffix that leaves this
vocabulary before the shortest window is full cannot match and is not sorted in. The benchmark is
taken in blocks of bounded size, so that what executors hold does not grow with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import doc_text, lean
from tallyloom.llm.words import Words, alphanumeric, covered, distinct, steps
from tallyloom.session import ship_by_value, stored

ship_by_value(__name__)

WINDOW = 10
#: Bytes of benchmark text that one pass over the documents looks for.
BLOCK_BYTES = 16 << 20

MATCHES = "matches array<struct<start:int,length:int,item:string,item_start:int>>"
FOUND_SCHEMA = f"doc_id long, text string, n_words long, {MATCHES}"


@dataclass
class TestSuffixes:
    """Benchmark items as ranks, with the packed leading words of every suffix to be searched."""

    vocabulary: np.ndarray
    per_key: int
    bits: int
    lengths: np.ndarray
    low: np.ndarray
    high: np.ndarray
    item: np.ndarray
    place: np.ndarray
    names: list[str | None]
    shortest: int


def _packed(ranks: np.ndarray, starts: np.ndarray, per_key: int, bits: int, keys: int) -> np.ndarray:
    """Key columns of suffixes: ``per_key`` ranks in each, first word in the highest bits."""
    padded = np.concatenate([ranks, np.zeros(per_key * keys, ranks.dtype)]).astype(np.uint64)
    out = np.zeros((keys, len(starts)), np.uint64)
    for k in range(keys):
        for j in range(per_key):
            out[k] = (out[k] << np.uint64(bits)) | padded[starts + k * per_key + j]
    return out


def _separated(words: Words, ranks: np.ndarray) -> np.ndarray:
    """Ranks in order with a zero after each row, so that no window crosses rows."""
    out = np.zeros(len(ranks) + words.rows, np.int64)
    out[np.arange(len(ranks)) + words.owner] = ranks
    return out


def prepare_items(names: list[str | None], texts: list[str | None], window: int = WINDOW) -> TestSuffixes | None:
    """The suffixes of the items that start a window; None if no item has a word."""
    words = Words(pa.array(texts, pa.string()), alphanumeric(), lower=True)
    if not len(words.owner):
        return None
    hashes = words.hashes()
    vocabulary = distinct(hashes)
    bits = max(1, len(vocabulary).bit_length())
    per_key = max(1, 64 // bits)
    keys = -(-window // per_key)
    ranks = _separated(words, np.searchsorted(vocabulary, hashes) + 1)
    place = np.arange(len(hashes)) - words.firsts[words.owner]
    length = np.minimum(window, words.counts[words.owner])
    starts_window = np.flatnonzero(place + length <= words.counts[words.owner])
    length, item = length[starts_window], words.owner[starts_window]
    keyed = _packed(ranks, starts_window + item, per_key, bits, keys)
    low, high = keyed.copy(), keyed.copy()
    for k in range(keys):
        free = np.uint64(bits) * np.clip(per_key * (k + 1) - length, 0, per_key).astype(np.uint64)
        ones = np.where(free >= 64, np.uint64(2**64 - 1), (np.uint64(1) << np.minimum(free, np.uint64(63))) - np.uint64(1))
        low[k] &= ~ones
        high[k] |= ones
    return TestSuffixes(
        vocabulary, per_key, bits, length, low, high, item, place[starts_window], names, int(length.min())
    )


def search_shard(words: Words, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """All (word of the shard, test suffix) pairs where the suffix's whole window occurs."""
    none = np.zeros(0, np.int64)
    hashes = words.hashes()
    if not len(hashes):
        return none, none
    at = np.minimum(np.searchsorted(tests.vocabulary, hashes), len(tests.vocabulary) - 1)
    ranks = _separated(words, np.where(tests.vocabulary[at] == hashes, at + 1, 0))
    # distance to the next word outside the vocabulary (or the row's end)
    gaps = np.flatnonzero(ranks == 0)
    reach = gaps[np.searchsorted(gaps, np.arange(len(ranks)))] - np.arange(len(ranks))
    suffixes = np.flatnonzero(reach >= tests.shortest)
    keys = _packed(ranks, suffixes, tests.per_key, tests.bits, len(tests.low))
    order = np.lexsort(keys[::-1])
    suffixes, keys = suffixes[order], keys[:, order]
    lo = np.searchsorted(keys[0], tests.low[0], "left")
    hi = np.searchsorted(keys[0], tests.high[0], "right")
    places, found = [], []
    for t in np.flatnonzero(lo < hi).tolist():
        a, b = int(lo[t]), int(hi[t])
        for k in range(1, len(keys)):
            if a == b:
                break
            part = keys[k, a:b]
            a, b = a + int(np.searchsorted(part, tests.low[k, t], "left")), a + int(
                np.searchsorted(part, tests.high[k, t], "right")
            )
        if a < b:
            places.append(suffixes[a:b])
            found.append(np.full(b - a, t))
    if not places:
        return none, none
    word_at = np.arange(len(hashes)) + words.owner
    return np.searchsorted(word_at, np.concatenate(places)), np.concatenate(found)


def _longest(places: np.ndarray, found: np.ndarray, words: Words, tests: TestSuffixes):
    """Joins hits on successive words of one item: (row, start in row, length, item, item start)."""
    item, place = tests.item[found], tests.place[found]
    order = np.lexsort((places, places - place, item))
    places, item, place, length = places[order], item[order], place[order], tests.lengths[found][order]
    joins = (item[1:] == item[:-1]) & (places[1:] == places[:-1] + 1) & (place[1:] == place[:-1] + 1)
    joins &= words.owner[places[1:]] == words.owner[places[:-1]]
    heads = np.flatnonzero(np.concatenate([[True], ~joins]))
    tails = np.concatenate([heads[1:], [len(places)]]) - 1
    row = words.owner[places[heads]]
    size = places[tails] - places[heads] + length[tails]
    out = np.stack([row, places[heads] - words.firsts[row], size, item[heads], place[heads]], axis=1)
    return out[np.lexsort((out[:, 4], out[:, 3], out[:, 1], out[:, 0]))]


def _match(tests: TestSuffixes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                words = Words(part.column("text"), alphanumeric(), lower=True)
                places, found = search_shard(words, tests)
                rows = [[] for _ in range(part.num_rows)]
                if len(places):
                    for row, start, size, item, item_start in _longest(places, found, words, tests).tolist():
                        rows[row].append(
                            {"start": start, "length": size, "item": tests.names[item], "item_start": item_start}
                        )
                yield _with_matches(part, words.counts, rows)

    return run


_MATCH_TYPE = pa.list_(
    pa.struct([("start", pa.int32()), ("length", pa.int32()), ("item", pa.string()), ("item_start", pa.int32())])
)


def _with_matches(part: pa.RecordBatch, counts: np.ndarray, rows: list[list[dict]]) -> pa.RecordBatch:
    arrays, names = list(part.columns), list(part.schema.names)
    for name, value in (("n_words", pa.array(counts)), ("matches", pa.array(rows, _MATCH_TYPE))):
        if name not in names:
            arrays.append(value)
            names.append(name)
        elif name == "matches":
            k = names.index(name)
            before = arrays[k].to_pylist()
            arrays[k] = pa.array([a + b for a, b in zip(before, rows, strict=True)], _MATCH_TYPE)
    return pa.RecordBatch.from_arrays(arrays, names)


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list[str | None], list[str]]]:
    """The distinct items in blocks of about ``block_bytes`` of text, each small enough for the driver.

    One item larger than that is a block of its own.
    """
    parts = items.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("text"))
    parts = parts.filter("text IS NOT NULL").distinct()
    total = parts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for b in range(blocks):
        # an item stays whole, as equal rows have equal hashes
        block = parts.filter(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == b) if blocks > 1 else parts
        rows = block.collect()
        yield [r["name"] for r in rows], [r["text"] for r in rows]


def verbatim_matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Every document with ``n_words`` and its longest verbatim ``matches`` with benchmark items.

    A match covers at least ``window`` words, or all words of a shorter item. Null and empty texts
    have no words and no matches; items without words find nothing; matches of an item without id
    have a null ``item``; an id on several item rows is one item. Repeated documents are judged alike. The documents are read once per block
    of the benchmark and never shuffled.
    """
    found = doc_text(docs)
    spark, first = docs.sparkSession, True
    for names, texts in _blocks(items, block_bytes):
        tests = prepare_items(names, texts, window)
        if tests is None:
            continue
        if not first:  # one more block: keep what is known so far
            found = stored(found, "matches")
        schema = FOUND_SCHEMA
        held = spark.sparkContext.broadcast(tests)
        found = found.mapInArrow(lambda batches, held=held: _match(held.value)(batches), schema)
        first = False
    if first:
        found = found.mapInArrow(_no_matches, FOUND_SCHEMA)
    return found


def _no_matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch):
            counts = Words(part.column("text"), alphanumeric(), lower=True).counts
            yield _with_matches(part, counts, [[] for _ in range(part.num_rows)])


def _hit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits, longest, items = [], [], []
        for n, matches in zip(batch.column("n_words").to_pylist(), batch.column("matches").to_pylist(), strict=True):
            starts = np.array([m["start"] for m in matches], np.int64)
            lengths = np.array([m["length"] for m in matches], np.int64)
            hits.append(int(covered(starts, lengths, n).sum()) if matches else 0)
            longest.append(int(lengths.max()) if matches else 0)
            items.append(sorted({m["item"] for m in matches} - {None}))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("n_words"),
                pa.array(hits, pa.int64()),
                pa.array(longest, pa.int64()),
                pa.array(items, pa.list_(pa.string())),
            ],
            ["doc_id", "n_words", "n_hit", "longest", "items"],
        )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words inside matches, the longest match and the items matched.

    An item without id counts in the words and is not in the list. Nulls, empty and repeated
    rows are as in ``verbatim_matches``.
    """
    found = verbatim_matches(docs, items, window).select("doc_id", "n_words", "matches")
    return found.mapInArrow(
        _hit_counts, "doc_id long, n_words long, n_hit long, longest long, items array<string>"
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with all their columns, in which no benchmark window occurs.

    Null and empty texts stay, repeated documents are judged alike, items without id count, and
    without items every document stays.
    """
    kept = docs
    for names, texts in _blocks(items, BLOCK_BYTES):
        tests = prepare_items(names, texts, window)
        if tests is not None:
            held = docs.sparkSession.sparkContext.broadcast(tests)
            kept = kept.mapInArrow(lean(lambda batches, held=held: _without(held.value, batches)), docs.schema)
    return kept


def _without(tests: TestSuffixes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch):
            words = Words(part.column("text"), alphanumeric(), lower=True)
            clean = np.ones(part.num_rows, bool)
            clean[words.owner[search_shard(words, tests)[0]]] = False
            yield part.filter(pa.array(clean))
