"""Substring dedup by relative Lempel-Ziv parsing against every indexed reference block.

Each document is parsed from left to right relative to all documents with smaller ids: a factor
starts at a phrase of ``window`` words that the reference holds and grows word by word as long as
the phrase that ends there is held too; where it stops, the phrases across its end are looked up
as well before words count as literal. Factors, which have ``window`` words at least, are the
duplicate spans.

The reference index is spread over blocks by phrase hash. Documents are dealt into groups; a group
sends each block the phrases that fall into it, a phrase that several of its documents share only
once, for the smallest id (the others are duplicates whatever the blocks say). A block finds the
smallest id of each phrase and answers with one bit per phrase, in the order asked. The text is
shuffled once; both uses of a group read the same exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import doc_text, partitions
from tallyloom.llm.words import Words, blank_separated, covered, gram_places, grams, mix, steps
from tallyloom.session import ship_by_value

ship_by_value(__name__)

WINDOW = 13
#: Groups of documents and blocks of phrases for each shuffle partition.
GROUPS_PER_PARTITION = 2
BLOCKS_PER_PARTITION = 1

ASKED = "part long, block int, n int, ids binary, counts binary, phrases binary"
SPANS = "array<struct<start:int,length:int>>"


class _Phrases:
    """The phrases of a group's documents, in the order of ids and texts."""

    def __init__(self, table: pa.Table, window: int):
        table = table.select(["doc_id", "text"])
        known = table.filter(pa.compute.is_valid(table.column("doc_id")))
        # null ids are last and neither ask nor answer; equal rows are in any order
        rest = table.filter(pa.compute.is_null(table.column("doc_id")))
        self.table = pa.concat_tables(
            [known.sort_by([("doc_id", "ascending"), ("text", "ascending")]), rest]
        ).combine_chunks()
        self.ids = known.column("doc_id").combine_chunks().sort().to_numpy().astype(np.int64)
        hashes, rows, counts = [], [], []
        done = 0
        for batch in self.table.to_batches():
            for part in steps(batch):
                words = Words(part.column("text"), blank_separated())
                places = gram_places(words, window)
                hashes.append(grams(words.hashes(), window)[places])
                rows.append(words.owner[places] + done)
                counts.append(words.counts)
                done += part.num_rows
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.hashes, self.rows = join(hashes, np.uint64), join(rows, np.int64)
        self.counts = join(counts, np.int64)
        self.asking = self.rows < len(self.ids)

    def local(self) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase: the first place in the group with the same words; known duplicates.

        A phrase is a known duplicate if a document of the group with a smaller id has it.
        """
        order = np.argsort(self.hashes, kind="stable")
        same = self.hashes[order]
        heads = np.concatenate([np.ones(min(1, len(same)), bool), same[1:] != same[:-1]])
        first = np.empty(len(order), np.int64)
        first[order] = order[np.flatnonzero(heads)][np.cumsum(heads) - 1]
        known = np.zeros(len(order), bool)
        at = np.flatnonzero(self.asking)
        known[at] = self.ids[self.rows[at]] > self.ids[np.minimum(self.rows[first[at]], len(self.ids) - 1)]
        return first, known


def _blocks_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return (mix(hashes) % np.uint64(blocks)).astype(np.int64)


def _ask(blocks: int, window: int):
    def run(key: tuple[pa.Scalar], table: pa.Table) -> pa.Table:
        phrases = _Phrases(table, window)
        first, _ = phrases.local()
        send = np.flatnonzero(phrases.asking & (first == np.arange(len(first))))
        block = _blocks_of(phrases.hashes[send], blocks)
        send = send[np.argsort(block, kind="stable")]
        cuts = np.searchsorted(np.sort(block), np.arange(blocks + 1))
        out = {name: [] for name in ("part", "block", "n", "ids", "counts", "phrases")}
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            own = send[cuts[b] : cuts[b + 1]]
            rows = phrases.rows[own]
            heads = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            ids = phrases.ids[rows[heads]]
            out["part"].append(key[0].as_py())
            out["block"].append(b)
            out["n"].append(len(own))
            out["ids"].append(_small(np.diff(ids, prepend=0)))
            out["counts"].append(_small(np.diff(heads, append=len(own))))
            out["phrases"].append(phrases.hashes[own].tobytes())
        return pa.table(out, schema=_ASKED)

    return run


_ASKED = pa.schema(
    [("part", pa.int64()), ("block", pa.int32()), ("n", pa.int32())]
    + [(name, pa.binary()) for name in ("ids", "counts", "phrases")]
)


def _small(values: np.ndarray) -> bytes:
    """Integers, most of them small, as compressed bytes: all lowest bytes first, and so on."""
    import zstandard

    planes = values.astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _large(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _answer(table: pa.Table) -> pa.Table:
    """One bit for each phrase asked: whether a smaller id has it too."""
    rows = table.to_pylist()
    hashes = [np.frombuffer(r["phrases"], np.uint64) for r in rows]
    ids = [np.repeat(np.cumsum(_large(r["ids"])), _large(r["counts"])) for r in rows]
    every, doc = np.concatenate(hashes), np.concatenate(ids)
    order = np.argsort(every)
    same = every[order]
    heads = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
    smallest = np.minimum.reduceat(doc[order], heads)
    again = np.empty(len(every), bool)
    again[order] = doc[order] > np.repeat(smallest, np.diff(heads, append=len(same)))
    cuts = np.cumsum([0] + [len(h) for h in hashes])
    bits = [np.packbits(again[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
    return pa.table(
        {
            "part": pa.array([r["part"] for r in rows], pa.int64()),
            "block": pa.array([r["block"] for r in rows], pa.int32()),
            "n": pa.array([r["n"] for r in rows], pa.int32()),
            "bits": pa.array(bits, pa.binary()),
        }
    )


def _parse(blocks: int, window: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _PARSED.empty_table()
        phrases = _Phrases(docs, window)
        first, known = phrases.local()
        send = np.flatnonzero(phrases.asking & (first == np.arange(len(first))))
        block = _blocks_of(phrases.hashes[send], blocks)
        order = send[np.argsort(block, kind="stable")]
        cuts = np.searchsorted(np.sort(block), np.arange(blocks + 1))
        held = np.zeros(len(first), bool)
        for r in answers.to_pylist():
            own = order[cuts[r["block"]] : cuts[r["block"] + 1]]
            if len(own) != r["n"]:
                raise ValueError("an answer does not fit the group's phrases")
            held[own] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]).astype(bool)
        # a phrase of the group's smallest document counts for that document's repeats as well
        held = (held[first] & phrases.asking) | known
        starts = np.flatnonzero(held)
        offsets = np.cumsum(phrases.counts) - phrases.counts
        per_row = np.maximum(phrases.counts - window + 1, 0)
        inside = np.arange(len(first)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        removed = covered(offsets[phrases.rows[starts]] + inside[starts], window, int(phrases.counts.sum()))
        return _results(phrases, removed, offsets)

    return run


_PARSED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
        ("kept_sha256", pa.string()),
    ]
)


def _results(phrases: _Phrases, removed: np.ndarray, offsets: np.ndarray) -> pa.Table:
    rows = []
    marks = blank_separated()
    done = 0
    ids = phrases.table.column("doc_id").to_pylist()
    for batch in phrases.table.to_batches():
        for part in steps(batch):
            words = Words(part.column("text"), marks)
            low = offsets[done] if part.num_rows else 0
            for i in range(part.num_rows):
                at, n = int(words.firsts[i]), int(words.counts[i])
                gone = removed[low + at : low + at + n]
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                spans = [{"start": int(a), "length": int(b - a)} for a, b in zip(edge[0::2], edge[1::2])]
                keep = np.flatnonzero(~gone) + at
                raw = words.bytes.data
                text = b" ".join([raw[a:b] for a, b in zip(words.starts[keep].tolist(), words.ends[keep].tolist())])
                digest = hashlib.sha256(text).hexdigest()
                rows.append((ids[done + i], n, int(gone.sum()), spans, digest))
            done += part.num_rows
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _PARSED)], schema=_PARSED)


def duplicate_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words removed, the duplicate ``spans`` and the digest of what is kept.

    A word goes if a run of ``window`` words around it, as they stand, also starts in a document
    with a smaller id. Null and empty texts have no words. Rows of equal id don't count as
    smaller than each other, and rows without id neither lose words nor serve as reference.
    Columns besides ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    groups = GROUPS_PER_PARTITION * partitions(spark)
    blocks = BLOCKS_PER_PARTITION * partitions(spark)
    # repeated ids, or none, are spread by text
    dealt = doc_text(docs).withColumn("part", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(groups)))
    asked = dealt.groupBy("part").applyInArrow(_ask(blocks, window), ASKED)
    answers = asked.groupBy("block").applyInArrow(_answer, "part long, block int, n int, bits binary")
    return (
        dealt.groupBy("part")
        .cogroup(answers.groupBy("part"))
        .applyInArrow(_parse(blocks, window), f"doc_id long, n_words long, n_removed long, spans {SPANS}, kept_sha256 string")
    )
