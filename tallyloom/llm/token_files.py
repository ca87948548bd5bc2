"""Token files: Arrow IPC files of fixed-size lists for zero-copy access to equal-length rows.

The token ids of all documents in ascending id order form one stream, which is cut into parts.
Each part is a file of record batches whose columns are fixed-size lists: ``tokens`` (unsigned
16-bit ids where the vocabulary allows, else 32-bit), ``mask`` (one bit for each token, unset in
the padding of the part's last row) and ``last`` (one bit, set on the end token of a document).
A reader maps the file and slices rows without copying. A second small file lists the documents
of the part with their first token. A manifest table, one row for each part, gives the order.

Every task writes files of its own name and moves them to their place when whole, so a repeated
task does no harm.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import RecentlyUsed, doc_text, partitions, worker_store
from tallyloom.llm.words import LATIN, joined, steps, with_stops, without_stops
from tallyloom.session import scratch_dir, ship_by_value

ship_by_value(__name__)

ROW_TOKENS = 2048
#: Rows of a record batch; a part is written batch by batch.
BATCH_ROWS = 256
#: Distinct words in each of two generations whose ids a Python worker keeps.
KEPT_WORDS = 300_000
#: Bytes of text whose distinct words are looked up at a time (a longer document is a step of its own).
STEP_BYTES = 8 << 20

MANIFEST = "part int, name string, docs long, tokens long"


#: Nothing the tokenizers used here do parts such a word, or joins it to a full stop or comma after it.
_LETTERS = re.compile(LATIN)


class WordCodes:
    """Ids of texts by a tokenizer that never looks across white space, word by word.

    Each distinct word goes through the tokenizer once for as long as it is kept.
    """

    def __init__(self, path: str, wide: bool):
        from tokenizers import Tokenizer

        self.kind = np.dtype("<u4" if wide else "<u2")
        self.tokenizer = Tokenizer.from_file(path)
        if not wide and self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids over 65,535 need wide files")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.codes = RecentlyUsed(KEPT_WORDS)
        self.mark_id, token = max(self.tokenizer.get_added_tokens_decoder().items())
        self.mark = token.content
        spec = json.loads(self.tokenizer.to_str())
        suffix = spec["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.folds = '"Lowercase"' in json.dumps(spec["normalizer"])
        self._whole({".", ","})
        self.stops = {stop: self.codes[stop] for stop in (".", ",")}

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned integers of 16 or 32 bits."""
        flat, sizes = self.stream(pa.array(texts, pa.string()))
        return [part.tobytes() for part in np.split(flat, np.cumsum(sizes))[:-1]]

    def stream(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # only blanks and line feeds part words here; the tokenizer sees to other white space
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        # arrays of ids are joined as strings of bytes
        bounds, data = joined(self._coded(words.dictionary).take(words.indices))
        return data.view(self.kind), np.diff(bounds[ends] // self.kind.itemsize, prepend=0)

    def _coded(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words; one of letters is coded without case, and without its stop."""
        letters, stems = without_stops(words)
        # letters are part of no special token, so their case only matters to the normalizer
        shared = (pc.if_else(letters, pc.utf8_lower(stems), stems) if self.folds else stems).dictionary_encode()
        codes = pa.array(self._looked_up(shared.dictionary.to_pylist()), pa.large_binary()).take(shared.indices)
        return with_stops(codes, words, letters, self.stops)

    def _looked_up(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words, of which new ones are encoded."""
        # no cycles arise here, and looking for them among millions of words takes long
        collecting = gc.isenabled()
        gc.disable()
        try:
            new = self.codes.missing(set(words))
            letters = list(filter(_LETTERS.fullmatch, new))
            self._whole(new.difference(letters))
            self._letters(letters)
            return list(map(self.codes.__getitem__, words))
        finally:
            if collecting:
                gc.enable()

    def _letters(self, words: list[str]) -> None:
        """Encodes words of letters in joint calls, parted again where a token ends a word."""
        for k in range(0, len(words), 4096):
            part = words[k : k + 4096]
            (coded,) = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(coded.ids, self.kind)
            ends = self.kind.itemsize * (np.flatnonzero(self.ends[ids]) + 1)
            if len(ends) != len(part):
                self._whole(set(part))
                continue
            data, start = ids.tobytes(), 0
            for word, end in zip(part, ends.tolist()):
                self.codes[word] = data[start:end]
                start = end

    def _whole(self, words: set[str]) -> None:
        """Encodes any words in joint calls, with a special token between them as a mark."""
        joint = [w for w in words if self.mark not in w]
        for k in range(0, len(joint), 4096):
            part = joint[k : k + 4096]
            (coded,) = self.tokenizer.encode_batch_fast([self.mark.join(part)], add_special_tokens=False)
            ids, size = np.array(coded.ids, self.kind), self.kind.itemsize
            cuts = size * np.flatnonzero(ids == self.mark_id)
            data, at = ids.tobytes(), [-size, *cuts.tolist(), size * len(ids)]
            for i, word in enumerate(part):
                self.codes[word] = data[at[i] + size : at[i + 1]]
        for word in words.difference(joint):
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            self.codes[word] = np.array(ids, self.kind).tobytes()


def word_codes(path: str, wide: bool) -> WordCodes:
    store, key = worker_store(), ("word codes", path, wide)
    if key not in store:
        store[key] = WordCodes(path, wide)
    return store[key]


class _PartWriter:
    """Writes a stream of ids as rows of equal length."""

    def __init__(self, sink, kind: pa.DataType, row: int):
        self.kind, self.row = kind, row
        bits = pa.list_(pa.bool_(), row)
        self.schema = pa.schema([("tokens", pa.list_(kind, row)), ("mask", bits), ("last", bits)])
        self.out = pa.ipc.new_file(sink, self.schema)
        self.ids: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        self.waiting = self.total = 0

    def add(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self.ids.append(ids)
        self.ends.append(ends)
        self.waiting += len(ids)
        self.total += len(ids)
        if self.waiting >= self.row * BATCH_ROWS:
            self._flush(self.waiting // self.row * self.row)

    def _flush(self, n: int) -> None:
        ids, ends = np.concatenate(self.ids), np.concatenate(self.ends)
        self.ids, self.ends, self.waiting = [ids[n:]], [ends[n:]], len(ids) - n
        self._rows(ids[:n], ends[:n], np.ones(n, bool))

    def _rows(self, ids: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> None:
        for a in range(0, len(ids), self.row * BATCH_ROWS):
            cut = slice(a, a + self.row * BATCH_ROWS)
            columns = (pa.array(ids[cut], self.kind), pa.array(mask[cut]), pa.array(ends[cut]))
            lists = [pa.FixedSizeListArray.from_arrays(c, self.row) for c in columns]
            self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            self._flush(self.waiting // self.row * self.row)
            pad = -self.waiting % self.row
            if self.waiting:
                ids = np.concatenate([*self.ids, np.zeros(pad, self.ids[0].dtype)])
                ends = np.concatenate([*self.ends, np.zeros(pad, bool)])
                self._rows(ids, ends, np.arange(len(ids)) < self.waiting)
        self.out.close()


def _write_parts(folder: str, path: str, end_id: int, row: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        store, base = fs.FileSystem.from_uri(folder)
        name = f"part-{part:07d}"
        draft = f"{base}/_{name}-{attempt}"
        kind = pa.uint32() if wide else pa.uint16()
        codes, ids, firsts = word_codes(path, wide), [], []
        with store.open_output_stream(f"{draft}.arrow") as sink:
            writer = _PartWriter(sink, kind, row)
            for batch in batches:
                for piece in steps(batch, limit=STEP_BYTES):
                    coded, sizes = codes.stream(piece.column("text"))
                    flat = np.insert(coded, np.cumsum(sizes), end_id)
                    stops = np.cumsum(sizes + 1)
                    firsts.append(writer.total + stops - sizes - 1)
                    ends = np.zeros(len(flat), bool)
                    ends[stops - 1] = True
                    writer.add(flat, ends)
                    ids.append(piece.column("doc_id"))
            writer.close()
        # a part has one document row after the other, so its list fits in memory like its ids
        docs = pa.table(
            {
                "doc_id": pa.chunked_array(ids, pa.int64()),
                "first": pa.chunked_array([pa.array(f) for f in firsts], pa.int64()),
            }
        )
        with store.open_output_stream(f"{draft}.docs.arrow") as sink, pa.ipc.new_file(sink, docs.schema) as out:
            out.write_table(docs)
        for tail in (".arrow", ".docs.arrow"):
            if store.get_file_info(f"{base}/{name}{tail}").type == fs.FileType.File:  # of an earlier attempt
                store.delete_file(f"{base}/{name}{tail}")
            store.move(f"{draft}{tail}", f"{base}/{name}{tail}")
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "name": name, "docs": len(docs), "tokens": writer.total}],
            pa.schema([("part", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]),
        )

    return run


@dataclass(frozen=True)
class TokenFiles:
    """A folder of token files; parts are listed in stream order with their first token."""

    folder: str
    row: int
    parts: tuple[tuple[int, str, int, int], ...]  # part, name, tokens of all parts before, documents


def write_tokens(
    docs: DataFrame,
    path: str,
    end_id: int,
    folder: str | None = None,
    row: int = ROW_TOKENS,
    wide: bool = False,
) -> TokenFiles:
    """Encode every document, append ``end_id`` and write all ids in ascending ``doc_id`` order.

    ``path`` is a tokenizer file that executors can open; its pre-tokenizer must treat white space
    as a border. ``folder`` is a URI that every executor reaches, by default a new one in the
    shared scratch folder. Null and empty texts have the end id only. Rows without id come first;
    rows of equal id follow each other in the order of a hash of their text. ``wide`` is needed
    for ids over 65,535.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "tokens")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    key = F.xxhash64("text")
    ordered = (
        doc_text(docs)
        .repartitionByRange(2 * partitions(spark), F.col("doc_id").asc_nulls_first(), key)
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), key)
    )
    written = ordered.mapInArrow(_write_parts(folder, path, end_id, row, wide), MANIFEST)
    written.write.parquet(f"{folder}/manifest")
    # one row for each part file
    rows = spark.read.parquet(f"{folder}/manifest").orderBy("part").collect()
    before, parts = 0, []
    for r in rows:
        if r["docs"]:
            parts.append((r["part"], r["name"], before, r["docs"]))
        before += r["tokens"]
    return TokenFiles(folder, row, tuple(parts))


class PartReader:
    """Random access to one part: documents by place, rows of equal length by number."""

    def __init__(self, folder: str, name: str):
        store, base = fs.FileSystem.from_uri(folder)
        local = isinstance(store, fs.LocalFileSystem)
        opened = pa.memory_map if local else store.open_input_file
        self.file = pa.ipc.open_file(opened(f"{base}/{name}.arrow"))
        self.docs = pa.ipc.open_file(opened(f"{base}/{name}.docs.arrow")).read_all()
        self.first = self.docs.column("first").to_numpy()
        self.row = self.file.schema.field("tokens").type.list_size
        self._batch = (-1, None)

    def batch(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, mask and end marks of record batch ``k``, one line for each row; tokens are a view."""
        if self._batch[0] != k:
            batch = self.file.get_batch(k)
            tokens = batch.column(0).values.to_numpy().reshape(-1, self.row)
            bits = [batch.column(i).values.to_numpy(zero_copy_only=False).reshape(-1, self.row) for i in (1, 2)]
            self._batch = (k, (tokens, *bits))
        return self._batch[1]

    def stretches(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The stream of real tokens with their end marks, one record batch at a time."""
        for k in range(self.file.num_record_batches):
            tokens, mask, last = self.batch(k)
            yield tokens[mask], last[mask]


def _read_parts(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column("name").to_pylist(), batch.column("before").to_pylist(), strict=True):
                part = PartReader(folder, name)
                crcs, sizes, crc, size = [], [], 0, 0
                for tokens, last in part.stretches():
                    at = 0
                    wide = memoryview(tokens.astype("<u4"))
                    for stop in (np.flatnonzero(last) + 1).tolist():
                        crcs.append(zlib.crc32(wide[at:stop], crc))
                        sizes.append(size + stop - at)
                        crc, size, at = 0, 0, stop
                    crc, size = zlib.crc32(wide[at:], crc), size + len(tokens) - at
                if len(sizes) != len(part.docs):
                    raise ValueError(f"{name} has {len(sizes)} ends for {len(part.docs)} documents")
                columns = [part.docs.column("doc_id").combine_chunks(), pa.array(before + part.first)]
                columns += [pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_documents(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """Per document, from the files: ``start`` in the stream, ``n_tokens`` and ``ids_crc32``."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files.parts:
        return spark.createDataFrame([], schema)
    listed = [(name, before) for _, name, before, _ in files.parts]
    parts = spark.createDataFrame(listed, "name string, before long").repartition(len(listed))
    return parts.mapInArrow(_read_parts(files.folder), schema)
