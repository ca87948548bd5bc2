"""Secret scan: keyword automaton, anchored patterns near its hits, embedded checksums.

Every text runs once through an Aho-Corasick automaton of the keywords that secrets start with
(on a copy with ASCII letters in lower case). Long hexadecimal runs have no keyword, so a second
automaton reads a copy in which every hexadecimal digit is the same symbol and looks for as many
of those symbols as the shortest run needs. Regular expressions are tried only at the places
found, anchored there. Vendor tokens that carry a checksum must pass it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.common import doc_text, lean, worker_store
from tallyloom.session import ship_by_value

ship_by_value(__name__)

#: Kinds in the order in which spans of equal start are listed.
BASE_KINDS = ("assign", "access", "hex")
VENDOR_KINDS = ("github", "npm")
KINDS = BASE_KINDS + VENDOR_KINDS

ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
# Tokens that end in a base-62 CRC-32 of their random part: prefix, length of that part.
VENDOR = {
    "github": (re.compile(r"(?:ghp|gho|ghu|ghs|ghr)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
               ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    "npm": (re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"), ("npm_",)),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
_HEX_MARK = "\x01"

SPANS_SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string"
)


def checksum62(part: str) -> str:
    """CRC-32 of the part as six base-62 digits."""
    value, digits = zlib.crc32(part.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = BASE62[d] + digits
    return digits


def _tables() -> dict:
    """Automata and byte tables, built once per Python worker."""
    import ahocorasick

    store = worker_store()
    if "secrets" not in store:
        words = ahocorasick.Automaton()
        for word in ASSIGN_WORDS:
            words.add_word(word, ("assign", len(word)))
        words.add_word("akia", ("access", 4))
        for kind, (_, prefixes) in VENDOR.items():
            for p in prefixes:
                words.add_word(p, (kind, len(p)))
        words.make_automaton()
        runs = ahocorasick.Automaton()
        runs.add_word(_HEX_MARK * MIN_HEX, MIN_HEX)
        runs.make_automaton()
        lower = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
        marks = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))
        store["secrets"] = (words, runs, lower, marks)
    return store["secrets"]


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """All spans as (start, end, kind) in code points, by start and then kind as listed.

    Within a kind they are the leftmost non-overlapping matches of its pattern.
    """
    words, runs, lower, marks = _tables()
    # one byte per code point, so places in the copies are places in the text
    flat = text.encode("latin-1", "replace")
    hits = [(end - size + 1, kind) for end, (kind, size) in words.iter(flat.translate(lower).decode("latin-1"))]
    found: list[tuple[int, int, str]] = []
    done = dict.fromkeys(KINDS, 0)
    for start, kind in sorted(hits):
        if start < done[kind]:
            continue
        if kind == "assign":
            m = ASSIGN.match(text, start)
            good = m is not None and len(m[2]) >= MIN_ASSIGN
        elif kind == "access":
            m = ACCESS.match(text, start)
            good = m is not None and m.end() - start >= MIN_ACCESS
        else:
            m = VENDOR[kind][0].match(text, start)
            good = m is not None and checksum62(m[1]) == m[2]
        if m is not None:
            done[kind] = m.end()
            if good:
                found.append((start, m.end(), kind))
    last = 0
    for end, size in runs.iter(flat.translate(marks).decode("latin-1")):
        start = end - size + 1
        if start >= last:  # the first hit in a run is at the run's start
            last = HEX.match(text, start).end()
            found.append((start, last, "hex"))
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return found


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[], [], [], [], []]
        for text in batch.column("text"):
            spans = find_spans(text.as_py() or "")
            kinds = [s[2] for s in spans]
            row = [kinds.count(k) for k in BASE_KINDS]
            row += [listed([s for s in spans if s[2] in BASE_KINDS]), listed(spans)]
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        arrays = [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(c, pa.string()) for c in columns[3:]]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *arrays],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"],
        )


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document with its counts and span lists; nothing is shuffled.

    A null or empty text has no spans. Repeated rows give repeated results; a null id stays null.
    Columns besides ``doc_id`` and ``text`` are ignored. An empty table gives no rows.
    """
    return doc_text(docs).mapInArrow(_scan, SPANS_SCHEMA)


def _mask(batches: Iterator[pa.RecordBatch], kinds: tuple[str, ...], by: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for i, text in enumerate(texts):
            spans = [s for s in find_spans(text or "") if s[2] in kinds]
            if spans:
                parts, at = [], 0
                for start, end, _ in spans:
                    if end > at:  # overlapping spans of two kinds leave one mark
                        parts += [text[at:start], by] if start >= at else []
                        at = end
                texts[i] = "".join(parts) + text[at:]
        k = batch.schema.get_field_index("text")
        yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))


def mask_secrets(docs: DataFrame, kinds: tuple[str, ...] = KINDS, by: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every span of the kinds replaced in ``text``."""
    return docs.mapInArrow(lean(lambda batches: _mask(batches, kinds, by)), docs.schema)
