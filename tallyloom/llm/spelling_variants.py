"""Groups of spelling variants: words that differ by one inserted, deleted or replaced code point.

Every prefix of a word is a node of the trie of all words, every suffix one of the trie of the
reversed words. With the nodes numbered, a word is a row of integer pairs: the node of the prefix
before a place and the node of the suffix after it. Leaving out one place gives a pair (prefix
node, suffix node) that says everything about the word but that code point, so

* two words with the same pair around a left-out place differ by a replacement there;
* a word whose parts, with nothing left out, make up that pair is the other without the place.

Joining on pairs of integers finds exactly the neighbours, without comparing strings. A pair holds
at most as many words as there are code points for the place, and one whole word. Of a run of equal
code points only the first counts as left out for the second kind, so each neighbour comes once.

Nodes are numbered by walking the sorted words: a word keeps the nodes of the prefix it shares
with the word before and gets new numbers for the rest. Words are sorted by ranges; each range
counts for itself, and nodes that lie on the border between two ranges take the number of the
earlier one. For that the driver sees the two outer words of each range, no more.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import doc_text, partitions
from tallyloom.session import ship_by_value, stored

ship_by_value(__name__)

SHORTEST, MIN_COUNT, RATIO = 7, 2, 10
#: Distinct words that a task counts before it passes the counts on.
HELD_WORDS = 200_000
#: Runs of letters that are words (fixed values).
_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LEFT_OUT, LEFT_OUT_FIRST, WHOLE = range(3)


def misspelt(word: str, start: int, every: int) -> str:
    """The word, or less one code point where its hash, begun with that of the document, says so."""
    h = zlib.crc32(word.encode(), start)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count(shortest: int, every: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}

        def ready() -> pa.RecordBatch:
            words, counts = pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())
            found.clear()
            return pa.RecordBatch.from_arrays([words, counts], ["word", "n"])

        for batch in batches:
            for i in range(batch.num_rows):
                doc, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if not text:
                    continue
                # only A-Z change, as bytes of other characters are no ASCII letters
                own = Counter(_RUNS.findall(text.encode().lower().decode()))
                start = zlib.crc32(f"{doc}:".encode())
                for word, n in own.items():
                    if len(word) >= shortest:
                        if every is not None and doc is not None:
                            word = misspelt(word, start, every)
                            if len(word) < shortest:
                                continue
                        found[word] = found.get(word, 0) + n
                if len(found) > HELD_WORDS:
                    yield ready()
        if found:
            yield ready()

    return run


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = MIN_COUNT, every: int | None = None) -> DataFrame:
    """Distinct words of at least ``shortest`` code points that occur ``least`` times, and ``n``.

    Words are maximal runs of the letters of Latin-1, with A-Z lower-cased, of whole texts. With
    ``every``, one word in so many loses a code point first, by a hash of document and word (rows
    of a null document lose none). Null and empty texts have no words; repeated rows count again.
    """
    counted = doc_text(docs).mapInArrow(_count(shortest, every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def shared(a: str, b: str) -> int:
    """Code points that two words have in common from the start."""
    if b.startswith(a):
        return len(a)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def _walk(name: str):
    """Numbers the trie nodes of the sorted words of a range, from those of the word before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        at, row, before, path = (part << 40) + 1, part << 40, "", [part << 40]
        for batch in batches:
            paths = []
            for word in batch.column("key").to_pylist():
                common = shared(before, word)
                fresh = len(word) - common
                path = [*path[: common + 1], *range(at, at + fresh)]
                at, before = at + fresh, word
                paths.append(path)
            rows = pa.array(np.arange(row, row + batch.num_rows, dtype=np.int64))
            row += batch.num_rows
            parts = pa.array(np.full(batch.num_rows, part, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(paths, pa.list_(pa.int64())), rows, parts],
                [*batch.schema.names, name, f"{name}_row", f"{name}_part"],
            )

    return run


def _numbered(words: DataFrame, name: str) -> tuple[DataFrame, dict[int, int]]:
    """Adds the node of every prefix of ``key``; also says which numbers stand for earlier ones.

    The root of each range and the nodes that the outer words of neighbouring ranges share have
    several numbers. The result maps each later one to the first.
    """
    n = partitions(words.sparkSession)
    ranged = words.repartitionByRange(n, "key").sortWithinPartitions("key")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    walked = ranged.mapInArrow(_walk(name), f"{fields}, {name} array<long>, {name}_row long, {name}_part int")
    table = stored(walked, f"trie-{name}")
    outer = table.groupBy(f"{name}_part").agg(
        F.min(F.struct("key", name)).alias("low"), F.max(F.struct("key", name)).alias("high")
    )
    same: dict[int, int] = {}
    last = None
    for r in sorted(outer.collect(), key=lambda r: r[0]):
        if last is not None:
            common = shared(last["key"], r["low"]["key"])
            for mine, earlier in zip(r["low"][name][: common + 1], last[name]):
                same[mine] = same.get(earlier, earlier)
        last = r["high"]
    return table, same


def _pairs(prefix_same: dict[int, int], suffix_same: dict[int, int]):
    """The pairs (prefix node, suffix node) of each word, with and without a place left out."""

    def translate(values: np.ndarray, same: dict[int, int]) -> np.ndarray:
        if not same:
            return values
        keys = np.array(sorted(same), np.int64)
        to = np.array([same[k] for k in keys.tolist()], np.int64)
        at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        return np.where(keys[at] == values, to[at], values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            columns = (batch.column(c) for c in ("key", "prefix", "suffix", "prefix_row", "n"))
            for key, prefix, suffix, word, n in zip(*columns):
                letters = np.frombuffer(key.as_py().encode("utf-32-le"), np.uint32)[::-1]
                p = translate(prefix.values.to_numpy(), prefix_same)
                s = translate(suffix.values.to_numpy(), suffix_same)[::-1]
                length = len(letters)
                first = np.ones(length, bool)
                first[1:] = letters[1:] != letters[:-1]
                kinds = np.concatenate([first.astype(np.int8), np.full(length + 1, WHOLE, np.int8)])
                pairs = np.concatenate([p[:-1], p]), np.concatenate([s[1:], s])
                out.append((*pairs, np.full(len(kinds), word.as_py()), np.full(len(kinds), n.as_py()), kinds))
                size += len(kinds)
                if size > 100_000:
                    yield _pair_batch(out)
                    out, size = [], 0
            if out:
                yield _pair_batch(out)

    return run


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c)) for c in zip(*rows)], ["prefix", "suffix", "word_row", "n", "kind"]
    )


def near_words(words: DataFrame) -> DataFrame:
    """Adds to ``word`` and ``n``: ``row`` (order of the words), ``n_near``, and the near word of
    largest ``n`` (ties: the first) as ``best_n`` and ``best_row``, null where there is none.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point.
    ``words`` holds each word once; an empty table gives none.
    """
    first, prefix_same = _numbered(words.select(F.col("word").alias("key"), "n"), "prefix")
    turned = first.withColumn("key", F.reverse("key")).drop("prefix_part")
    second, suffix_same = _numbered(turned, "suffix")
    pairs = second.select("key", "n", "prefix", "suffix", "prefix_row").mapInArrow(
        _pairs(prefix_same, suffix_same), "prefix long, suffix long, word_row long, n long, kind byte"
    )
    # more frequent first, then in order of words; a pair that one word has alone is dropped
    member = F.struct("n", (-F.col("word_row")).alias("turned"), "kind")
    groups = (
        pairs.groupBy("prefix", "suffix")
        .agg(F.sort_array(F.collect_list(member), asc=False).alias("members"))
        .filter((F.size("members") > 1))
    )
    meets = lambda a, b: (a["turned"] != b["turned"]) & (
        F.when(a["kind"] == WHOLE, b["kind"] == LEFT_OUT_FIRST)
        .when(b["kind"] == WHOLE, a["kind"] == LEFT_OUT_FIRST)
        .otherwise(F.lit(True))
    )
    around = F.transform(
        "members",
        lambda m: F.struct(
            (-m["turned"]).alias("row"), F.filter("members", lambda o: meets(m, o)).alias("others")
        ),
    )
    found = (
        groups.select(F.inline(around))
        .select("row", F.size("others").alias("k"), F.get("others", F.lit(0)).alias("o"))
        .groupBy("row")
        .agg(F.sum("k").alias("n_near"), F.max(F.struct("o.n", "o.turned")).alias("best"))
    )
    plain = first.select(F.col("key").alias("word"), "n", F.col("prefix_row").alias("row"))
    return plain.join(found, "row", "left").select(
        "row", "word", "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.col("best.n").alias("best_n"),
        (-F.col("best.turned")).alias("best_row"),
    )


def variant_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Each word with its form, the root of its forms and the number of near words.

    ``words`` has ``word`` (each once) and ``n``. A word's ``form`` is its near word of largest
    ``n`` (ties: the smallest), if that ``n`` is at least ``ratio`` times its own; ``form_n`` is
    that number. ``root`` is the last of the forms that follow each other, or the word itself.
    """
    if ratio < 2:
        raise ValueError("the ratio must be at least 2, so that forms lead upwards")
    near = stored(near_words(words), "near-words")
    has_form = F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))
    forms = near.withColumns(
        {
            "form_row": F.when(has_form, F.col("best_row")),
            "form_n": F.when(has_form, F.col("best_n")),
        }
    ).drop("best_n", "best_row")
    # every form is so much more frequent than its word that few can follow each other
    most = forms.agg(F.max("n")).first()[0] or 1
    steps, reach = 1, 1
    while ratio**reach < most:
        steps, reach = steps + 1, 2 * reach
    links = stored(forms.filter("form_row IS NOT NULL").select("row", F.col("form_row").alias("root_row")), "forms")
    roots = links
    for _ in range(steps):
        onward = roots.select(F.col("row").alias("root_row"), F.col("root_row").alias("next"))
        roots = stored(
            roots.join(onward, "root_row", "left").select("row", F.coalesce("next", "root_row").alias("root_row")), "roots"
        )
    # names of the few words that are a form or a root
    targets = links.select("root_row").union(roots.select("root_row")).distinct()
    names = near.join(targets.withColumnRenamed("root_row", "row"), "row").select("row", "word")
    form_names = names.select(F.col("row").alias("form_row"), F.col("word").alias("form"))
    root_names = names.select(F.col("row").alias("root_row"), F.col("word").alias("root_name"))
    linked = (
        links.withColumnRenamed("root_row", "form_row")
        .join(form_names, "form_row")
        .join(roots, "row")
        .join(root_names, "root_row")
        .select("row", "form", "root_name")
    )
    return forms.join(linked, "row", "left").select(
        "word", "form", F.coalesce("root_name", "word").alias("root"), "n", "n_near", "form_n"
    )
