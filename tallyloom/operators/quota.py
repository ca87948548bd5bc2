"""Per-key quota over windows that open at a key's first event.

A window lasts a fixed time from the event that opened it; the next event at or after its end
opens the next one. Which event opens a window depends on the whole past of the key, so a
plain implementation walks each key in one task. Here the timeline of every key is cut into
chunks that are processed in parallel:

1. per (key, chunk): a map from "end of the window carried in" to "start of the last window
   opened here". Windows opened at different events soon meet at the same event, so the map
   has few steps even for a very busy key;
2. per key: the maps are followed chunk by chunk, which yields the window carried into each;
3. per (key, chunk): every event gets the start of its window.

Steps 1 and 3 work on Arrow batches, many (key, chunk) groups at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordering import bucketed_row_number
from tallyloom.session import ship_by_value

# Window length and allowance per key.
WINDOW_SECONDS = 60
LIMIT_PER_WINDOW = 120
CHUNK_SECONDS = 900
UNKNOWN_KEY = "unknown"
_NONE = -(2**62)

ship_by_value(__name__)


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Re-cut sorted batches so that no (k, chunk) group is split over two blocks."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        if held:
            last = held[-1]
            same = (batch["k"].to_numpy() == last["k"].iloc[-1]) & (
                batch["chunk"].to_numpy() == last["chunk"].iloc[-1]
            )
            if same.all():
                held.append(batch)
                continue
        starts = np.flatnonzero(_starts(batch))
        cut = int(starts[-1])
        head = [*held, batch.iloc[:cut]]
        held = [batch.iloc[cut:]]
        block = pd.concat(head, ignore_index=True)
        if not block.empty:
            yield block
    if held:
        yield pd.concat(held, ignore_index=True)


def _starts(block: pd.DataFrame) -> np.ndarray:
    k, chunk = block["k"].to_numpy(), block["chunk"].to_numpy()
    first = np.ones(len(block), dtype=bool)
    first[1:] = (k[1:] != k[:-1]) | (chunk[1:] != chunk[:-1])
    return first


def _positions(block: pd.DataFrame, first: np.ndarray, chunk_us: int, window_us: int):
    """Group number, offset in the chunk, and one sorted axis on which groups do not meet."""
    group = np.cumsum(first) - 1
    offset = block["us"].to_numpy(np.int64) - block["chunk"].to_numpy(np.int64) * chunk_us
    stride = chunk_us + 2 * window_us + 2
    return group, offset, group.astype(np.int64) * stride + offset, stride


def _next_opener(axis: np.ndarray, group: np.ndarray, window_us: int) -> np.ndarray:
    """Index of the first event a full window later in the same group, else the event itself."""
    here = np.arange(len(axis))
    nxt = np.searchsorted(axis, axis + window_us, side="left")
    inside = nxt < len(axis)
    inside[inside] = group[nxt[inside]] == group[inside]
    return np.where(inside, nxt, here)


def _chunk_maps(chunk_us: int, window_us: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _whole_groups(batches):
            block = block.drop_duplicates(["k", "chunk", "us"], ignore_index=True)
            first = _starts(block)
            group, offset, axis, _ = _positions(block, first, chunk_us, window_us)
            last = _next_opener(axis, group, window_us)
            while True:
                further = last[last]
                if np.array_equal(further, last):
                    break
                last = further
            # A carried window ends before chunk start + window, so only events up to the
            # first one past that point can open the first window of the chunk.
            can_open = first.copy()
            can_open[1:] |= ~first[1:] & (offset[:-1] < window_us)
            idx = np.flatnonzero(can_open)
            run_end = np.ones(len(idx), dtype=bool)
            run_end[:-1] = (group[idx[1:]] != group[idx[:-1]]) | (last[idx[1:]] != last[idx[:-1]])
            keep = idx[run_end]
            us = block["us"].to_numpy(np.int64)
            yield pd.DataFrame(
                {
                    "k": block["k"].to_numpy()[keep],
                    "chunk": block["chunk"].to_numpy(np.int64)[keep],
                    "entry_to": us[keep],
                    "exit_start": us[last[keep]],
                }
            )

    return run


def _carry(window_us: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, start = None, _NONE
        for block in _whole_groups(batches):
            begin = np.flatnonzero(_starts(block))
            end = np.append(begin[1:], len(block))
            keys, entry = block["k"].to_numpy(), block["entry_to"].to_numpy(np.int64)
            leave = block["exit_start"].to_numpy(np.int64)
            carried = np.empty(len(begin), dtype=np.int64)
            for i, (b, e) in enumerate(zip(begin, end)):
                if keys[b] != key:
                    key, start = keys[b], _NONE
                carried[i] = start
                window_end = start + window_us if start != _NONE else _NONE
                hit = b + int(np.searchsorted(entry[b:e], window_end, side="left"))
                if hit < e:
                    start = leave[hit]
            yield pd.DataFrame(
                {
                    "k": keys[begin],
                    "chunk": block["chunk"].to_numpy(np.int64)[begin],
                    "carried": carried,
                }
            )

    return run


def _assign(chunk_us: int, window_us: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _whole_groups(batches):
            first = _starts(block)
            # The first row of every group is the marker that brings the carried window.
            carried = block["carried"].to_numpy(np.int64)[first]
            block = block.loc[~first].reset_index(drop=True)
            first = _starts(block)
            group, _, axis, stride = _positions(block, first, chunk_us, window_us)
            nxt = _next_opener(axis, group, window_us)
            chunk_start = block["chunk"].to_numpy(np.int64)[first] * chunk_us
            skip = np.where(carried == _NONE, 0, carried + window_us - chunk_start)
            base = np.arange(len(carried), dtype=np.int64) * stride
            at = np.searchsorted(axis, base + np.clip(skip, 0, chunk_us + window_us), side="left")
            live = at < len(axis)
            live[live] = group[at[live]] == np.flatnonzero(live)
            at = at[live]
            opens = np.zeros(len(block), dtype=bool)
            while len(at):
                opens[at] = True
                after = nxt[at]
                at = after[after != at]
            us = block["us"].to_numpy(np.int64)
            opener = np.maximum.accumulate(np.where(opens, np.arange(len(block)), -1))
            own = (opener >= 0) & (group[opener] == group)
            start = np.where(own, us[opener], carried[group])
            yield pd.DataFrame(
                {
                    "k": block["k"].to_numpy(),
                    "us": us,
                    "id": block["id"].to_numpy(),
                    "window_start": start,
                }
            )

    return run


def _known(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit(UNKNOWN_KEY))


def window_starts(
    df: DataFrame,
    key: str,
    micros: str,
    event_id: str,
    window_seconds: int = WINDOW_SECONDS,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """(k, us, id, window_start) for every event with a time; times in microseconds, the id a BIGINT.

    Events without a key share the key ``unknown``.
    """
    window_us = int(window_seconds * 1_000_000)
    chunk_us = max(int(chunk_seconds * 1_000_000), window_us)
    events = df.select(
        _known(key).alias("k"),
        F.expr(f"(`{micros}` - pmod(`{micros}`, {chunk_us}L)) div {chunk_us}L").alias("chunk"),
        F.col(micros).cast("bigint").alias("us"),
        F.col(event_id).cast("bigint").alias("id"),
    ).filter(F.col("us").isNotNull())

    maps = (
        events.select("k", "chunk", "us")
        .repartition("k", "chunk")
        .sortWithinPartitions("k", "chunk", "us")
        .mapInPandas(
            _chunk_maps(chunk_us, window_us),
            "k string, chunk bigint, entry_to bigint, exit_start bigint",
        )
    )
    carried = (
        maps.repartition("k")
        .sortWithinPartitions("k", "chunk", "entry_to")
        .mapInPandas(_carry(window_us), "k string, chunk bigint, carried bigint")
    )
    markers = carried.select(
        "k",
        "chunk",
        F.lit(_NONE).cast("bigint").alias("us"),
        F.lit(None).cast("bigint").alias("id"),
        "carried",
    )
    rows = events.select("*", F.lit(_NONE).cast("bigint").alias("carried"))
    return (
        rows.unionByName(markers)
        .repartition("k", "chunk")
        .sortWithinPartitions("k", "chunk", "us", "id")
        .mapInPandas(
            _assign(chunk_us, window_us), "k string, us bigint, id bigint, window_start bigint"
        )
    )


def quota_flags(
    df: DataFrame,
    key: str,
    micros: str,
    event_id: str,
    limit: int = LIMIT_PER_WINDOW,
    window_seconds: int = WINDOW_SECONDS,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Every event with its window, its number in the window, and whether it is within quota.

    Rejected events still count. Events without a key share the key ``unknown``; those without a
    time are in no window, have neither number nor window start and are not allowed. Numbering cuts a window into pieces of a sixtieth, so even a
    window that holds very many events is not numbered by one task.
    """
    piece_us = max(int(window_seconds * 1_000_000) // 60, 1)
    placed = window_starts(df, key, micros, event_id, window_seconds, chunk_seconds).withColumn(
        "piece", F.expr(f"(us - window_start) div {piece_us}L")
    )
    numbered = bucketed_row_number(
        placed, ["k", "window_start"], "piece", ["us", "id"], "n_in_window"
    )
    flagged = numbered.select(
        F.col("k").alias("key"),
        F.col("id").alias("event_id"),
        F.col("us").alias("ts_us"),
        F.col("window_start").alias("window_start_us"),
        "n_in_window",
        (F.col("n_in_window") <= limit).alias("allowed"),
    )
    absent = F.lit(None).cast("bigint")
    untimed = df.filter(F.col(micros).cast("bigint").isNull()).select(
        _known(key).alias("key"),
        F.col(event_id).cast("bigint").alias("event_id"),
        absent.alias("ts_us"),
        absent.alias("window_start_us"),
        absent.cast(flagged.schema["n_in_window"].dataType).alias("n_in_window"),
        F.lit(False).alias("allowed"),
    )
    return flagged.unionByName(untimed)
