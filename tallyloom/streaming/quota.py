"""Streaming quota flags with one small state per key, or with a bound on all keys.

The state is the start of the open window and its count. It is dropped once the watermark
passes the end of the window, so memory follows the keys active in the last window. With a bound,
keys are dealt into buckets, and a bucket holds the windows of so many keys at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyloom.operators.quota import LIMIT_PER_WINDOW, UNKNOWN_KEY, WINDOW_SECONDS
from tallyloom.session import ship_by_value

_OUT = (
    "key string, event_id bigint, ts_us bigint, window_start_us bigint, "
    "n_in_window bigint, allowed boolean"
)
_STATE = "start_us bigint, n bigint"
_BUCKET_STATE = "keys array<string>, starts_us array<bigint>, counts array<bigint>"

ship_by_value(__name__)


def _walk(us: np.ndarray, opened: tuple, window_us: int) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Window start and number of each of a key's events, and the window left open."""
    start, count = opened
    starts = np.empty(len(us), dtype=np.int64)
    numbers = np.empty(len(us), dtype=np.int64)
    at = 0
    while at < len(us):
        if start is None or us[at] - start >= window_us:
            start, count = int(us[at]), 0
        end = max(int(np.searchsorted(us, start + window_us, side="left")), at + 1)
        starts[at:end] = start
        numbers[at:end] = count + np.arange(1, end - at + 1)
        count += end - at
        at = end
    return starts, numbers, (start, int(count))


def _step(limit: int, window_us: int):
    def run(
        key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames), ignore_index=True).sort_values(["ts_us", "event_id"])
        us = rows["ts_us"].to_numpy(np.int64)
        opened = state.get if state.exists else (None, 0)
        starts, numbers, (start, count) = _walk(us, opened, window_us)
        state.update((start, count))
        watermark = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max((start + window_us) // 1000 + 1, watermark + 1))
        yield pd.DataFrame(
            {
                "key": key[0],
                "event_id": rows["event_id"].to_numpy(),
                "ts_us": us,
                "window_start_us": starts,
                "n_in_window": numbers,
                "allowed": numbers <= limit,
            }
        )

    return run


def _bucket_step(limit: int, window_us: int, most: int):
    """The same for all keys of a bucket, whose state holds at most ``most`` windows."""

    def run(
        key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        opened = {k: (s, n) for k, s, n in zip(*state.get)} if state.exists else {}
        flagged = []
        if not state.hasTimedOut:
            rows = pd.concat(list(frames), ignore_index=True)
            rows = rows.sort_values(["key", "ts_us", "event_id"], ignore_index=True)
            for name, own in rows.groupby("key", sort=False):
                us = own["ts_us"].to_numpy(np.int64)
                starts, numbers, opened[name] = _walk(us, opened.get(name, (None, 0)), window_us)
                flagged.append(
                    own.assign(window_start_us=starts, n_in_window=numbers, allowed=numbers <= limit)
                )
        watermark = state.getCurrentWatermarkMs()
        # no event before the watermark can come any more
        live = [(s, k, n) for k, (s, n) in opened.items() if s + window_us > watermark * 1000]
        if len(live) > most:
            live = sorted(live)[-max(1, most // 2) :]
        if live:
            starts, keys, counts = map(list, zip(*live))
            state.update((keys, starts, counts))
            state.setTimeoutTimestamp(max((min(starts) + window_us) // 1000 + 1, watermark + 1))
        elif state.exists:
            state.remove()
        for frame in flagged:
            yield frame[["key", "event_id", "ts_us", "window_start_us", "n_in_window", "allowed"]]

    return run


def stream_quota_flags(
    events: DataFrame,
    key: str,
    micros: str,
    event_id: str,
    limit: int = LIMIT_PER_WINDOW,
    window_seconds: int = WINDOW_SECONDS,
    delay: str | None = None,
    max_keys: int | None = None,
    buckets: int = 64,
) -> DataFrame:
    """Streaming form of ``quota_flags`` for events that arrive in time order per key.

    An event that arrives out of order counts in its key's open window. Events more than
    ``delay`` (by default one window) behind the newest event seen are dropped, because the
    state they belong to may be gone. As in the batch form, events without a key share one key, and
    those without a time are in no window and not allowed. Only one trigger's rows of a key are held at a time;
    bound them with the source's per-trigger limits.

    Without ``max_keys`` every key with an open window has its state. With it, keys are dealt into
    ``buckets`` by hash, which must stay the same for a checkpoint, and each bucket keeps the
    windows of its share of ``max_keys``. A bucket that has more after a trigger keeps the newest
    half of its share; a key whose window was given up starts a new one at its next event, so its
    count may begin anew. Flags are those of the unbounded form as long as no bucket overflows.
    """
    if max_keys is not None and max_keys < buckets:
        raise ValueError(f"max_keys is {max_keys}, less than one key for each of {buckets} buckets")
    delay = delay or f"{window_seconds} seconds"
    slim = events.select(
        F.coalesce(F.col(key).cast("string"), F.lit(UNKNOWN_KEY)).alias("key"),
        F.col(micros).cast("bigint").alias("ts_us"),
        F.col(event_id).cast("bigint").alias("event_id"),
        F.timestamp_micros(F.col(micros)).alias("event_time"),
    )
    absent = F.lit(None).cast("bigint")
    untimed = slim.filter("ts_us IS NULL").select(
        "key",
        "event_id",
        "ts_us",
        absent.alias("window_start_us"),
        absent.alias("n_in_window"),
        F.lit(False).alias("allowed"),
    )
    timed = slim.filter("ts_us IS NOT NULL").withWatermark("event_time", delay)
    window_us = int(window_seconds * 1_000_000)
    if max_keys is None:
        grouped, step, state = timed.groupBy("key"), _step(limit, window_us), _STATE
    else:
        dealt = timed.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
        grouped = dealt.groupBy("bucket")
        step, state = _bucket_step(limit, window_us, max_keys // buckets), _BUCKET_STATE
    flagged = grouped.applyInPandasWithState(
        step,
        outputStructType=_OUT,
        stateStructType=state,
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )
    return flagged.unionByName(untimed)
