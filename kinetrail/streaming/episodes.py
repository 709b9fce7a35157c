"""Structured Streaming forms of the audits, for frames that arrive while an episode is recorded."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def first_wins(stream: DataFrame, fingerprint: str, time: str, late: str = "1 hour") -> DataFrame:
    """The first row of each fingerprint; state is dropped as the watermark passes."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([fingerprint])


def rates(stream: DataFrame, key: str, time: str, window: str = "10 seconds", late: str = "1 minute") -> DataFrame:
    """Frames and value moments by key and time window, each window once when it is complete."""
    grouped = stream.withWatermark(time, late).groupBy(F.window(time, window), key)
    return grouped.agg(F.count(F.lit(1)).alias("frames"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")).select(key, F.col("window.start").alias("start"), F.col("window.end").alias("stop"), "frames", "mean", "std")


def count_windows(stream: DataFrame, key: str, width: int, stride: int, idle_ms: int | None = None) -> DataFrame:
    """(key, start, first, last): sliding windows by count of rows, emitted as soon as they fill. Rows of a key arrive in order of idx.

    State is the last ``width`` values of each key; with ``idle_ms`` a key that is idle for so long is
    forgotten, as a stream that never ends needs; a run that drains its input must go without."""
    out = f"{key} bigint, start bigint, first double, last double"

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, values = state.get if state.exists else (0, [])
        values, made = list(values), []
        for value in pd.concat(list(batches)).sort_values("idx")["value"].tolist():
            values.append(value)
            seen += 1
            values = values[-width:]
            start = seen - width
            if start >= 0 and start % stride == 0:
                made.append((group[0], start, values[0], values[-1]))
        state.update((seen, values))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame(made, columns=[key, "start", "first", "last"])

    return stream.groupBy(key).applyInPandasWithState(step, out, "seen bigint, tail array<double>", "append", GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)


def unwrapped(stream: DataFrame, key: str, idle_ms: int | None = None) -> DataFrame:
    """(key, idx, unwrapped): angles without whole turns between neighbours, carried over batches by the last angle of each key, until the key is idle
    for ``idle_ms``."""
    import math

    out = f"{key} bigint, idx bigint, unwrapped double"

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        made = []
        for idx, value in pd.concat(list(batches)).sort_values("idx")[["idx", "value"]].itertuples(index=False):
            if value is not None and math.isfinite(value):
                if last is not None and abs(value - last) > math.pi:
                    turns = math.ceil((abs(value - last) - math.pi) / (2 * math.pi))
                    value -= math.copysign(2 * math.pi * turns, value - last)
                last = value
            made.append((group[0], idx, value))
        if last is not None:
            state.update((last,))
            if idle_ms:
                state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame(made, columns=[key, "idx", "unwrapped"])

    return stream.groupBy(key).applyInPandasWithState(step, out, "last double", "append", GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)
