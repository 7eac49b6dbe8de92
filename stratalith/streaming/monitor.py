"""The idle watch as a stateful stream: the same rows as ``operators.monitor.idle_gaps`` on the same samples."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SAMPLE = "event_id long, user_id long, t long, cents long"


def idle_stream(samples: DataFrame, *, late: str = "1 hour", keep_seconds: int = 7 * 86400) -> DataFrame:
    """Idle seconds of each sample of a stream of (event_id, user_id, t, cents).

    A key's state is the highest amount so far and when it was reached. Samples of a key are taken in
    time order within a batch; batches must not go back in time for a key. A key leaves the store once the
    watermark (``late`` behind the newest sample) has passed its last sample by ``keep_seconds``; if it comes again
    it begins anew.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, since = state.get if state.exists else (None, None)
        rows = pd.concat(list(parts)).sort_values(["t", "event_id"])
        idle = []
        for t, cents in zip(rows["t"], rows["cents"], strict=True):
            if best is None or cents > best:
                best, since = int(cents), int(t)
            idle.append(int(t) - since)
        state.update((best, since))
        state.setTimeoutTimestamp(max(1000 * int(rows["t"].iloc[-1]), state.getCurrentWatermarkMs()) + 1000 * keep_seconds)
        yield rows.assign(user_id=key[0], idle_seconds=idle)[["event_id", "user_id", "t", "cents", "idle_seconds"]]

    timed = samples.withColumn("at", F.timestamp_seconds("t")).withWatermark("at", late)
    return timed.groupBy("user_id").applyInPandasWithState(
        step, f"{SAMPLE}, idle_seconds long", "best long, since long", "append", GroupStateTimeout.EventTimeTimeout
    )


def windowed_counts(events: DataFrame, *, time: str, kind: str, width: str, late: str) -> DataFrame:
    """Counts by kind in event-time windows; a window closes once the watermark has passed it."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), kind, "n"
    )
