"""Transfers watched as a stream with state and timers: the alerts of ``operators.transfers.transfer_alerts``.

A deadline fires by a timer once the watermark has passed it, whether or not another sample of its key comes. Needs the
RocksDB state store (``spark.sql.streaming.stateStore.providerClass``), whose state survives lost executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.transfers import ALERT, Transfer, Watch, deadline, pass_time, take_sample

SAMPLE = "event_id long, user_id long, t long, done long, size long, discard boolean"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_MARKS = "best long, last long, bytes long, slow boolean, tail long"


class TransferWatch(StatefulProcessor):
    """One key's transfer: marks in a value, samples of the window in a list, the deadline in a timer."""

    def __init__(self, watch: Watch, key: str) -> None:
        self.watch, self.key = watch, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.marks = handle.getValueState("marks", _MARKS)
        self.samples = handle.getListState("samples", "t long, bytes long")

    def _load(self) -> Transfer:
        if not self.marks.exists():
            return Transfer()
        best, last, done, slow, tail = self.marks.get()
        return Transfer(best, last, done, slow, tail, [tuple(s) for s in self.samples.get()])

    def _store(self, state: Transfer) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        due = deadline(self.watch, state)
        if due is None:  # over: nothing of the key stays in the store
            self.marks.clear()
            self.samples.clear()
            return
        self.marks.update((state.best, state.last, state.bytes, state.slow, state.tail))
        self.samples.put(state.samples)
        self.handle.registerTimer(1000 * due)

    def _rows(self, key: tuple, alerts: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(alerts, columns=["t", "alert", "bytes"])
        frame.insert(0, self.key, key[0])
        return frame

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state, alerts = self._load(), []
        frame = pd.concat(list(rows)).sort_values(["t", "event_id"])
        for t, done, size, discard in zip(frame["t"], frame["done"], frame["size"], frame["discard"], strict=True):
            state, new = take_sample(self.watch, state, int(t), int(done), int(size), bool(discard))
            alerts += new
        self._store(state)
        yield self._rows(key, alerts)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state, alerts = pass_time(self.watch, self._load(), expiredTimerInfo.getExpiryTimeInMs() // 1000)
        self._store(state)
        yield self._rows(key, alerts)

    def close(self) -> None:
        pass


def watch_transfers(samples: DataFrame, watch: Watch, *, key: str = "user_id", late: str = "0 seconds") -> DataFrame:
    """Alerts of a stream of samples (``SAMPLE``). Samples of a key must not go back in time from batch to batch; what is
    older than the newest sample by more than ``late`` is left out by the watermark."""
    timed = samples.withColumn("at", F.timestamp_seconds("t")).withWatermark("at", late)
    kind = samples.schema[key].dataType.simpleString()
    return timed.groupBy(key).transformWithStateInPandas(
        TransferWatch(watch, key), outputStructType=f"{key} {kind}, {ALERT}", outputMode="Append", timeMode="EventTime"
    )
