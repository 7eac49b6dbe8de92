"""Watching transfers: deadlines without progress, slow windows, and a grace for the tail that a roll-back begins anew."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .integrity import fold_ordered

ALERT = "t long, alert string, bytes long"


@dataclass(frozen=True)
class Watch:
    """What is watched, in whole seconds and bytes.

    ``idle``: a transfer that has not passed its highest mark for so long is given up. ``window`` and ``least_rate``: it is
    slow if it grew by less than that rate since the latest sample at least a window old. ``tail_percent`` and ``grace``:
    with so little left, it is not called slow until it has been there for longer than the grace.
    """

    idle: int
    window: int
    least_rate: float
    tail_percent: float = 0.0
    grace: int = 0


@dataclass
class Transfer:
    """State of one transfer; ``last`` is when it last passed its highest mark, ``best``."""

    best: int = 0
    last: int | None = None
    bytes: int = 0
    slow: bool = False
    tail: int | None = None
    samples: list[tuple[int, int]] = field(default_factory=list)


def deadline(watch: Watch, state: Transfer) -> int | None:
    """When the transfer is given up, if nothing comes; null for one that is not running."""
    return None if state.last is None else state.last + watch.idle


def pass_time(watch: Watch, state: Transfer, now: int) -> tuple[Transfer, list[tuple[int, str, int]]]:
    """The state at a time, and the alert if the deadline was reached by then; the transfer is over by that."""
    due = deadline(watch, state)
    if due is None or now < due:
        return state, []
    return Transfer(), [(due, "idle", state.bytes)]


def take_sample(watch: Watch, state: Transfer, t: int, done: int, size: int, discard: bool) -> tuple[Transfer, list[tuple[int, str, int]]]:
    """The state after a sample, and its alerts. One that is over, complete or given up, begins anew."""
    state, alerts = pass_time(watch, state, t)
    if state.last is None:
        state = Transfer(best=0 if discard else done, last=t)
    elif discard:  # what was there is thrown away, which is no progress
        state = Transfer(last=state.last)
    elif done > state.best:
        state.best, state.last = done, t
    state.bytes = 0 if discard else done
    if state.bytes >= size:
        return Transfer(), alerts
    state.samples.append((t, state.bytes))
    while len(state.samples) > 1 and state.samples[1][0] <= t - watch.window:
        state.samples.pop(0)
    in_tail = watch.tail_percent > 0 and (size - state.bytes) * 100 <= size * watch.tail_percent
    state.tail = None if not in_tail else t if state.tail is None else state.tail
    began, base = state.samples[0]
    if t - began < watch.window or (in_tail and t - state.tail <= watch.grace):
        return state, alerts
    slow = max(0, state.bytes - base) < watch.least_rate * (t - began)
    if slow and not state.slow:
        alerts.append((t, "slow", state.bytes))
    state.slow = slow
    return state, alerts


def transfer_alerts(samples: DataFrame, watch: Watch, *, key: str, time: str, tie: str, done: Column, size: Column, discard: Column, until: int) -> DataFrame:
    """(key, t, alert, bytes): when transfers became slow, and when they were given up, deadlines up to ``until`` included.

    One pass over each key's samples in order, with the samples of one window in memory.
    """

    def step(state: tuple, s: dict) -> tuple:
        own, alerts = take_sample(watch, state[0], s["t"], s["done"], s["size"], s["discard"])
        return own, state[1] + alerts

    def end(state: tuple) -> list[dict]:
        alerts = state[1] + pass_time(watch, state[0], until)[1]
        return [dict(zip(("t", "alert", "bytes"), a, strict=True)) for a in alerts]

    sample = F.struct(F.col(time).alias("t"), done.cast("long").alias("done"), size.cast("long").alias("size"), F.coalesce(discard, F.lit(False)).alias("discard"))
    rows = samples.select(key, time, tie, sample.alias("_sample"))
    found = fold_ordered(rows, key, [time, tie], "_sample", lambda: (Transfer(), []), step, end, f"array<struct<{ALERT.replace(' ', ':')}>>".replace(",:", ","))
    return found.select(key, F.explode("result").alias("a")).select(key, "a.t", "a.alert", "a.bytes")
