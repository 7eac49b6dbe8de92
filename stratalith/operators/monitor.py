"""Watching progress series: idle files, slow transfers, state that carries over undecided rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seconds_of(time: Column) -> Column:
    return time.cast("timestamp").cast("long")


def idle_gaps(samples: DataFrame, *, key: str, time: Column, tie: str, amount: Column) -> DataFrame:
    """Seconds since a series last rose above all before it; 0 on a row that rises."""
    order = Window.partitionBy(key).orderBy(time, tie)
    own = samples.withColumn("_t", seconds_of(time))
    before = F.max(amount).over(order.rowsBetween(Window.unboundedPreceding, -1))
    own = own.withColumn("rises", F.coalesce(amount > before, F.lit(True)))
    last = F.last(F.when(F.col("rises"), F.col("_t")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return own.withColumn("idle_seconds", F.col("_t") - last).drop("_t")


def cumulative(samples: DataFrame, *, key: str, time: Column, tie: str, amount: Column, bucket_seconds: int = 3600) -> DataFrame:
    """``total``: sum of a key's amounts so far, in order of time (whole seconds) and ``tie``.

    Summed within buckets of time, and over the buckets before, so a key of many rows is spread over tasks.
    """
    own = samples.withColumn("_bucket", F.floor(time / bucket_seconds))
    sums = own.groupBy(key, "_bucket").agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(key, "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(key, "_bucket").orderBy(time, tie).rowsBetween(Window.unboundedPreceding, 0)
    found = own.withColumn("_within", F.sum(amount).over(within)).join(sums, [key, "_bucket"])
    return found.select(*samples.columns, (F.col("_within") + F.col("_before")).alias("total"))


def slow_windows(samples: DataFrame, *, key: str, time: Column, tie: str, total: str, seconds: int, least_rate: float) -> DataFrame:
    """Speed against the latest sample at least ``seconds`` old, whether it is slow, and where that begins.

    base_total is null, and slow too, while the series is younger than the window.
    """
    own = samples.withColumn("_t", seconds_of(time))
    old = Window.partitionBy(key).orderBy("_t").rangeBetween(Window.unboundedPreceding, -seconds)
    base = F.max(F.struct(F.col("_t").alias("t"), F.col(tie).alias("tie"), F.col(total).alias("total"))).over(old)
    own = own.withColumn("_base", base)
    speed = (F.col(total) - F.col("_base.total")) / (F.col("_t") - F.col("_base.t"))
    own = own.withColumn("base_total", F.col("_base.total")).withColumn("speed", F.round(speed, 6))
    own = own.withColumn("slow", speed < least_rate)
    order = Window.partitionBy(key).orderBy("_t", tie)
    begins = F.col("slow") & ~F.coalesce(F.lag("slow").over(order), F.lit(False))
    return own.withColumn("begins", F.coalesce(begins, F.lit(False))).drop("_t", "_base")


def carry_state(samples: DataFrame, *, key: str, order: list[Column | str], state: Column) -> DataFrame:
    """The last decided state at each row; undecided (null) rows keep the one before, false at first."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return samples.withColumn("state", F.coalesce(F.last(state, ignorenulls=True).over(w), F.lit(False)))


def islands(rows: DataFrame, *, key: str, time: Column, tie: str, kind: str, most_gap: int, least_rows: int = 2) -> DataFrame:
    """Runs of rows of one kind without a gap of over ``most_gap`` seconds, of so many rows at least."""
    order = Window.partitionBy(key).orderBy("_t", tie)
    own = rows.withColumn("_t", seconds_of(time))
    new = (F.lag(kind).over(order) != F.col(kind)) | (F.col("_t") - F.lag("_t").over(order) > most_gap)
    own = own.withColumn("_new", F.coalesce(new, F.lit(True)).cast("int"))
    own = own.withColumn("island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = own.groupBy(key, "island").agg(
        F.first(kind).alias(kind), F.count("*").alias("n_rows"), F.min("_t").alias("first_second"), F.max("_t").alias("last_second")
    )
    return found.where(F.col("n_rows") >= least_rows)


def look_ahead(rows: DataFrame, *, key: str, order: list[str], wanted: Column, steps: int) -> DataFrame:
    """Whether one of the next ``steps`` rows is wanted."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(1, steps)
    return rows.withColumn("ahead", F.coalesce(F.max(wanted.cast("int")).over(w), F.lit(0)) == 1)


def epochs(rows: DataFrame, *, key: str, order: list[str], discard: Column) -> DataFrame:
    """Number of discards so far: progress is compared within an epoch alone."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("epoch", F.sum(discard.cast("int")).over(w))


class ProgressFold:
    """When to report progress: each ``step`` of percent, or when ``seconds`` have passed since the last report."""

    def __init__(self, *, step: int, seconds: int, whole: float) -> None:
        self.step, self.seconds, self.whole = step, seconds, whole

    def start(self) -> tuple:
        return 0.0, -1, None, 0

    def take(self, state: tuple, sample: dict) -> tuple:
        done, level, last, reports = state
        done += sample["amount"] or 0.0
        now_level = int(100 * done / self.whole) // self.step
        due = last is None or now_level > level or sample["t"] - last >= self.seconds
        return (done, now_level, sample["t"], reports + 1) if due else (done, level, last, reports)

    def finish(self, state: tuple) -> int:
        return state[3]
