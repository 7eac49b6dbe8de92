"""Alerts of transfers, in batch and as a stream with timers."""

import random

import pytest
from pyspark.sql import functions as F

from stratalith.operators.transfers import Watch, transfer_alerts
from stratalith.streaming import transfers

WATCH = Watch(idle=300, window=100, least_rate=1.0, tail_percent=5.0, grace=1200)


def batch(spark, rows, until, watch=WATCH):
    df = spark.createDataFrame(rows, transfers.SAMPLE).repartition(3)
    found = transfer_alerts(df, watch, key="user_id", time="t", tie="event_id", done=F.col("done"), size=F.col("size"), discard=F.col("discard"), until=until)
    return sorted(tuple(r) for r in found.collect())


def rows_of(key, *samples, size=10_000):
    return [(key * 1000 + k, key, t, done, size, discard) for k, (t, done, discard) in enumerate(samples)]


@pytest.mark.parametrize(
    "samples, until, want",
    [
        ([(0, 0, False), (100, 50, False), (200, 60, False)], 400, [(1, 100, "slow", 50)]),
        ([(0, 0, False), (100, 500, False), (200, 510, False), (300, 2000, False), (400, 2010, False)], 500, [(1, 200, "slow", 510), (1, 400, "slow", 2010)]),
        ([(0, 5, False)], 299, []),
        ([(0, 5, False)], 300, [(1, 300, "idle", 5)]),  # no sample comes, the deadline fires
        ([(0, 5, False), (250, 900, False)], 549, []),
        ([(0, 9000, False), (90, 100, False), (180, 8000, False), (299, 8999, False)], 300, [(1, 180, "slow", 8000), (1, 300, "idle", 8999)]),  # below the highest mark is no progress
        ([(0, 500, False), (250, 0, True), (290, 100, False)], 589, []),  # after a roll-back any growth is
        ([(0, 500, False), (250, 0, True)], 300, [(1, 300, "idle", 0)]),
        ([(0, 500, False), (50, 10_000, False)], 10_000, []),  # complete
        ([(0, 500, False), (400, 600, False), (450, 700, False)], 500, [(1, 300, "idle", 500)]),  # given up, then begun anew
        # the tail: no word of slowness for 1200 seconds, from the roll-back anew
        ([(0, 9600, False), *((t, 9600 + t // 100, False) for t in range(100, 1500, 100))], 1500, [(1, 1300, "slow", 9613)]),
        ([(0, 9600, False), (100, 9601, False), (150, 0, True), (200, 9700, False), *((t, 9700 + t // 100, False) for t in range(300, 1700, 100))], 1700, [(1, 1500, "slow", 9715)]),
    ],
)
def test_alerts(spark, samples, until, want):
    assert batch(spark, rows_of(1, *samples), until) == want


def test_no_samples(spark):
    assert batch(spark, [], 100) == []


def test_stream_with_timers_is_the_batch(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for key in range(1, 13):
        t, done = rng.randint(0, 200), 0
        for k in range(rng.randint(1, 25)):
            discard = rng.random() < 0.1
            done = 0 if discard else max(0, done + rng.choice([0, 20, 300, 900, -50]))
            rows.append((key * 1000 + k, key, t, done, 4000, discard))
            t += rng.choice([10, 60, 90, 150, 320])
    end = max(r[2] for r in rows)
    clock = [(90_000, 99, end + 1000, 1, 4000, False), (90_001, 99, end + 1001, 2, 4000, False), (90_002, 99, end + 1002, 3, 4000, False)]
    edges = [0, 400, 800, 1300, end + 1]
    parts = [[r for r in rows if a <= r[2] < z] for a, z in zip(edges, edges[1:])] + [[c] for c in clock]
    conf = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(conf)
    spark.conf.set(conf, transfers.ROCKSDB)
    try:
        for k, part in enumerate(parts):
            spark.createDataFrame(part, transfers.SAMPLE).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        stream = spark.readStream.schema(transfers.SAMPLE).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{tmp_path}/in")
        query = transfers.watch_transfers(stream, WATCH).writeStream.format("memory").queryName("alerts").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").start()
        query.processAllAvailable()
        query.stop()
    finally:
        spark.conf.set(conf, before)
    got = sorted(tuple(r) for r in spark.sql("SELECT user_id, t, alert, bytes FROM alerts").collect())
    want = batch(spark, rows, end + 1000)
    assert got == want and {a for _, _, a, _ in want} == {"idle", "slow"}
