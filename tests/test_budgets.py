"""Interval joins, chunks and batches against loops."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from stratalith.operators import budgets, intervals


def innermost(points, held):
    out = []
    for p, k, at in points:
        around = [(-s, e, i) for i, kk, s, e in held if None not in (k, s, e, at) and kk == k and s <= at < e]
        s, e, i = min(around) if around else (None, None, None)
        out.append((p, i, None if s is None else -s, e))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_innermost_interval(spark, seed):
    rng = random.Random(seed)
    reach = [40, 10_000, 1 << 40][seed]
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", None])
    held = []
    for i in range(150):
        s = rng.randint(-reach, reach)
        held.append((i, key(), s, s + rng.choice([0, 1, rng.randint(-3, reach // 4), reach])))
    held += [(200, "hot", None, 3), (201, "hot", 3, None), (202, "hot", 5, 5), (203, "a", -reach * 2, reach * 2)]
    held += [(300 + i, "hot", *held[i][2:]) for i in range(20)]  # equal intervals: the smallest id
    points = [(i, key(), rng.randint(-reach, reach)) for i in range(300)] + [(1000 + i, k, s) for i, k, s, e in held] + [(2000 + i, k, e) for i, k, s, e in held] + [(5000, "hot", None)]
    df = intervals.containing(
        spark.createDataFrame(points, "p long, k string, at long"), spark.createDataFrame(held, "p long, k string, s long, e long"), key="k", point="p", at="at", interval="p", start="s", end="e"
    )
    assert sorted((r.p, r.owner, r.owner_start, r.owner_end) for r in df.collect()) == innermost(points, held)


def test_nodes_by_shuffle_and_empty_sides(spark, monkeypatch):
    points, held = [(1, "a", 5), (2, "b", 5)], [(7, "a", 0, 9), (8, "a", 4, 6)]
    make = lambda ps, hs: intervals.containing(
        spark.createDataFrame(ps, "p long, k string, at long"), spark.createDataFrame(hs, "i long, k string, s long, e long"), key="k", point="p", at="at", interval="i", start="s", end="e"
    )
    monkeypatch.setattr(intervals, "BROADCAST_NODES", 0)
    assert sorted(map(tuple, make(points, held).collect())) == [(1, "a", 5, 8, 4, 6), (2, "b", 5, None, None, None)]
    assert make([], held).collect() == []
    assert [r.owner for r in make(points, []).collect()] == [None, None]


def test_an_interval_has_few_pieces(spark):
    rows = spark.range(1).select(F.lit(-(1 << 50) + 1).alias("_s"), F.lit((1 << 50) - 1).alias("_e"))
    pieces = rows.select(F.explode(F.expr(intervals._PIECES)).alias("x")).select("x.*").collect()
    spans = sorted((r.node << r.level, (r.node + 1) << r.level) for r in pieces)
    assert len(spans) <= 104 and spans[0][0] == -(1 << 50) + 1 and spans[-1][1] == (1 << 50) - 1
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_latest_that_passes(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), rng.randint(0, 400), rng.randint(0, 9)) for i in range(200)]
    anchors, points = rows[:60], rows[60:]
    want = []
    for a in anchors:
        fit = [p for p in points if p[1] == a[1] and a[2] - 50 <= p[2] < a[2] and p[3] > a[3]]
        want += [(a[0], p[0]) for p in fit if p[2] == max(x[2] for x in fit)]
    own = "i long, k string, t long, v long"
    got = intervals.latest_before(spark.createDataFrame(anchors, own), spark.createDataFrame(points, own), key="k", anchor="i", time="t", reach=50, passes=F.col("point.v") > F.col("v"))
    assert sorted((r.i, r.point.i) for r in got.collect()) == sorted(want)


def greedy(sizes, budget):
    chunk, load, out = 0, None, []
    for s in sizes:
        if load is not None and load + s > budget:
            chunk, load = chunk + 1, 0
        load = (load or 0) + s
        out.append(chunk)
    return out


@pytest.mark.parametrize("budget, tile", [(10, 7), (1, 5), (100, 9), (100_000, 20), (37, 1), (37, 1000)])
def test_chunks_are_those_of_a_loop(spark, budget, tile):
    rng = random.Random(budget)
    sizes = [rng.choice([0, 0, 1, 3, 8, 40, rng.randint(0, 20)]) for _ in range(230)] + [0, 500, 0, 500]
    rows = spark.createDataFrame([(k, s, "x") for k, s in enumerate(sizes)], "k long, size long, chunk_of string").repartition(3)
    found = budgets.byte_chunks(rows, order=["k"], size="size", budget=budget, tile_rows=tile)
    assert found.columns == ["k", "size", "chunk_of", "chunk"]
    assert [r.chunk for r in found.sort("k").collect()] == greedy(sizes, budget)


def test_chunks_of_nothing_and_of_nulls(spark):
    assert budgets.byte_chunks(spark.createDataFrame([], "k long, s long"), order=["k"], size="s", budget=3).collect() == []
    rows = spark.createDataFrame([(1, None), (2, 3), (3, None), (4, 1)], "k long, s long")
    assert [r.chunk for r in budgets.byte_chunks(rows, order=["k"], size="s", budget=3).sort("k").collect()] == [0, 0, 0, 1]


def test_deal_is_that_of_a_loop():
    for seed in range(400):
        rng = random.Random(seed)
        histogram = {rng.randint(0, 12): rng.randint(1, 40) for _ in range(rng.randint(1, 8))}
        capacity = rng.randint(1, 9)
        bins = -(-sum(histogram.values()) // capacity) + rng.choice([0, 0, 2])
        heap, want = [(0, b) for b in range(bins)], [[0, 0] for _ in range(bins)]
        for size in sorted(histogram, reverse=True):
            for _ in range(histogram[size]):
                load, b = heapq.heappop(heap)
                want[b] = [load + size, want[b][1] + 1]
                if want[b][1] < capacity:
                    heapq.heappush(heap, (load + size, b))
        got = [[0, 0] for _ in range(bins)]
        for size, _, items, first, each in budgets.deal_by_load(histogram, bins, capacity)[0]:
            for k in range(items):
                got[first + k // each][0] += size
                got[first + k // each][1] += 1
        assert got == want


def test_deal_of_many_alike_is_short():
    rows, groups = budgets.deal_by_load({9: 5_000_000, 4: 3_000_000, 1: 2_000_000}, 10_000_000 // 64, 64)
    assert len(rows) < 1000 and sum(g[2] for g in groups) == 10_000_000 // 64


def test_batches_are_full_and_whole(spark):
    rows = spark.createDataFrame([(k, k * k % 17 if k % 9 else None, "x") for k in range(203)], "k long, s long, rank string")
    found = budgets.capped_batches(rows, item="k", size="s", capacity=10).collect()
    counts = {}
    for r in found:
        counts[r.batch] = counts.get(r.batch, 0) + 1
    assert sorted(r.k for r in found) == list(range(203)) and len(counts) == 21 and max(counts.values()) <= 10
    assert budgets.capped_batches(rows.limit(0), item="k", size="s", capacity=10).collect() == []
