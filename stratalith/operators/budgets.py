"""Batches under a budget: chunks of neighbours by bytes, and balanced batches that close when they are full."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.checkpoints import kept, release
from .planning import MOST_SIZES, rank_within

#: Rows of a tile of ``byte_chunks``, which a task holds.
TILE_ROWS = 500_000


def _jumps(before: np.ndarray, after: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """(where the next chunk starts, the last start within the tile), for a chunk that starts at each row."""
    n = len(before)
    onward = np.maximum(np.searchsorted(after, before + budget, "right"), np.arange(1, n + 1))
    last = np.where(onward < n, onward, np.arange(n))
    while True:
        further = last[last]
        if (further == last).all():
            return onward, last
        last = further


def byte_chunks(rows: DataFrame, *, order: list[str], size: str, budget: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``chunk``: neighbours in an order, from 0; a row begins a new chunk if the one before would pass ``budget`` with it.

    A row larger than the budget is a chunk of its own; null sizes count as 0. The order must tell rows apart.

    Where a chunk ends depends on where it begins. Rows are cut into tiles of the order. Each tile tells from sums so far
    which of its rows would be the last to begin a chunk in it, for any row that may be the first to. These last ones are
    linked to those of the tile where the next chunk begins, and the links from the very first are walked
    by doubling. So each tile learns its first start, and cuts its rows by itself. The driver sees a sum for each tile.
    """
    n, columns = rows.count(), rows.columns
    tiles = max(1, -(-n // tile_rows))
    own = rows.withColumn("_size", F.greatest(F.lit(0), F.coalesce(F.col(size).cast("long"), F.lit(0))))
    placed = own.repartitionByRange(tiles, *order).withColumn("_tile", F.spark_partition_id())
    within = Window.partitionBy("_tile").orderBy(*order)
    placed = placed.withColumn("_pos", F.row_number().over(within).cast("long") - 1).withColumn("_after", F.sum("_size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    placed = kept(placed)
    sums = {r["_tile"]: (r["s"], r["n"]) for r in placed.groupBy("_tile").agg(F.max("_after").alias("s"), F.count("*").alias("n")).collect()}
    if not sums:
        release(placed)
        return rows.withColumn("chunk", F.lit(0).cast("long"))
    present = np.array(sorted(sums))
    ends = np.cumsum([sums[t][0] for t in present])
    base = dict(zip(present.tolist(), [0, *ends[:-1].tolist()], strict=True))
    first_row = dict(zip(present.tolist(), [0, *np.cumsum([sums[t][1] for t in present])[:-1].tolist()], strict=True))

    def sorted_tile(table: pa.Table) -> tuple[int, pa.Table, np.ndarray, np.ndarray]:
        table = table.sort_by("_pos")
        tile = table.column("_tile")[0].as_py()
        after = table.column("_after").to_numpy() + base[tile]
        return tile, table, after - table.column("_size").to_numpy(), after

    def leave(table: pa.Table) -> pa.Table:
        tile, _, before, after = sorted_tile(table)
        onward, last = _jumps(before, after, budget)
        out = np.flatnonzero(onward == len(before))
        goal = before[out] + budget
        # a row larger than the budget reaches the next tile's first row, where the sum is beyond its goal already
        to = np.maximum(np.searchsorted(ends, goal, "right"), np.searchsorted(present, tile) + 1)
        out, goal, to = out[to < len(present)], goal[to < len(present)], to[to < len(present)]
        return pa.table({"a": out + first_row[tile], "goal": goal, "_tile": pa.array(present[to], pa.int32())})

    def enter(table: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "_tile": pa.array([], pa.int32()), "entry": pa.array([], pa.int64())})
        tile, _, before, after = sorted_tile(table)
        _, last = _jumps(before, after, budget)
        entry = np.searchsorted(after, asked.column("goal").to_numpy(), "right")
        return pa.table({"a": asked.column("a"), "b": last[entry] + first_row[tile], "_tile": pa.array(np.full(len(entry), tile), pa.int32()), "entry": entry})

    narrow = placed.select("_tile", "_pos", "_size", "_after")
    first = int(present[0])

    def walk() -> dict[int, int]:
        crossing = narrow.groupBy("_tile").applyInArrow(leave, "a long, goal long, _tile int")
        links = kept(narrow.groupBy("_tile").cogroup(crossing.groupBy("_tile")).applyInArrow(enter, "a long, b long, _tile int, entry long"))

        def begin(table: pa.Table) -> pa.Table:
            _, _, before, after = sorted_tile(table)
            return pa.table({"a": [int(_jumps(before, after, budget)[1][0])]})

        reach = kept(narrow.where(F.col("_tile") == first).groupBy("_tile").applyInArrow(begin, "a long"))
        jump = kept(links.join(links.select(F.col("b").alias("a")).unionByName(reach).distinct(), "a", "left_semi").select("a", "b"))
        while True:
            new = reach.join(jump, "a").select(F.col("b").alias("a")).join(reach, "a", "left_anti").distinct()
            more = kept(reach.unionByName(new))
            if more.count() == reach.count():
                break
            further = kept(jump.join(jump.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b")))
            release(reach, jump)
            reach, jump = more, further
        # a walk enters each tile once at most, so this is a row for each tile
        found = {r["_tile"]: r["entry"] for r in links.join(reach, "a", "left_semi").select("_tile", "entry").collect()}
        release(links, reach, jump, more)
        return found

    entries = {first: 0} | (walk() if len(present) > 1 else {})

    def starts_of(tile: int, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        starts = np.zeros(len(before), np.int64)
        at = entries.get(tile, len(before))
        onward = _jumps(before, after, budget)[0] if at < len(before) else None
        while at < len(before):
            starts[at] = 1
            at = int(onward[at])
        return starts

    def count(table: pa.Table) -> pa.Table:
        tile, _, before, after = sorted_tile(table)
        return pa.table({"_tile": pa.array([tile], pa.int32()), "n": [int(starts_of(tile, before, after).sum())]})

    counted = {r["_tile"]: r["n"] for r in narrow.groupBy("_tile").applyInArrow(count, "_tile int, n long").collect()}
    earlier = dict(zip(present.tolist(), [0, *np.cumsum([counted[t] for t in present])[:-1].tolist()], strict=True))

    def number(table: pa.Table) -> pa.Table:
        tile, table, before, after = sorted_tile(table)
        chunk = earlier[tile] + np.cumsum(starts_of(tile, before, after)) - 1
        return table.select(columns).append_column("chunk", pa.array(chunk, pa.int64()))

    schema = rows.withColumn("chunk", F.lit(0).cast("long")).schema
    return placed.groupBy("_tile").applyInArrow(number, schema)


def deal_by_load(histogram: dict[int, int], bins: int, capacity: int) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int, int]]]:
    """Largest sizes first, each item to the bin with the least load that has room, of equal ones the smallest.

    Bins alike are one group, (load, first bin, number of bins, room), and get items of a size as a row, so work grows with
    the groups, not the bins. Returns the rows (size, first item, items, first bin, items for each bin) and the groups at the end.
    """
    open_ = [(0, 0, bins, capacity)] if bins else []
    full: list[tuple[int, int, int, int]] = []
    rows = []

    def back(load: int, first: int, count: int, room: int) -> None:
        if count:
            (heapq.heappush(open_, (load, first, count, room)) if room else full.append((load, first, count, room)))

    for size in sorted(histogram, reverse=True):
        item, left = 0, histogram[size]
        while left:
            load, first, count, room = heapq.heappop(open_)
            if size == 0:  # the load stays, so a bin is filled before the next
                got, each = min(count, max(1, left // room)), min(room, left)
            else:
                got, each = min(count, left), 1
                # whole rounds over a group that stays the least by them
                if got == count and left > count:
                    ahead = open_[0][0] if open_ else None
                    most = room if ahead is None else (ahead - load - 1) // size + 1
                    each = max(1, min(room, left // count, most))
            rows.append((size, item, got * each, first, each))
            item, left = item + got * each, left - got * each
            back(load + size * each, first, got, room - each)
            back(load, first + got, count - got, room)
    return rows, sorted([*open_, *full], key=lambda g: g[1])


def capped_batches(rows: DataFrame, *, item: str, size: str, capacity: int, grain: int | None = None) -> DataFrame:
    """``batch`` of each row: as few batches as hold ``capacity`` rows each, with loads by longest processing time first.

    Sizes are rounded up to ``grain``, by default as fine as MOST_SIZES different sizes allow; null sizes count as 0. The
    driver sees a count for each size, and rows of items for groups of batches that are alike.
    """
    own = rows.select(F.struct(*rows.columns).alias("_row"), F.col(item).alias("_item"), F.greatest(F.lit(0), F.coalesce(F.col(size).cast("long"), F.lit(0))).alias("_size"))
    if grain is None:
        grain = max(1, -(-(own.agg(F.max("_size")).first()[0] or 0) // MOST_SIZES))
    own = own.withColumn("_size", (F.ceil(F.col("_size") / grain) * grain).cast("long"))
    counts = {r["_size"]: r["n"] for r in own.groupBy("_size").agg(F.count("*").alias("n")).collect()}
    dealt, _ = deal_by_load(counts, -(-sum(counts.values()) // capacity), capacity)
    table = rows.sparkSession.createDataFrame(dealt or [(-1, 0, 0, 0, 1)], "e_size long, first long, n_items long, first_batch long, each long")
    ranked = rank_within(own, key="_size", item="_item", most=max(counts.values(), default=1))
    fits = (F.col("_size") == F.col("e_size")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n_items"))
    batch = F.col("first_batch") + F.floor((F.col("rank") - F.col("first")) / F.col("each"))
    return ranked.join(F.broadcast(table), fits).select("_row.*", batch.cast("long").alias("batch"))
