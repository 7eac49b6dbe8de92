"""Operator 9: sharding by histogram sort, with bytes balanced over shards.

Rows are ordered by a 60-bit hash of their text and then by id, so equal texts stand together and a
group is split only where a shard is full. Boundaries of equal bytes are found without sorting: each
round, all partitions count rows and exact bytes below a set of probe keys, counts are summed, and the
interval of each boundary shrinks to the two probes around it, until the upper one passes the boundary by a
thousandth of a shard (``TOLERANCE``) at most or one row is left. Then rows are exchanged once, into the ranges between the splitters, and numbered there.

What the driver sees is a count for each probe. Shards of many rows are split into more ranges, each
with a known number of rows before it, so no task numbers more than ``range_rows`` rows or so.

Nulls, empties: a null text has no bytes and hashes like the empty text. Rows without an id count as having
negative ids of their own. Rows that repeat an id and a text are told apart by a number of their own, the last part of
each key, so they are split like any others; which of them gets which slot is left open.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_type, materialize, table

SHARDS, ROW_BYTES, TOLERANCE = 40, 16, 0.001
PROBES = 64
HASH_DIGITS = 15


def text_order(text) -> F.Column:
    """60 bits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, HASH_DIGITS), 16, 10).cast("long")


def split_key(key: int, width: int, low: int, ties: int) -> tuple[int, int, int]:
    """(hash, id, number) of a key, which is (hash * 2^width + id - low) * 2^ties + number."""
    pair = key >> ties
    return pair >> width, (pair & ((1 << width) - 1)) + low, key & ((1 << ties) - 1)


def count_below(rows: DataFrame, probes: list[int], width: int, low: int, ties: int = 0) -> tuple[list[int], list[int]]:
    """Rows and bytes with a key (``split_key``) below each of the sorted probes; numbers are in column u if ``ties``."""
    keys = [split_key(p, width, low, ties) for p in probes]
    hashes = np.array([h for h, _, _ in keys], np.int64)
    schema = "k int, n long, b long"
    arrow = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(keys) + 1, np.int64)
        b = np.zeros(len(keys) + 1, np.int64)
        for batch in batches:
            h, d, u, size = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            first = np.searchsorted(hashes, h, "left")
            place = np.searchsorted(hashes, h, "right")
            for i in np.flatnonzero(first < place):  # hashes that a probe shares: ids decide
                a, z = int(first[i]), int(place[i])
                place[i] = bisect.bisect_right(keys, (int(h[i]), int(d[i]), int(u[i])), a, z)
            n += np.bincount(place, minlength=len(n))
            b += np.bincount(place, weights=size, minlength=len(n)).astype(np.int64)
        k = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(n[k]), pa.array(b[k])], schema=arrow)

    own = rows.select("h", "d", (F.col("u") if ties else F.lit(0).cast("long")).alias("u"), "size")
    got = own.mapInArrow(run, schema).groupBy("k").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    n_at, b_at = [0] * (len(keys) + 1), [0] * (len(keys) + 1)
    for r in got.collect():
        n_at[r["k"]], b_at[r["k"]] = r["n"], r["b"]
    return list(np.cumsum(n_at[:-1], dtype=object)), list(np.cumsum(b_at[:-1], dtype=object))


def find_splitters(rows: DataFrame, targets: list[int], total: tuple[int, int], width: int, low: int, ties: int, tolerance: int) -> list[tuple[int, int, int]]:
    """For each target of bytes the splitter key p, rows below and bytes below it.

    p is such that bytes below p reach the target and bytes below the row before p do not, or that
    bytes below p pass the target by ``tolerance`` at most. An interval is (key, rows, bytes below)
    twice.
    """
    top = 1 << (4 * HASH_DIGITS + width + ties)
    spans = [((0, 0, 0), (top, *total)) for _ in targets]
    while True:
        open_ = [
            i
            for i, (lo, hi) in enumerate(spans)
            if hi[1] - lo[1] > 1 and hi[0] - lo[0] > 1 and hi[2] - targets[i] > tolerance
        ]
        if not open_:
            return [hi for _, hi in spans]
        different = sorted({(spans[i][0][0], spans[i][1][0]) for i in open_})
        each = max(2, PROBES * len(targets) // len(different))
        probes = sorted({lo + (hi - lo) * k // each for lo, hi in different for k in range(1, each)} - {0})
        n_below, b_below = count_below(rows, probes, width, low, ties)
        for i in open_:
            lo, hi = spans[i]
            for p, n, b in zip(probes, n_below, b_below, strict=True):
                if lo[0] < p < hi[0]:
                    if b < targets[i]:
                        lo = (p, n, b)
                    else:
                        hi = (p, n, b)
                        break
            spans[i] = (lo, hi)


def shard_by_bytes(
    rows: DataFrame, *, shards: int = SHARDS, range_rows: int = 1_000_000, tolerance: float = 0.0
) -> DataFrame:
    """Add ``shard`` and ``slot`` to rows with columns h (hash), d (id) and size (bytes).

    Row k goes to shard floor(bytes before k * shards / all bytes), but for rows within ``tolerance``, a share of
    a shard's bytes, behind a boundary, which may go before it. ``rows`` is read several times: give a written table, with
    a number of its own for each row in column u, or rows that differ in (h, d). At most shards * 64 counts are seen by the driver in a round.
    """
    columns = rows.columns
    if "u" not in columns:
        rows = rows.withColumn("u", F.lit(0).cast("long"))
    stats = rows.agg(F.count("*").alias("n"), F.sum("size").alias("b"), F.min("d").alias("lo"), F.max("d").alias("hi"), F.max("u").alias("u")).first()
    if not stats["n"]:
        return rows.select(*columns, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    low = stats["lo"] if stats["lo"] is not None else 0
    width = ((stats["hi"] if stats["hi"] is not None else low) - low).bit_length() or 1
    ties = stats["u"].bit_length()
    pieces = -(-stats["n"] // (shards * range_rows))
    parts = shards * pieces
    targets = [-(-stats["b"] * j // parts) for j in range(1, parts)]
    found = find_splitters(rows, targets, (stats["n"], stats["b"]), width, low, ties, int(tolerance * stats["b"] / parts))
    splitters = [split_key(p, width, low, ties) for p, _, _ in found]
    before = [0, *(n for _, n, _ in found)]
    schema = rows.schema.jsonValue()
    hashes = np.array([h for h, _, _ in splitters], np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, d, u = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("h", "d", "u"))
            at = np.searchsorted(hashes, h, "right")
            first = np.searchsorted(hashes, h, "left")
            for i in np.flatnonzero(first < at):
                at[i] = bisect.bisect_right(splitters, (int(h[i]), int(d[i]), int(u[i])), int(first[i]), int(at[i]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], names=[*batch.schema.names, "part"])

    from pyspark.sql.types import IntegerType, StructType

    out = StructType.fromJson(schema).add("part", IntegerType())
    placed = rows.mapInArrow(place, out)
    # ranges before each shard, and rows before each range within its shard
    starts = rows.sparkSession.createDataFrame(
        [(j, j // pieces, int(before[j] - before[j - j % pieces])) for j in range(parts)], "part int, shard int, rows_before long"
    )
    order = Window.partitionBy("part").orderBy("h", "d", "u")
    numbered = placed.withColumn("rank", F.row_number().over(order) - 1)
    return (
        numbered.join(F.broadcast(starts), "part")
        .withColumn("slot", F.col("rank") + F.col("rows_before"))
        .select(*columns, "shard", "slot")
    )


def op9_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), -1 - F.monotonically_increasing_id()).alias("d"),
        text_order(F.col("text")).alias("h"),
        (F.octet_length("text") + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("u"),
    )
    sharded = shard_by_bytes(materialize(rows, "shard-keys"), tolerance=TOLERANCE)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op9_histogram_shards": op9_histogram_shards}
