"""Plan selection, schedules and balanced batches."""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.checkpoints import kept


def match_branch(rows: DataFrame, matches: DataFrame, *, key: str, labels: tuple[str, str, str] = ("none", "single", "ambiguous")) -> DataFrame:
    """Which way each row goes by how many matches it has: none, one or more."""
    counts = matches.groupBy(key).agg(F.count("*").alias("n_matches"))
    both = rows.join(counts, key, "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0)))
    mode = F.when(F.col("n_matches") == 0, labels[0]).when(F.col("n_matches") == 1, labels[1]).otherwise(labels[2])
    return both.withColumn("mode", mode)


def rank_over_all(rows: DataFrame, order: list[Column], *, rough: Column) -> DataFrame:
    """``rank`` from 0 over all rows in an order that refines a whole number ``rough``.

    Rows are cut into ranges of the whole order by a sample, so a rough value that most rows share is ranked by
    many tasks; ranks within each range are added to the count of rows before it, of which there is one for each
    range. ``rough`` leads the order.
    """
    whole = [rough.asc(), *order]
    placed = rows.repartitionByRange(*whole).withColumn("_part", F.spark_partition_id())
    within = Window.partitionBy("_part").orderBy(*whole)
    ranked = kept(placed.withColumn("_within", F.row_number().over(within) - 1))
    counts = ranked.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    found = ranked.join(F.broadcast(counts), "_part")  # one row for each partition
    return found.select(*rows.columns, (F.col("_within") + F.col("_before")).alias("rank"))


def rank_within(rows: DataFrame, *, key: str, item: str, most: int) -> DataFrame:
    """``rank`` from 0 within each key, in an order of no meaning that tells items apart.

    Keys have ``most`` rows at most. Rows are ranked in hashed buckets, as many as a bucket then has rows,
    so a key that most rows share is ranked by many tasks.
    """
    buckets = max(1, math.isqrt(most))
    own = rows.withColumn("_bucket", F.pmod(F.xxhash64(item), F.lit(buckets)))
    counts = own.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(key, "_bucket").orderBy(item)
    ranked = own.withColumn("_within", F.row_number().over(within) - 1).join(counts, [key, "_bucket"])
    return ranked.select(*rows.columns, (F.col("_within") + F.col("_before")).alias("rank"))


def assign_chunks(ranked: DataFrame, *, total: int, workers: int, per_worker: int = 4) -> DataFrame:
    """Even chunk and round-robin worker of each ranked row."""
    size = max(1, -(-total // (workers * per_worker)))
    return ranked.withColumn("chunk", F.floor(F.col("rank") / size).cast("long")).withColumn("worker", (F.col("rank") % workers).cast("int"))


def balance_histogram(histogram: dict[int, int], bins: int) -> dict[int, list[int]]:
    """How many items of each size go to each bin, by longest-processing-time over a histogram.

    Items of a size are dealt to the bin with the least load, largest size first; the driver sees one
    number for each size, not the items.
    """
    loads = [(0, b) for b in range(bins)]
    out: dict[int, list[int]] = {}
    for size in sorted(histogram, reverse=True):
        # what would level the bins goes one by one, the rest of a large count to all alike
        spread = max(loads)[0] - min(loads)[0]
        whole = max(0, histogram[size] // bins - spread // size - 1)
        left = histogram[size] - whole * bins
        dealt = [whole] * bins
        loads = [(load + whole * size, b) for load, b in loads]
        heapq.heapify(loads)
        for _ in range(left):
            load, b = heapq.heappop(loads)
            dealt[b] += 1
            heapq.heappush(loads, (load + size, b))
        out[size] = dealt
    return out


#: Different sizes that a balance tells apart at most, so what the driver deals and sends has a bound.
MOST_SIZES = 10_000


def balance_batches(rows: DataFrame, *, item: str, size: str, bins: int, grain: int | None = None) -> DataFrame:
    """Give rows to bins of near-equal load. Sizes are rounded up to ``grain``; by default as fine as MOST_SIZES
    different sizes allow."""
    if grain is None:
        grain = max(1, -(-(rows.agg(F.max(size)).first()[0] or 0) // MOST_SIZES))
    rounded = (F.ceil(F.col(size) / grain) * grain).cast("long")
    own = rows.withColumn("_size", rounded)
    counts = {r["_size"]: r["n"] for r in own.groupBy("_size").agg(F.count("*").alias("n")).collect()}
    edges = []
    for value, dealt in balance_histogram(counts, bins).items():
        first = 0
        for b, n in enumerate(dealt):
            if n:
                edges.append((value, first, first + n, b))
                first += n
    table = rows.sparkSession.createDataFrame(edges or [(0, 0, 0, 0)], "e_size long, first long, past long, batch int")
    ranked = rank_within(own, key="_size", item=item, most=max(counts.values(), default=1))
    fits = (F.col("_size") == F.col("e_size")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past"))
    return ranked.join(F.broadcast(table), fits).select(*rows.columns, "batch")


def upgrade_proven_hosts(urls: DataFrame, *, url: str, host: Column) -> DataFrame:
    """``resolved``: http urls as https where the same host is seen with https anywhere. Others stay."""
    own = urls.withColumn("_host", host)
    secure = own.where(F.col(url).startswith("https://")).select(F.col("_host").alias("secure_host")).distinct()
    both = own.join(secure, F.col("_host") == F.col("secure_host"), "left")
    up = F.concat(F.lit("https://"), F.substring(F.col(url), 8, 1 << 30))
    resolved = F.when(F.col(url).startswith("http://") & F.col("secure_host").isNotNull(), up).otherwise(F.col(url))
    return both.withColumn("resolved", resolved).drop("_host", "secure_host")


def resume_decision(previous: DataFrame, current: DataFrame, *, key: str, fields: list[str], validators: list[str]) -> DataFrame:
    """resume where url fields agree (null-safe) and the first validator present on both agrees, else restart."""
    was = previous.select(key, *(F.col(c).alias(f"was_{c}") for c in [*fields, *validators]), F.lit(True).alias("known"))
    both = current.join(was, key, "left")
    same = F.lit(True)
    for c in fields:
        same = same & F.col(c).eqNullSafe(F.col(f"was_{c}"))
    valid = F.lit(False)
    for c in reversed(validators):
        present = F.col(c).isNotNull() & F.col(f"was_{c}").isNotNull()
        valid = F.when(present, F.col(c) == F.col(f"was_{c}")).otherwise(valid)
    decision = F.when(F.col("known") & same & valid, "resume").otherwise("restart")
    return both.select(*current.columns, decision.alias("decision"))


def top_per_group(rows: DataFrame, *, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key in an order; Spark keeps n rows a key before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= n)


def preferred_or_first(rows: DataFrame, *, preferred: Column, order: list[str]) -> DataFrame:
    """One row: a preferred one if there is any, else the first in an order."""
    return rows.orderBy(F.desc(F.coalesce(preferred, F.lit(False))), *order).limit(1)
