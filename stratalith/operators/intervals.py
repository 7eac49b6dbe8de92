"""Joins by place: the interval around a point, the latest earlier row that fits, the nearest row or one of the same key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.checkpoints import kept
from .evidence import nearest_after

#: Nodes of intervals that may be broadcast; more are joined by a shuffle.
BROADCAST_NODES = 1_000_000

# ceil(_s / 2^k) and floor(_e / 2^k): the whole nodes of level k inside an interval are from the one up to the other
_LOW, _HIGH = "(-shiftright(-_s, k))", "shiftright(_e, k)"
_PIECES = f"""filter(flatten(transform(sequence(0, cast(floor(log2(_e - _s)) as int) + 1), k -> array(
  if({_LOW} < {_HIGH} and {_LOW} % 2 <> 0, struct(k as level, {_LOW} as node), null),
  if({_LOW} < {_HIGH} and {_HIGH} % 2 <> 0, struct(k as level, {_HIGH} - 1 as node), null)))), x -> x is not null)"""


def containing(points: DataFrame, intervals: DataFrame, *, key: str, point: str, at: str, interval: str, start: str, end: str) -> DataFrame:
    """Each point with the innermost interval [start, end) of its key around it: ``owner``, ``owner_start``, ``owner_end``.

    Innermost is the one that starts last, then the one that ends first, then the smallest; intervals may nest and
    overlap. Points without one have nulls; intervals with a null or no length hold nothing. ``point`` tells points apart.

    An interval falls into two nodes for each power of two at most, and a point lies in one node of each power that
    occurs. A node keeps its innermost interval alone, so a point meets one row for each power, whatever the number of
    intervals around it, and a key with most rows has as many nodes as its intervals. Nodes are broadcast if counted
    and found few.
    """
    own = intervals.select(F.col(key).alias("_key"), F.col(start).cast("long").alias("_s"), F.col(end).cast("long").alias("_e"), F.col(interval).alias("_id"))
    pieces = own.where("_s < _e").select("*", F.explode(F.expr(_PIECES)).alias("_piece"))
    inner = F.min(F.struct((-F.col("_s")).alias("s"), F.col("_e").alias("e"), F.col("_id").alias("id")))
    nodes = kept(pieces.groupBy("_key", F.col("_piece.level").alias("_level"), F.col("_piece.node").alias("_node")).agg(inner.alias("_inner")))
    levels = sorted(r[0] for r in nodes.select("_level").distinct().collect())  # 64 at most
    small = F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes
    each = points.select(F.col(point).alias("_point"), F.col(key).alias("_key"), F.col(at).cast("long").alias("_at"), F.explode(F.array(*map(F.lit, levels)).cast("array<int>")).alias("_level"))
    hits = each.withColumn("_node", F.expr("shiftright(_at, _level)")).join(small, ["_key", "_level", "_node"])
    best = hits.groupBy("_point").agg(F.min("_inner").alias("_inner"))
    both = points.join(best, F.col(point) == F.col("_point"), "left")
    return both.select(*points.columns, F.col("_inner.id").alias("owner"), (-F.col("_inner.s")).alias("owner_start"), F.col("_inner.e").alias("owner_end"))


def latest_before(anchors: DataFrame, points: DataFrame, *, key: str, anchor: str, time: str, reach: int, passes: Column) -> DataFrame:
    """Each anchor with the latest points of its key in the ``reach`` before it that pass, all ties, in a struct ``point``;
    anchors without one are left out.

    ``passes`` tells of columns of the anchor and of ``point``, so a later point that fails does not hide an earlier one.
    Both sides meet in buckets as wide as the reach, by an equi-join.
    """
    bucket = F.floor(F.col(time) / reach)
    asked = anchors.withColumn("_bucket", F.explode(F.array(bucket, bucket - 1)))
    own = points.select(F.col(key).alias("_key"), bucket.alias("_b"), F.struct(*points.columns).alias("point"))
    near = asked.join(own, (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_b")))
    at = F.col(f"point.{time}")
    near = near.where((at >= F.col(time) - reach) & (at < F.col(time)) & passes)
    best = F.rank().over(Window.partitionBy(anchor).orderBy(at.desc()))
    return near.withColumn("_place", best).where("_place = 1").select(*anchors.columns, "point")


def nearest_or_same(anchors: DataFrame, points: DataFrame, *, key: str, time: str, anchor: str, value: str, before: int, after: int) -> DataFrame:
    """(anchor, value, distance, tier): the values of the points nearest to each anchor (``evidence.nearest_after``), and
    where none is in reach all different values of its key, at distance 0."""
    near = nearest_after(anchors, points, key=key, time=time, anchor_id=anchor, point_id=value, before=before, after=after)
    near = near.select("anchor", F.col("point").alias(value), "distance").distinct().withColumn("tier", F.lit("near"))
    rest = anchors.select(F.col(anchor).alias("anchor"), key).join(near.select("anchor"), "anchor", "left_anti")
    same = rest.join(points.select(key, value).distinct(), key).select("anchor", value, F.lit(0).cast("long").alias("distance"), F.lit("same").alias("tier"))
    return near.unionByName(same)
