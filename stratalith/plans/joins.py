"""Queries on intervals, lookbacks and budgets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import budgets, intervals
from .runs import _EVENTS, _events
from .tables import table


def interval_owner(spark, sf_dir):
    """Clicks in the innermost of their user's views, which last a minute for each cent."""
    events = _events(spark, sf_dir)
    views = events.where("event_type = 'view'").select("user_id", "event_id", "t", (F.col("t") + F.col("cents") * 60).alias("until"))
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "t")
    return intervals.containing(clicks, views, key="user_id", point="event_id", at="t", interval="event_id", start="t", end="until")


def lookback_match(spark, sf_dir):
    """Purchases with the latest click in the three days before them that is of a higher amount."""
    events = _events(spark, sf_dir).select("event_id", "user_id", "t", "cents", "event_type")
    found = intervals.latest_before(
        events.where("event_type = 'purchase'"), events.where("event_type = 'click'"), key="user_id", anchor="event_id", time="t", reach=3 * 86400,
        passes=F.col("point.cents") > F.col("cents"),
    )
    return found.select("event_id", "user_id", "t", "cents", F.col("point.event_id").alias("matched"), (F.col("t") - F.col("point.t")).alias("age"))


def nearest_or_same(spark, sf_dir):
    """Ten-euro steps of the clicks nearest to a purchase, or of all clicks of its user where none is near."""
    events = _events(spark, sf_dir).withColumn("step", F.floor(F.col("cents") / 1000).cast("long"))
    return intervals.nearest_or_same(
        events.where("event_type = 'purchase'"), events.where("event_type = 'click'"), key="user_id", time="t", anchor="event_id", value="step", before=6 * 3600, after=12 * 3600
    )


CHUNK_BYTES = 1_000_000


def byte_chunks(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.round("o_totalprice").cast("long").alias("size"))
    found = budgets.byte_chunks(orders, order=["o_orderkey"], size="size", budget=CHUNK_BYTES)
    return found.select("o_orderkey", "size", "chunk")


BATCH_ROWS = 64


def capped_batches(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("long").alias("size"))
    found = budgets.capped_batches(parts, item="p_partkey", size="size", capacity=BATCH_ROWS)
    return found.groupBy("batch").agg(F.count("*").alias("n_rows"), F.sum("size").alias("load"))


QUERIES = {f.__name__: f for f in (interval_owner, lookback_match, nearest_or_same, byte_chunks, capped_batches)}

SQL = {
    "interval_owner": f"""WITH {_EVENTS}, v AS (SELECT user_id, event_id, t, t + cents * 60 AS until FROM e WHERE event_type = 'view' AND cents > 0)
      SELECT c.event_id, c.user_id, c.t, v.event_id AS owner, v.t AS owner_start, v.until AS owner_end FROM e c LEFT JOIN v ON v.user_id = c.user_id AND c.t >= v.t AND c.t < v.until
      WHERE c.event_type = 'click' QUALIFY row_number() OVER (PARTITION BY c.event_id ORDER BY v.t DESC, v.until, v.event_id) = 1""",
    "lookback_match": f"""WITH {_EVENTS}, j AS (SELECT a.event_id, a.user_id, a.t, a.cents, c.event_id AS matched, a.t - c.t AS age FROM e a JOIN e c ON c.user_id = a.user_id AND c.event_type = 'click'
      AND c.t >= a.t - 259200 AND c.t < a.t AND c.cents > a.cents WHERE a.event_type = 'purchase')
      SELECT * FROM j QUALIFY age = min(age) OVER (PARTITION BY event_id)""",
    "nearest_or_same": f"""WITH {_EVENTS}, a AS (SELECT user_id, event_id, t, lead(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS nxt FROM e WHERE event_type = 'purchase'),
      c AS (SELECT user_id, t, floor(cents / 1000)::BIGINT AS step FROM e WHERE event_type = 'click'),
      j AS (SELECT a.event_id AS anchor, c.step, abs(c.t - a.t) AS distance FROM a JOIN c ON c.user_id = a.user_id
        AND c.t >= a.t - 21600 AND c.t < least(coalesce(nxt, a.t + 43200), a.t + 43200)),
      n AS (SELECT DISTINCT anchor, step, distance FROM (SELECT * FROM j QUALIFY distance = min(distance) OVER (PARTITION BY anchor)))
      SELECT anchor, step, distance, 'near' AS tier FROM n
      UNION ALL SELECT DISTINCT a.event_id, c.step, 0::BIGINT, 'same' FROM a JOIN c USING (user_id) WHERE a.event_id NOT IN (SELECT anchor FROM n)""",
    "byte_chunks": f"""WITH RECURSIVE o AS (SELECT o_orderkey, round(o_totalprice)::BIGINT AS size, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders),
      r AS (SELECT o_orderkey, size, i, size AS load, 0::BIGINT AS chunk FROM o WHERE i = 1
        UNION ALL SELECT o.o_orderkey, o.size, o.i, CASE WHEN r.load + o.size > {CHUNK_BYTES} THEN o.size ELSE r.load + o.size END,
          CASE WHEN r.load + o.size > {CHUNK_BYTES} THEN r.chunk + 1 ELSE r.chunk END FROM r JOIN o ON o.i = r.i + 1)
      SELECT o_orderkey, size, chunk FROM r""",
    "capped_batches": f"""WITH RECURSIVE o AS (SELECT p_size::BIGINT AS size, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS i, (count(*) OVER () + {BATCH_ROWS - 1}) // {BATCH_ROWS} AS bins FROM part),
      r AS (SELECT 0::BIGINT AS i, list_transform(range(any_value(bins)), lambda b: 0::BIGINT) AS loads, list_transform(range(any_value(bins)), lambda b: 0::BIGINT) AS counts FROM o
        UNION ALL SELECT i, list_transform(range(len(loads)), lambda b: loads[b + 1] + CASE WHEN b + 1 = best THEN size ELSE 0 END),
          list_transform(range(len(loads)), lambda b: counts[b + 1] + CASE WHEN b + 1 = best THEN 1 ELSE 0 END)
        FROM (SELECT o.i, o.size, loads, counts, list_position(open, list_min(open)) AS best
          FROM (SELECT *, list_transform(range(len(loads)), lambda b: CASE WHEN counts[b + 1] < {BATCH_ROWS} THEN loads[b + 1] ELSE 9223372036854775807 END) AS open FROM r) r JOIN o ON o.i = r.i + 1)),
      z AS (SELECT loads, counts FROM r ORDER BY i DESC LIMIT 1)
      SELECT unnest(range(len(loads))) AS batch, unnest(counts) AS n_rows, unnest(loads) AS load FROM z""",
}
