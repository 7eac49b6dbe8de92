"""Queries on documents held against schemas, and on watched transfers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import schemas
from ..operators import monitor, transfers
from .runs import _EVENTS, _events
from .tables import table

PROPS = {"type": "object", "required": ["k"], "additionalProperties": False, "properties": {"k": {"type": "integer", "maximum": 89, "multipleOf": 3}}}

ORDER = {
    "type": "object",
    "required": ["key", "status", "lines", "priority"],
    "additionalProperties": False,
    "properties": {
        "key": {"type": "integer", "minimum": 0},
        "status": {"enum": ["F", "O"]},
        "priority": {"type": "string", "pattern": "^[0-9]-[A-Z]+$"},
        "total": {"type": "number", "exclusiveMaximum": 400000},
        "lines": {"type": "array", "minItems": 2, "items": {"$ref": "#/$defs/line"}},
    },
    "if": {"required": ["total"], "properties": {"total": {"minimum": 300000}}},
    "then": {"properties": {"lines": {"minItems": 4}}},
    "$defs": {
        "line": {
            "type": "object",
            "required": ["number", "flag"],
            "additionalProperties": False,
            "properties": {"number": {"type": "integer"}, "flag": {"enum": ["A", "N"]}, "quantity": {"type": "number", "maximum": 45}, "late": {"const": True}},
        }
    },
}


def schema_faults(spark, sf_dir):
    """Faults of each event's properties, and of orders as documents with their lines in an array."""
    events = table(spark, sf_dir, "events")
    of_events = events.select(F.lit("event").alias("kind"), F.col("event_id").alias("id"), F.explode(schemas.json_faults(PROPS, F.col("props"))).alias("fault"))
    line = F.struct(
        F.col("l_linenumber").alias("number"), F.col("l_returnflag").alias("flag"), F.round("l_quantity").cast("long").alias("quantity"), F.when(F.col("l_discount") > 0.08, F.col("l_tax") > 0.02).alias("late")
    )
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(line)).alias("lines"))  # an order's few lines
    orders = table(spark, sf_dir, "orders").join(lines, "o_orderkey")
    whole = F.to_json(F.struct(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_custkey") % 4 != 0, F.round("o_totalprice").cast("long")).alias("total"), "lines", F.when(F.col("o_totalprice") < 5000, F.lit("small")).alias("note"),
    ))
    of_orders = orders.select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.explode(schemas.json_faults(ORDER, whole)).alias("fault"))
    return of_events.unionByName(of_orders)


SHAPES = {
    "counts": {"type": "object", "required": ["counts"], "properties": {"counts": {"type": "object", "required": ["n"]}}},
    "items": {"type": "object", "required": ["items"], "properties": {"items": {"type": "array", "items": {"type": "integer"}}}},
}


def payload_shapes(spark, sf_dir):
    """Statistics of payloads of several shapes; one of no known shape has none."""
    events = _events(spark, sf_dir)
    payload = (
        F.when(F.col("event_type") == "click", F.to_json(F.struct(F.struct(F.col("cents").alias("n")).alias("counts"))))
        .when(F.col("event_type") == "view", F.to_json(F.struct(F.array("cents", "user_id", "event_id").alias("items"))))
        .when(F.col("event_type") == "error", F.to_json(F.struct(F.array("event_type").alias("items"))))
        .otherwise(F.col("props"))
    )
    doc = F.try_parse_json(payload)
    stats = schemas.by_shape(doc, {
        "counts": (SHAPES["counts"], {"n": F.try_variant_get(doc, "$.counts.n", "long")}),
        "items": (SHAPES["items"], {"n": F.size(F.try_variant_get(doc, "$.items", "array<long>")), "first": F.try_variant_get(doc, "$.items[0]", "long")}),
    })
    return events.select("event_id", schemas.shape_of(doc, SHAPES).alias("shape"), stats["n"].alias("n"), stats["first"].alias("first"))


WATCH = transfers.Watch(idle=86400, window=2 * 86400, least_rate=0.06, tail_percent=30.0, grace=86400)
SIZE, TURN, UNTIL = 180_000, 200_000, 1_706_500_000


def transfer_alerts(spark, sf_dir):
    """Users' running totals as transfers that fall back at times; a signup throws away what was there."""
    rows = _events(spark, sf_dir).select("user_id", "event_id", "t", "event_type", "cents")
    totals = monitor.cumulative(rows, key="user_id", time=F.col("t"), tie="event_id", amount=F.col("cents"))
    return transfers.transfer_alerts(
        totals, WATCH, key="user_id", time="t", tie="event_id", done=F.col("total") % TURN, size=F.lit(SIZE), discard=F.col("event_type") == "signup", until=UNTIL
    )


QUERIES = {f.__name__: f for f in (schema_faults, payload_shapes, transfer_alerts)}

_RULES = """SELECT 'order' AS kind, o_orderkey AS id, unnest(list_filter([
    CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN '$.status: enum' END,
    CASE WHEN NOT regexp_matches(o_orderpriority, '^[0-9]-[A-Z]+$') THEN '$.priority: pattern' END,
    CASE WHEN total >= 400000 THEN '$.total: exclusiveMaximum' END,
    CASE WHEN o_totalprice < 5000 THEN '$.note: not allowed' END,
    CASE WHEN n < 2 THEN '$.lines: minItems' END,
    CASE WHEN total >= 300000 AND n < 4 THEN '$.lines: minItems' END], lambda x: x IS NOT NULL)) AS fault FROM o
  UNION ALL SELECT 'order', l_orderkey, unnest(list_filter([
    CASE WHEN l_returnflag NOT IN ('A', 'N') THEN '$.lines[' || i || '].flag: enum' END,
    CASE WHEN round(l_quantity) > 45 THEN '$.lines[' || i || '].quantity: maximum' END,
    CASE WHEN l_discount > 0.08 AND NOT l_tax > 0.02 THEN '$.lines[' || i || '].late: const' END], lambda x: x IS NOT NULL))
  FROM l SEMI JOIN orders ON l_orderkey = o_orderkey"""

SQL = {
    "schema_faults": f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, round(l_quantity), CASE WHEN l_discount > 0.08 THEN l_tax > 0.02 END NULLS FIRST) - 1 AS i FROM lineitem),
      o AS (SELECT orders.*, n, CASE WHEN o_custkey % 4 <> 0 THEN round(o_totalprice)::BIGINT END AS total FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
      k AS (SELECT event_id, (props->>'k')::BIGINT AS k FROM events)
      SELECT 'event' AS kind, event_id AS id, unnest(list_filter([CASE WHEN k > 89 THEN '$.k: maximum' END, CASE WHEN k % 3 <> 0 THEN '$.k: multipleOf' END], lambda x: x IS NOT NULL)) AS fault FROM k
      UNION ALL {_RULES}""",
    "payload_shapes": f"""WITH {_EVENTS} SELECT event_id, CASE event_type WHEN 'click' THEN 'counts' WHEN 'view' THEN 'items' END AS shape,
      CASE event_type WHEN 'click' THEN cents WHEN 'view' THEN 3 END::DOUBLE AS n, CASE WHEN event_type = 'view' THEN cents END::DOUBLE AS first FROM e""",
    "transfer_alerts": f"""WITH RECURSIVE {_EVENTS},
      s AS (SELECT user_id, t, row_number() OVER w AS i, (sum(cents) OVER (w ROWS UNBOUNDED PRECEDING))::BIGINT % {TURN} AS done, event_type = 'signup' AS discard FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
      r AS (SELECT DISTINCT user_id, 0::BIGINT AS i, NULL::BIGINT AS best, NULL::BIGINT AS last, 0::BIGINT AS bytes, false AS slow, NULL::BIGINT AS tail, []::STRUCT(t BIGINT, b BIGINT)[] AS samples,
          []::STRUCT(t BIGINT, alert VARCHAR, bytes BIGINT)[] AS alerts FROM e
        UNION ALL SELECT user_id, i, CASE WHEN over THEN NULL ELSE best END, CASE WHEN over THEN NULL ELSE last END, CASE WHEN over THEN 0 ELSE bytes END, CASE WHEN over THEN false WHEN judged THEN now_slow ELSE slow END,
          CASE WHEN over THEN NULL ELSE tail END, CASE WHEN over THEN [] ELSE samples END,
          late || CASE WHEN NOT over AND judged AND now_slow AND NOT slow THEN [{{'t': t, 'alert': 'slow', 'bytes': bytes}}] ELSE [] END
        FROM (SELECT *, t - samples[1].t >= {WATCH.window} AND NOT coalesce(t - tail <= {WATCH.grace}, false) AS judged,
            greatest(0, bytes - samples[1].b) < {WATCH.least_rate} * (t - samples[1].t) AS now_slow FROM (
          SELECT * EXCLUDE (samples, tail), bytes >= {SIZE} AS over,
            list_filter(samples, lambda x, n: n >= coalesce(list_max(list_transform(range(2, len(samples) + 1), lambda m: CASE WHEN samples[m].t <= t - {WATCH.window} THEN m END)), 1)) AS samples,
            CASE WHEN ({SIZE} - bytes) * 100 <= {SIZE} * {WATCH.tail_percent} THEN coalesce(tail, t) END AS tail FROM (
          SELECT user_id, i, t, late, CASE WHEN discard THEN 0 ELSE done END AS bytes, CASE WHEN fresh THEN CASE WHEN discard THEN 0 ELSE done END WHEN discard THEN 0 ELSE greatest(best, done) END AS best,
            CASE WHEN fresh OR (NOT discard AND done > best) THEN t ELSE last END AS last, CASE WHEN fresh OR discard THEN false ELSE slow END AS slow, CASE WHEN NOT fresh AND NOT discard THEN tail END AS tail,
            CASE WHEN fresh OR discard THEN [] ELSE samples END || [{{'t': t, 'b': CASE WHEN discard THEN 0 ELSE done END}}] AS samples FROM (
          SELECT s.user_id, s.i, s.t, s.done, s.discard, best, last, slow, tail, samples, coalesce(s.t - last >= {WATCH.idle}, true) AS fresh,
            CASE WHEN s.t - last >= {WATCH.idle} THEN [{{'t': last + {WATCH.idle}, 'alert': 'idle', 'bytes': bytes}}] ELSE []::STRUCT(t BIGINT, alert VARCHAR, bytes BIGINT)[] END AS late
          FROM r JOIN s ON s.user_id = r.user_id AND s.i = r.i + 1))))),
      z AS (SELECT user_id, unnest(alerts) AS a FROM r
        UNION ALL SELECT user_id, {{'t': last + {WATCH.idle}, 'alert': 'idle', 'bytes': bytes}} FROM (SELECT * FROM r QUALIFY i = max(i) OVER (PARTITION BY user_id)) WHERE {UNTIL} - last >= {WATCH.idle})
      SELECT user_id, a.t AS t, a.alert AS alert, a.bytes AS bytes FROM z""",
}
