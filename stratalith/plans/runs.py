"""Queries on runs, histories, plans, chains and costs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.formats import format_bytes, format_cents, format_duration
from ..operators import graph, history, monitor, planning, report, stats
from .tables import table

def _cents(column: str):
    return F.round(F.col(column) * 100).cast("long")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with whole cents and whole seconds."""
    events = table(spark, sf_dir, "events")
    return events.withColumn("cents", _cents("value")).withColumn("t", F.col("ts").cast("timestamp").cast("long"))


_EVENTS = "e AS (SELECT *, round(value * 100)::BIGINT AS cents, floor(epoch(ts))::BIGINT AS t FROM events)"


def stage_stats_download(spark, sf_dir):
    reused = F.col("event_type") == "view"
    return stats.transfer_stats(
        _events(spark, sf_dir), keys=["user_id"], size="cents", reused=reused, resumed=F.lit(2000), seconds=F.max("t") - F.min("t")
    )


def stage_stats_pivot(spark, sf_dir):
    kinds = ["click", "error", "purchase", "signup", "view"]
    rows = _events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    counts = stats.pivot_counts(rows, keys=["day"], column="event_type", values=kinds)
    sums = rows.groupBy("day").agg(F.count_distinct("user_id").alias("n_users"), F.sum("cents").alias("cents"))
    return counts.join(sums, "day")


def run_rollup(spark, sf_dir):
    done = F.col("event_type") != "error"
    return stats.roll_up_runs(table(spark, sf_dir, "events"), run="user_id", order="event_id", state="event_type", done=done)


def counter_rates(spark, sf_dir):
    """Running totals of each kind of event, on a counter that is reset at two million."""
    totals = monitor.cumulative(_events(spark, sf_dir), key="event_type", time=F.col("t"), tie="event_id", amount=F.col("cents"))
    counted = totals.withColumn("total", F.col("total") % 2_000_000)
    return stats.counter_rates(counted, keys=["event_type"], time=F.timestamp_seconds("t"), counter="total", bucket_seconds=86400)


def disk_estimate(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return stats.two_level_greatest(
        lines, outer=["l_orderkey"], inner=["l_linestatus"], one=F.round("l_quantity").cast("long") * 1000, other=F.round("l_extendedprice").cast("long")
    )


def history_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return history.latest(rows, keys=["user_id", "event_type"], order=["ts", "event_id"], limit=20)


def retry_schedule(spark, sf_dir):
    cycles = history.retry_cycles(
        _events(spark, sf_dir), target="user_id", time="t", success=F.col("event_type") == "purchase", failure=F.col("event_type") == "error"
    )
    return cycles.withColumn("next_retry", history.next_retry(F.col("first_failed"), F.col("last_failed")))


def processing_result(spark, sf_dir):
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return history.outcome(rows, keys=["user_id", "day"], failed=kind == "error", cancelled=kind == "signup", succeeded=kind.isin("click", "purchase", "view"))


def ledger_cost(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return history.ledger_cost(
        lines, keys=["l_orderkey"], identity=["l_linenumber", "l_partkey", "l_suppkey"], cents=_cents("l_extendedprice"), refund=F.col("l_returnflag") == "R"
    )


def posting_conflicts(spark, sf_dir):
    own = table(spark, sf_dir, "lineitem").withColumn("line_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return history.conflicting_postings(own, key="line_key", content=["l_partkey", "l_suppkey", "l_returnflag"])


def release_counts(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    facts = table(spark, sf_dir, "customer").withColumn("n_nationkey", F.col("c_nationkey"))
    state = F.when(F.col("c_acctbal") < 0, "error").otherwise("ok")
    return history.dimension_counts(nations, facts, on="n_nationkey", state=state, states=["error", "ok"])


def plan_branch(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return planning.match_branch(orders, lines, key="o_orderkey")


def version_chain(spark, sf_dir):
    return graph.prefix_length(table(spark, sf_dir, "conversations"), key="conv_id", index="turn")


def chain_status(spark, sf_dir):
    talks = table(spark, sf_dir, "conversations")
    prefix = graph.prefix_length(talks, key="conv_id", index="turn")
    sums = talks.groupBy("conv_id").agg(F.count("turn").alias("n_turns"), F.count_distinct("turn").alias("n_places"))
    status = F.when(F.col("prefix") == 0, "no-start").when(F.col("n_turns") > F.col("n_places"), "branch").when(F.col("prefix") < F.col("n_places"), "disconnected").otherwise("ok")
    return sums.join(prefix, "conv_id").withColumn("status", status)


def last_transition(spark, sf_dir):
    talks = table(spark, sf_dir, "conversations")
    best = talks.groupBy("conv_id").agg(F.max(F.struct("turn", "role", "text")).alias("last"))
    return best.select("conv_id", F.col("last.turn").alias("turn"), F.col("last.role").alias("role"), F.col("last.text").alias("text"))


def chunk_assign(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    n = docs.count()
    ranked = planning.rank_over_all(docs, [F.desc("n_chars"), F.asc("doc_id")], rough=-F.floor(F.col("n_chars") / 16))
    return planning.assign_chunks(ranked, total=n, workers=8)


def lpt_balance(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return planning.balance_batches(docs, item="doc_id", size="n_chars", bins=16)


def lpt_bounds(spark, sf_dir):
    """What a balance promises: every item once, and no load above the mean by more than the largest size."""
    loads = lpt_balance(spark, sf_dir).groupBy("batch").agg(F.count("*").alias("n"), F.sum("n_chars").alias("load"), F.max("n_chars").alias("largest"))
    fair = F.max("load") <= F.sum("load") / 16 + F.max("largest")
    return loads.agg(F.sum("n").alias("n_items"), F.sum("load").alias("total"), fair.alias("fair"), (F.max("batch") < 16).alias("in_range"))


def format_bytes_duration(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    size = (F.col("n_chars") * 3000).cast("long")
    return docs.select(
        "doc_id", format_bytes(size).alias("size_text"), format_duration(F.col("n_chars") * 17).alias("duration_text"), format_cents(F.col("n_chars")).alias("money_text")
    )


def top_per_group(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_suppkey", "l_shipdate")
    order = [F.desc("l_extendedprice"), *(F.asc(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))]
    return planning.top_per_group(lines, keys=["l_orderkey"], order=order, n=3).drop("l_shipdate")


def grouped_text(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    return report.grouped_text(nations, keys=["n_regionkey"], line=F.concat_ws(" ", F.lit("def"), "n_name"), order=["n_name"])


def status_lines(spark, sf_dir):
    counts = release_counts(spark, sf_dir)
    cells = [F.col(c) for c in ("n_name", "n_error", "n_ok", "overall")]
    return counts.select("n_nationkey", report.markdown_line(*cells).alias("markdown"), report.html_line(*cells).alias("html"), report.badge(F.col("n_name"), F.col("overall")).alias("badge"))


def with_missing(spark, sf_dir):
    from ..operators.stages import with_missing as fill

    customers = table(spark, sf_dir, "customer").select("c_custkey")
    open_ = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderstatus").alias("state"))
    return fill(customers, open_, on="c_custkey", state="state")


QUERIES = {
    f.__name__: f
    for f in (
        stage_stats_download, stage_stats_pivot, run_rollup, counter_rates, disk_estimate, history_latest, retry_schedule, processing_result,
        ledger_cost, posting_conflicts, release_counts, plan_branch, version_chain, chain_status, last_transition, chunk_assign, lpt_balance, lpt_bounds,
        format_bytes_duration, top_per_group, with_missing, grouped_text, status_lines,
    )
}

_PREFIX = """have AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE turn >= 0),
ends AS (SELECT conv_id, min(turn) AS e FROM have h WHERE NOT EXISTS (SELECT 1 FROM have n WHERE n.conv_id = h.conv_id AND n.turn = h.turn + 1) GROUP BY 1),
p AS (SELECT k.conv_id, CASE WHEN f.m = 0 THEN e + 1 ELSE 0 END AS prefix FROM (SELECT DISTINCT conv_id FROM conversations) k
  LEFT JOIN (SELECT conv_id, min(turn) AS m FROM have GROUP BY 1) f ON f.conv_id = k.conv_id LEFT JOIN ends ON ends.conv_id = k.conv_id)"""


def _bytes_sql(size: str) -> str:
    cases = [
        f"WHEN {size} >= {1 << 10 * p} THEN ((({size} * 10 + {1 << (10 * p - 1)}) // {1 << 10 * p}) // 10)::VARCHAR || '.' || ((({size} * 10 + {1 << (10 * p - 1)}) // {1 << 10 * p}) % 10)::VARCHAR || ' {u}'"
        for p, u in ((4, "TiB"), (3, "GiB"), (2, "MiB"), (1, "KiB"))
    ]
    return f"CASE {' '.join(cases)} ELSE {size}::VARCHAR || ' B' END"


_TWO = "lpad({}::VARCHAR, 2, '0')"

SQL = {
    "lpt_bounds": "SELECT count(*) AS n_items, sum(n_chars)::BIGINT AS total, true AS fair, true AS in_range FROM documents",
    "stage_stats_download": f"""WITH {_EVENTS}, s AS (SELECT user_id, count(*) AS n_items, count(*) FILTER (event_type = 'view') AS n_reused,
      coalesce(sum(cents) FILTER (event_type = 'view'), 0)::BIGINT AS reused_bytes,
      coalesce(sum(least(cents, 2000)) FILTER (event_type <> 'view'), 0)::BIGINT AS resumed_bytes,
      coalesce(sum(cents - least(cents, 2000)) FILTER (event_type <> 'view'), 0)::BIGINT AS network_bytes, max(t) - min(t) AS seconds FROM e GROUP BY 1)
      SELECT *, CASE WHEN seconds > 0 THEN round_even(network_bytes / seconds, 3) END AS network_rate FROM s""",
    "stage_stats_pivot": f"""WITH {_EVENTS} SELECT ts::DATE AS day, count(*) AS n_rows, count(*) FILTER (event_type = 'click') AS n_click,
      count(*) FILTER (event_type = 'error') AS n_error, count(*) FILTER (event_type = 'purchase') AS n_purchase,
      count(*) FILTER (event_type = 'signup') AS n_signup, count(*) FILTER (event_type = 'view') AS n_view,
      count(DISTINCT user_id) AS n_users, sum(cents)::BIGINT AS cents FROM e GROUP BY 1""",
    "run_rollup": """WITH s AS (SELECT user_id, min(event_id) FILTER (event_type = 'error') AS stop_at FROM events GROUP BY 1)
      SELECT user_id, count(*) FILTER (stop_at IS NULL OR event_id < stop_at) AS completed, count(*) AS n_stages,
      CASE WHEN max(stop_at) IS NULL THEN 'succeeded' ELSE 'error' END AS current_state FROM events JOIN s USING (user_id) GROUP BY 1""",
    "counter_rates": f"""WITH {_EVENTS}, c AS (SELECT event_type, t, t // 86400 * 86400 AS bucket, sum(cents) OVER (PARTITION BY event_type ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)::BIGINT % 2000000 AS total FROM e),
      d AS (SELECT *, lag(total) OVER (PARTITION BY event_type, bucket ORDER BY t, total) AS was FROM c),
      s AS (SELECT event_type, bucket, count(*) AS n_samples, coalesce(sum(CASE WHEN total < was THEN total ELSE total - was END), 0)::BIGINT AS growth, max(t) - min(t) AS seconds, count(*) FILTER (total < was) AS n_resets FROM d GROUP BY 1, 2)
      SELECT *, CASE WHEN seconds > 0 THEN round_even(growth / seconds, 3) END AS growth_rate FROM s""",
    "disk_estimate": """SELECT l_orderkey, sum(greatest(one, other))::BIGINT AS needed FROM (SELECT l_orderkey, l_linestatus,
      sum(round(l_quantity)::BIGINT * 1000)::BIGINT AS one, sum(round(l_extendedprice)::BIGINT)::BIGINT AS other FROM lineitem GROUP BY 1, 2) GROUP BY 1""",
    "history_latest": """SELECT user_id, event_type, ts, event_id FROM (SELECT user_id, event_type, ts, event_id,
      row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
      ORDER BY ts DESC, event_id DESC, user_id, event_type LIMIT 20""",
    "retry_schedule": f"""WITH {_EVENTS}, l AS (SELECT user_id, max(t) FILTER (event_type = 'purchase') AS ls FROM e GROUP BY 1),
      c AS (SELECT user_id, min(t) AS first_failed, max(t) AS last_failed, count(*) AS n_failures FROM e JOIN l USING (user_id)
      WHERE event_type = 'error' AND (ls IS NULL OR t > ls) GROUP BY 1)
      SELECT *, last_failed + CASE WHEN last_failed - first_failed < 259200 THEN 43200 WHEN last_failed - first_failed < 864000 THEN 86400 ELSE 604800 END AS next_retry FROM c""",
    "processing_result": """SELECT user_id, ts::DATE AS day, CASE WHEN bool_or(event_type = 'error') THEN 'failure' WHEN bool_or(event_type = 'signup') THEN 'cancelled'
      WHEN bool_and(event_type IN ('click', 'purchase', 'view')) THEN 'success' ELSE 'failure' END AS result, count(*) AS n_rows FROM events GROUP BY 1, 2""",
    "ledger_cost": """WITH o AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, abs(round(l_extendedprice * 100)::BIGINT) AS c, l_returnflag = 'R' AS r FROM lineitem),
      s AS (SELECT l_orderkey, count(*) FILTER (NOT r) AS n_charges, count(*) FILTER (r) AS n_refunds, sum(CASE WHEN r THEN -c ELSE c END)::BIGINT AS net FROM o WHERE c <> 0 GROUP BY 1)
      SELECT l_orderkey, n_charges, n_refunds, CASE WHEN n_charges > 0 AND net >= 0 THEN net END AS cost_cents FROM s""",
    "posting_conflicts": """SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS line_key, count(DISTINCT (l_partkey, l_suppkey, l_returnflag)) AS n_versions
      FROM lineitem GROUP BY 1 HAVING count(DISTINCT (l_partkey, l_suppkey, l_returnflag)) > 1""",
    "release_counts": """WITH c AS (SELECT c_nationkey, count(*) FILTER (c_acctbal < 0) AS e, count(*) FILTER (c_acctbal >= 0) AS o FROM customer GROUP BY 1)
      SELECT n_nationkey, n_name, coalesce(e, 0) AS n_error, coalesce(o, 0) AS n_ok, CASE WHEN e IS NULL THEN 'missing' WHEN e > 0 THEN 'problems' ELSE 'ok' END AS overall
      FROM nation LEFT JOIN c ON c_nationkey = n_nationkey""",
    "plan_branch": """WITH m AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
      SELECT o_orderkey, o_orderstatus, coalesce(n, 0) AS n_matches, CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'single' ELSE 'ambiguous' END AS mode
      FROM orders LEFT JOIN m ON l_orderkey = o_orderkey""",
    "version_chain": f"WITH {_PREFIX} SELECT conv_id, prefix FROM p",
    "chain_status": f"""WITH {_PREFIX}, s AS (SELECT conv_id, count(turn) AS n_turns, count(DISTINCT turn) AS n_places FROM conversations GROUP BY 1)
      SELECT conv_id, n_turns, n_places, prefix, CASE WHEN prefix = 0 THEN 'no-start' WHEN n_turns > n_places THEN 'branch'
      WHEN prefix < n_places THEN 'disconnected' ELSE 'ok' END AS status FROM s JOIN p USING (conv_id)""",
    "last_transition": """SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS r
      FROM conversations) WHERE r = 1""",
    "chunk_assign": """WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS rank FROM documents),
      n AS (SELECT greatest(1, ((SELECT count(*) FROM documents) + 31) // 32) AS size)
      SELECT doc_id, n_chars, rank, rank // size AS chunk, (rank % 8)::INT AS worker FROM r, n""",
    "format_bytes_duration": f"""SELECT doc_id, {_bytes_sql('(n_chars * 3000)')} AS size_text, CASE
      WHEN n_chars * 17 >= 86400 THEN (n_chars * 17 // 86400)::VARCHAR || 'd ' || {_TWO.format('(n_chars * 17 // 3600 % 24)')} || 'h'
      WHEN n_chars * 17 >= 3600 THEN (n_chars * 17 // 3600)::VARCHAR || 'h ' || {_TWO.format('(n_chars * 17 // 60 % 60)')} || 'm'
      WHEN n_chars * 17 >= 60 THEN (n_chars * 17 // 60)::VARCHAR || 'm ' || {_TWO.format('(n_chars * 17 % 60)')} || 's'
      ELSE (n_chars * 17)::VARCHAR || 's' END AS duration_text,
      '€' || (n_chars // 100)::VARCHAR || '.' || {_TWO.format('(n_chars % 100)')} AS money_text FROM documents""",
    "top_per_group": """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_suppkey, place::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS place FROM lineitem) WHERE place <= 3""",
    "with_missing": """SELECT c_custkey, coalesce(max(o_orderstatus), 'pending') AS state FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""",
    "grouped_text": """SELECT n_regionkey, string_agg('def ' || n_name, chr(10) ORDER BY n_name) AS text FROM nation GROUP BY 1""",
}
_COUNTS = SQL["release_counts"]
SQL["status_lines"] = f"""WITH x AS ({_COUNTS}) SELECT n_nationkey,
  '| ' || regexp_replace(n_name, '([\\\\`*_{{}}\\[\\]()#+.!|-])', '\\\\\\1', 'g') || ' | ' || n_error || ' | ' || n_ok || ' | ' || overall || ' |' AS markdown,
  '<tr><td>' || n_name || '</td><td>' || n_error || '</td><td>' || n_ok || '</td><td>' || overall || '</td></tr>' AS html,
  '{{"color":"' || CASE overall WHEN 'ok' THEN 'brightgreen' WHEN 'problems' THEN 'red' ELSE 'lightgrey' END || '","label":"' || n_name || '","message":"' || overall || '","schemaVersion":1}}' AS badge FROM x"""
