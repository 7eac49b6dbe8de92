"""Queries on stage statistics, states of targets, walks, manifests and text forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canon, formats
from ..operators import evidence, graph, history, integrity, overlay, planning, publish, stages, stats
from .runs import _EVENTS, _bytes_sql, _events
from .tables import table


def _artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as artifacts: whole sizes, and the quantities of returned lines as bytes thrown away."""
    lines = table(spark, sf_dir, "lineitem")
    lost = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_list(F.when(F.col("l_returnflag") == "R", F.round("l_quantity").cast("long"))).alias("lost"), F.count("*").alias("n_lines")
    )
    orders = table(spark, sf_dir, "orders").select("*", F.round("o_totalprice").cast("long").alias("size"), F.col("o_orderdate").cast("timestamp").cast("long").alias("t"))
    return orders.join(lost, "o_orderkey", "left")


_ARTIFACTS = """l AS (SELECT l_orderkey, list(round(l_quantity)::BIGINT) FILTER (l_returnflag = 'R') AS lost, count(*) AS n_lines FROM lineitem GROUP BY 1),
a AS (SELECT *, round(o_totalprice)::BIGINT AS size, floor(epoch(o_orderdate))::BIGINT AS t FROM orders LEFT JOIN l ON l_orderkey = o_orderkey)"""


def download_statistics(spark, sf_dir):
    rows = _artifacts(spark, sf_dir)
    method = F.when(F.col("o_orderstatus") == "O", "web_seed").when(F.col("o_orderstatus") == "P", "torrent")
    return stats.download_stats(
        rows, keys=["o_orderpriority"], size=F.col("size"), reused=F.col("o_orderstatus") == "F", resumed=F.col("o_custkey") * 10, attempts=F.col("n_lines"),
        segments=F.col("n_lines") - 2, discarded=F.col("lost"), method=method, methods=["web_seed", "torrent"], seconds=F.max("t") - F.min("t"),
    )


def plan_statistics(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list("o_orderkey").alias("artifacts"))
    parts = table(spark, sf_dir, "customer").join(orders, "c_custkey", "left").select(F.col("c_nationkey").alias("nation"), "artifacts")
    descriptors = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.length("s_name").alias("n"))
    return stats.plan_stats(parts, descriptors, keys=["nation"], artifacts=F.col("artifacts"), descriptor_bytes=F.col("n"))


def transform_statistics(spark, sf_dir):
    return stats.output_stats(
        _artifacts(spark, sf_dir), keys=["o_orderstatus"], size=F.col("size"), plain=F.col("o_orderpriority").startswith("1"), diagnostics=F.col("lost"),
        libraries=F.col("o_custkey"), seconds=F.max("t") - F.min("t"),
    )


def record_statistics(spark, sf_dir):
    rows = _events(spark, sf_dir)
    return stats.record_stats(rows, keys=["user_id"], kind="event_type", kinds=["click", "error", "view"], records=F.col("cents"), seconds=F.max("t") - F.min("t"))


def active_durations(spark, sf_dir):
    seconds = F.when(F.col("event_type") != "signup", F.col("cents"))
    return stats.active_seconds(_events(spark, sf_dir), run="user_id", seconds=seconds)


def _runs(spark, sf_dir):
    """Events as runs: purchases succeed, signups are cancelled, others fail; some name a release."""
    kind = F.col("event_type")
    result = F.when(kind == "purchase", "success").when(kind == "signup", "cancelled").otherwise("failure")
    release = F.when((kind == "purchase") | (F.col("cents") < 20000), F.concat(F.lit("r"), F.floor(F.col("cents") / 4000).cast("string")))
    return _events(spark, sf_dir).withColumns({"result": result, "release": release})


def _states(spark, sf_dir):
    return history.run_state(_runs(spark, sf_dir), target="user_id", order=["t", "event_id"], result=F.col("result"), release=F.col("release"), completed=F.col("t"))


_RUNS = f"""{_EVENTS}, u AS (SELECT *, CASE event_type WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'cancelled' ELSE 'failure' END AS result,
CASE WHEN event_type = 'purchase' OR cents < 20000 THEN 'r' || (cents // 4000)::VARCHAR END AS release FROM e)"""
_STATE = f"""{_RUNS},
v AS (SELECT user_id, arg_max(result, (t, event_id)) AS last_result, max((t, event_id)) FILTER (result = 'success') AS since FROM u GROUP BY 1),
w AS (SELECT v.*, u.release AS version FROM v LEFT JOIN u ON u.user_id = v.user_id AND (u.t, u.event_id) = v.since),
n AS (SELECT u.user_id, t, event_id, release FROM u JOIN w ON w.user_id = u.user_id WHERE result <> 'success' AND release IS NOT NULL
  AND (since IS NULL OR (t, event_id) > since) AND release IS DISTINCT FROM version),
g AS (SELECT *, last_value(release) OVER z AS retry_release, last_value(t) OVER z AS last_failed FROM n
  WINDOW z AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
b AS (SELECT user_id, max((t, event_id)) FILTER (release <> retry_release) AS broken FROM g GROUP BY 1),
f AS (SELECT g.user_id, any_value(retry_release) AS retry_release, any_value(last_failed) AS last_failed, min(t) AS first_failed FROM g JOIN b ON b.user_id = g.user_id
  WHERE broken IS NULL OR (t, event_id) > broken GROUP BY 1),
s AS (SELECT w.user_id, version, last_result, retry_release, first_failed, last_failed FROM w LEFT JOIN f ON f.user_id = w.user_id)"""


def run_states(spark, sf_dir):
    return _states(spark, sf_dir)


def _documents(spark, sf_dir):
    """State of each target as a status document, with the fields of its last run; some of them wrong."""
    last = history.latest(_runs(spark, sf_dir).select("user_id", "t", "event_id", "release", "cents"), keys=["user_id"], order=["t", "event_id"])
    both = _states(spark, sf_dir).join(last, "user_id")
    return both.select(
        "user_id", "version", F.when(F.col("version") != "r7", F.col("version")).alias("readable"), F.col("last_result").alias("result"), F.col("release").alias("run_release"),
        (F.col("t") - F.col("cents")).alias("started"), F.col("t").alias("completed"), F.least("cents", F.lit(40000)).alias("seconds"), "retry_release", "first_failed", "last_failed",
    )


def status_violations(spark, sf_dir):
    return integrity.violations(_documents(spark, sf_dir), ["user_id"], history.status_rules(now=F.lit(1706500000)))


def _chains(spark, sf_dir):
    """Each user's events as a chain; a signup of some amount leaves out the event before it."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    skips = (F.col("event_type") == "signup") & (F.col("cents") > 10000)
    before = F.when(skips, F.lag("event_id", 2).over(w)).otherwise(F.lag("event_id").over(w))
    return _events(spark, sf_dir).select("user_id", before.alias("source"), F.col("event_id").alias("target"))


_CHAINS = f"""{_EVENTS}, c AS (SELECT user_id::VARCHAR AS user_id, coalesce((CASE WHEN event_type = 'signup' AND cents > 10000 THEN lag(event_id, 2) OVER z ELSE lag(event_id) OVER z END)::VARCHAR, 'start') AS source,
  event_id::VARCHAR AS target FROM e WINDOW z AS (PARTITION BY user_id ORDER BY event_id)),
m AS (SELECT user_id, source, min(target) AS target FROM c GROUP BY 1, 2),
r AS (SELECT user_id, source, target, 1 AS hop FROM m WHERE source = 'start'
  UNION ALL SELECT m.user_id, m.source, m.target, r.hop + 1 FROM r JOIN m ON m.user_id = r.user_id AND m.source = r.target)"""


def chain_walk(spark, sf_dir):
    return graph.walk_chain(_chains(spark, sf_dir), key="user_id", source="source", target="target", start="start")


def chain_faults(spark, sf_dir):
    return graph.chain_errors(_chains(spark, sf_dir), key="user_id", source="source", target="target", start="start")


def redirect_walk(spark, sf_dir):
    edges = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source"), ((F.col("c_custkey") * 7 + 3) % 200).alias("target"))
    return graph.follow_redirects(edges, source="source", target="target")


def manifest_digest(spark, sf_dir):
    """Digest of each day's lines in order, as a file of them has it."""
    fields = {c: F.col(c) for c in ("event_id", "user_id", "event_type", "props")} | {"value_cents": F.col("cents")}
    lines = _events(spark, sf_dir).select(F.to_date("ts").cast("string").alias("part"), "event_id", canon.canonical_json(fields).alias("line"))
    found = integrity.joined_digest(lines, "part", ["event_id"], "line")
    return found.withColumnsRenamed({"n_rows": "records"})


def text_forms(spark, sf_dir):
    """Forms of texts and numbers that manifests, logs and schedules use."""
    n = F.col("n_chars")
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        canon.fold_case(F.col("source")).alias("folded"),
        canon.percent_encode(F.concat_ws("/", "lang", F.concat(F.lit("a b+"), F.col("source")))).alias("encoded"),
        F.array_join(canon.base64_components(F.concat_ws("/", "lang", "source")), "/").alias("components"),
        canon.prefixed_digest(F.concat_ws("/", "lang", "source")).alias("digest"),
        formats.normalize_newlines(F.replace(text, F.lit("\n"), F.lit("\r\n"))).alias("lines"),
        formats.redact_secrets(F.concat(F.lit("token="), F.col("source"), F.lit("&x=1 https://user:pw@host/"))).alias("redacted"),
        formats.readable_version(F.concat(F.lit("v."), (n % 9).cast("string"), F.lit(".4 Common #"), n.cast("string"))).alias("version"),
        formats.retry_delay(n % 20, base=0.5, cap=300.0).alias("delay"),
        formats.segment_count(n * 100000, least_size=512 << 20, target=128 << 20, most=16).alias("segments"),
        formats.time_budget(n.cast("double"), n % 33, F.lit(4), most=3600.0).alias("budget"),
    )


def strict_fields(spark, sf_dir):
    props = F.coalesce("props", F.lit("{}"))
    names = F.array(F.lit("a"), "event_type", F.lit(""), "event_type", F.lit("a"), F.substring("event_type", 1, 0))
    return table(spark, sf_dir, "events").select(
        "event_id",
        canon.strict_field(F.concat(F.lit('{"a":'), "user_id", F.lit(',"b":"7","c":true,"p":'), props, F.lit("}")), "$.a", "long").alias("a_long"),
        canon.strict_field(F.concat(F.lit('{"b":"'), "user_id", F.lit('"}')), "$.b", "long").alias("b_long"),
        canon.strict_field(F.concat(F.lit('{"b":"'), "user_id", F.lit('"}')), "$.b", "string").alias("b_text"),
        canon.strict_field(F.concat(F.lit('{"c":'), "user_id", F.lit("}")), "$.c", "string").alias("c_text"),
        formats.utc_text(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".25+02:00"))).alias("utc"),
        formats.utc_text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("no_zone"),
        formats.local_text(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")), "Asia/Tokyo").alias("local"),
        F.array_join(formats.unique_names(names), ",").alias("parameters"),
    )


def install_chains(spark, sf_dir):
    """Users without just one signup."""
    return integrity.not_exactly_one(table(spark, sf_dir, "events"), ["user_id"], F.col("event_type") == "signup")


def stale_stages(spark, sf_dir):
    """Errors count as running stages; users with a purchase hold a lock."""
    events = table(spark, sf_dir, "events")
    rows = events.select("event_id", "user_id", F.when(F.col("event_type") == "error", "running").otherwise("succeeded").alias("state"))
    return stages.interrupt_stale(rows, events.where("event_type = 'purchase'"), "user_id")


def resume_choices(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    own = orders.select(
        F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("url"), F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("tag"), F.col("o_orderdate").cast("string").alias("date")
    )
    was = own.where("url <> '5-LOW'").withColumn("url", F.when(F.col("url") == "4-NOT SPECIFIED", "other").otherwise(F.col("url")))
    was = was.withColumn("tag", F.when(F.col("tag").endswith("7"), F.lit("stale")).otherwise(F.col("tag")))
    return planning.resume_decision(was, own, key="key", fields=["url"], validators=["tag", "date"]).select("key", "decision")


def overlay_replace(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("kind")).distinct().withColumn("value", F.lit("base"))
    over = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_nationkey").alias("nation"), F.lit("BUILDING").alias("kind")).distinct().withColumn("value", F.lit("locale"))
    return overlay.overlay(customers, over, keys=["nation", "kind"], value="value")


def signature_families(spark, sf_dir):
    roles = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r"))
    shapes = roles.select(F.lit("talk").alias("name"), F.transform("r", lambda x: x["role"]).alias("params")).distinct()
    found = evidence.expand_families(shapes, name="name", params="params")
    return found.select("name", F.array_join("short", ",").alias("short"), F.array_join("longer", ",").alias("longer"))


def member_owners(spark, sf_dir):
    """The only brand with a part of the type and size that a name asks for."""
    lines = table(spark, sf_dir, "part")
    modules = lines.groupBy("p_brand").agg(F.collect_set(F.concat_ws("/", "p_type", "p_size")).alias("attributes"))
    members = lines.select(F.col("p_name").alias("name"), F.array(F.concat_ws("/", "p_type", "p_size")).alias("wanted"))
    return evidence.owners(modules, members, module="p_brand", attributes="attributes", name="name", wanted="wanted")


def published_rows(spark, sf_dir):
    """Orders as files of three kinds: each row with the fields of its kind, base layer first."""
    orders = table(spark, sf_dir, "orders")
    kind = F.element_at(F.create_map(*map(F.lit, ("F", "package", "O", "loose", "P", "tree"))), F.col("o_orderstatus"))
    customer, priority = F.col("o_custkey"), F.col("o_orderpriority")
    fields = {"package": {"package": customer, "entry": priority}, "loose": {"path": priority}, "tree": {"path": F.concat(F.lit("t/"), priority), "package": customer}}
    path = F.concat_ws("/", F.when(customer % 3 == 0, "res").otherwise("bin"), F.concat("o_orderpriority", F.when(customer % 5 == 0, ".XML").otherwise(".exe")))
    flat = publish.by_kind(orders.withColumn("path", path), kind=kind, fields=fields, keep=["o_orderkey", "path"])
    included = publish.is_included(F.col("path"), files=["bin/1-URGENT.exe"], folders=["res"], suffixes=[".xml", ".txt"])
    return flat.select("o_orderkey", F.col("source.kind").alias("kind"), F.col("source.entry").alias("entry"), F.col("source.package").alias("package"), F.col("source.path").alias("source_path"), included.alias("included"))


def zero_states(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    path = F.concat_ws("/", F.lit("p"), F.concat(F.col("l_linestatus"), F.when(F.col("l_linenumber") == 3, ".DIFF").otherwise(".pkg")))
    files = lines.select("l_orderkey", path.alias("path"), F.when(F.col("l_returnflag") != "N", (F.col("l_linenumber") - 1).cast("string")).alias("since"))
    return publish.zero_state_errors(files, keys=["l_orderkey"], path="path", since=F.col("since"), delta_suffixes=[".diff"], delta_files=["F.pkg"])


def space_needed(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.round("l_extendedprice").cast("long").alias("size"))
    cached = table(spark, sf_dir, "part").where("p_size < 20").select(F.col("p_partkey").alias("l_partkey"))
    return publish.needed_space(lines, cached, keys=["l_orderkey"], item="l_partkey", size="size", free=F.lit(150000).cast("long"))


def server_rules(spark, sf_dir):
    """Suppliers as servers: those owned, and what their quotes lack."""
    servers = table(spark, sf_dir, "supplier")
    mine = publish.owned(servers, name=F.col("s_name").startswith("Supplier"), product=F.col("s_nationkey") < 20, terms=[F.col("s_nationkey") > 1], deleted=F.col("s_acctbal") < -900)
    wanted = {"group": F.col("s_nationkey") != 7, "status": publish.http_class(F.col("s_nationkey") * 40) != "fatal"}
    return publish.quote_errors(mine, key=["s_suppkey"], wanted=wanted, price=F.col("s_nationkey") * 10.0, most=150.0, balance=F.col("s_acctbal"))


def visible_modules(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("module"), F.col("p_type").alias("attribute"), "p_size")
    sources = parts.where("p_size = 50").select("module")
    return publish.with_evidence(parts.select("module", "attribute"), sources, parts.where("p_size = 1").select("attribute"), module="module", attribute="attribute")


def duration_forms(spark, sf_dir):
    n = F.col("n_chars")
    return table(spark, sf_dir, "documents").select("doc_id", formats.format_clock(n).alias("clock"), formats.format_words(n).alias("words"), formats.format_rate(F.when(n > 100, n * 70)).alias("speed"))


QUERIES = {
    f.__name__: f
    for f in (
        download_statistics, plan_statistics, transform_statistics, record_statistics, active_durations, run_states, status_violations, chain_walk, chain_faults, redirect_walk,
        manifest_digest, text_forms, strict_fields, install_chains, stale_stages, resume_choices, overlay_replace, signature_families, member_owners,
        published_rows, zero_states, space_needed, server_rules, visible_modules, duration_forms,
    )
}

_F = "o_orderstatus <> 'F'"
_TAKEN = "least(size, o_custkey * 10)"
_LOST = "coalesce(list_sum(lost), 0)"

SQL = {
    "download_statistics": f"""WITH {_ARTIFACTS}, s AS (SELECT o_orderpriority, count(*) AS n_items, count(*) FILTER ({_F}) AS n_fetched, count(*) FILTER (o_orderstatus = 'F') AS n_reused,
      coalesce(sum(size) FILTER (o_orderstatus = 'F'), 0)::BIGINT AS reused_bytes, coalesce(sum({_TAKEN}) FILTER ({_F}), 0)::BIGINT AS resumed_bytes,
      coalesce(sum(size - {_TAKEN} + {_LOST}) FILTER ({_F}), 0)::BIGINT AS network_bytes, coalesce(sum(n_lines) FILTER ({_F}), 0)::BIGINT AS attempts,
      count(*) FILTER ({_F} AND n_lines > 3) AS n_parallel, coalesce(sum(n_lines - 2) FILTER ({_F} AND n_lines > 3), 0)::BIGINT AS parallel_segments,
      count(*) FILTER ({_F} AND len(lost) > 0) AS n_fallback_items, coalesce(sum(len(lost)) FILTER ({_F}), 0)::BIGINT AS n_fallbacks,
      coalesce(sum({_LOST}) FILTER ({_F}), 0)::BIGINT AS discarded_bytes, count(*) FILTER (o_orderstatus = 'O') AS n_web_seed, count(*) FILTER (o_orderstatus = 'P') AS n_torrent,
      max(t) - min(t) AS seconds FROM a GROUP BY 1) SELECT *, CASE WHEN seconds > 0 THEN round_even(network_bytes / seconds, 3) END AS network_rate FROM s""",
    "plan_statistics": """WITH o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
      p AS (SELECT c_nationkey AS nation, count(*) AS n_parts, sum(coalesce(n, 0))::BIGINT AS n_artifacts FROM customer LEFT JOIN o ON o_custkey = c_custkey GROUP BY 1),
      d AS (SELECT s_nationkey, count(*) AS n_descriptors, sum(length(s_name))::BIGINT AS descriptor_bytes FROM supplier GROUP BY 1)
      SELECT nation, n_parts, n_artifacts, coalesce(n_descriptors, 0) AS n_descriptors, coalesce(descriptor_bytes, 0)::BIGINT AS descriptor_bytes FROM p LEFT JOIN d ON s_nationkey = nation""",
    "transform_statistics": f"""WITH {_ARTIFACTS}, s AS (SELECT o_orderstatus, count(*) AS n_files, sum(size)::BIGINT AS output_bytes, count(*) FILTER (starts_with(o_orderpriority, '1')) AS n_plain,
      count(*) FILTER (NOT starts_with(o_orderpriority, '1')) AS n_transformed, coalesce(sum(len(lost)), 0)::BIGINT AS n_diagnostics, count(DISTINCT o_custkey) AS n_libraries,
      max(t) - min(t) AS seconds FROM a GROUP BY 1) SELECT *, CASE WHEN seconds > 0 THEN round_even(output_bytes / seconds, 3) END AS output_rate FROM s""",
    "record_statistics": f"""WITH {_EVENTS}, s AS (SELECT user_id, sum(cents) FILTER (event_type = 'click')::BIGINT AS click_records, sum(cents) FILTER (event_type = 'error')::BIGINT AS error_records,
      sum(cents) FILTER (event_type = 'view')::BIGINT AS view_records, max(t) - min(t) AS seconds FROM e GROUP BY 1), k AS (SELECT *, click_records + error_records + view_records AS records FROM s)
      SELECT *, CASE WHEN seconds > 0 THEN round_even(records / seconds, 3) END AS records_rate FROM k""",
    "active_durations": f"WITH {_EVENTS} SELECT user_id, sum(CASE WHEN event_type <> 'signup' THEN cents ELSE 0 END)::BIGINT AS active_seconds FROM e GROUP BY 1",
    "run_states": f"WITH {_STATE} SELECT * FROM s",
    "status_violations": f"""WITH {_STATE}, x AS (SELECT user_id, arg_max(release, (t, event_id)) AS last_release, arg_max(cents, (t, event_id)) AS cents, max(t) AS completed FROM u GROUP BY 1),
      y AS (SELECT user_id, (SELECT release FROM u WHERE u.user_id = x.user_id ORDER BY t DESC, event_id DESC LIMIT 1) AS run_release, cents, completed FROM x),
      d AS (SELECT s.user_id, version, CASE WHEN version <> 'r7' THEN version END AS readable, last_result AS result, run_release, completed - cents AS started, completed,
        least(cents, 40000) AS seconds, retry_release, first_failed, last_failed FROM s JOIN y ON y.user_id = s.user_id),
      q AS (SELECT *, run_release IS NOT NULL AND run_release IS DISTINCT FROM version AS unpublished FROM d)
      SELECT user_id, error_code FROM (SELECT user_id, unnest([
        CASE WHEN (version IS NULL) <> (readable IS NULL) THEN 'version-without-text' END, CASE WHEN result = 'success' AND run_release IS NULL THEN 'success-without-version' END,
        CASE WHEN result = 'success' AND run_release IS DISTINCT FROM version THEN 'success-of-other-version' END, CASE WHEN completed < started THEN 'completed-before-start' END,
        CASE WHEN completed > 1706500000 THEN 'completed-in-future' END, CASE WHEN seconds <> completed - started OR seconds > 86400 THEN 'duration' END,
        CASE WHEN result <> 'success' AND unpublished AND retry_release IS NULL THEN 'failure-without-retry' END, CASE WHEN retry_release IS NOT NULL AND retry_release IS NOT DISTINCT FROM version THEN 'retry-of-version' END,
        CASE WHEN retry_release IS NOT NULL AND result = 'success' THEN 'retry-after-success' END, CASE WHEN first_failed > last_failed THEN 'retry-order' END,
        CASE WHEN last_failed > completed THEN 'retry-of-later-run' END,
        CASE WHEN retry_release IS NOT NULL AND result <> 'success' AND unpublished AND (retry_release <> run_release OR last_failed <> completed) THEN 'retry-of-other-run' END]) AS error_code FROM q)
      WHERE error_code IS NOT NULL""",
    "chain_walk": f"WITH RECURSIVE {_CHAINS} SELECT user_id, source, target, hop, false AS cycle FROM r",
    "chain_faults": f"""WITH RECURSIVE {_CHAINS}, b AS (SELECT DISTINCT user_id FROM (SELECT user_id, source FROM c GROUP BY 1, 2 HAVING count(*) > 1))
      SELECT user_id, 'branch' AS error_code FROM b UNION ALL SELECT DISTINCT c.user_id, 'disconnected' FROM c
      WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.user_id = c.user_id AND r.source = c.source) AND c.user_id NOT IN (SELECT user_id FROM b)
      UNION ALL SELECT user_id, 'no-start' FROM c GROUP BY 1 HAVING count(*) FILTER (source = 'start') = 0""",
    "redirect_walk": """WITH RECURSIVE m AS (SELECT c_custkey AS source, (c_custkey * 7 + 3) % 200 AS target FROM customer),
      w AS (SELECT source, target AS place, 1 AS hops, [source, target] AS seen, source = target AS again FROM m
        UNION ALL SELECT w.source, m.target, hops + 1, list_append(seen, m.target), list_contains(seen, m.target) FROM w JOIN m ON m.source = w.place WHERE NOT again AND hops < 9)
      SELECT source, arg_max(place, hops) AS final, max(hops) AS hops, CASE WHEN max(hops) > 8 THEN 'too-many-hops' WHEN bool_or(again) THEN 'cycle' ELSE 'ok' END AS state FROM w GROUP BY 1""",
    "manifest_digest": """WITH l AS (SELECT ts::DATE::VARCHAR AS part, event_id, to_json({event_id: event_id, event_type: event_type, props: props, user_id: user_id,
      value_cents: round(value * 100)::BIGINT})::VARCHAR || chr(10) AS line FROM events)
      SELECT part, count(*) AS records, sha256(string_agg(line, '' ORDER BY event_id)) AS digest FROM l GROUP BY 1""",
    "text_forms": """SELECT doc_id, lower(source) AS folded, lang || '/a%20b%2B' || url_encode(source) AS encoded, base64(encode(lang)) || '/' || base64(encode(source)) AS components,
      'sha256:' || sha256(lang || '/' || source) AS digest, regexp_replace(replace(coalesce(text, ''), chr(10), chr(13) || chr(10)), '\\r\\n?', chr(10), 'g') AS lines,
      'token=REDACTED&x=1 https://REDACTED@host/' AS redacted, (n_chars % 9)::VARCHAR || '.4 #' || n_chars::VARCHAR AS version,
      CASE WHEN n_chars % 20 <= 1 THEN 0 ELSE least(0.5 * pow(2, least(greatest(n_chars % 20 - 2, 0), 10)), 300) END::DOUBLE AS delay,
      CASE WHEN n_chars * 100000 < 536870912 THEN 1 ELSE greatest(1, least(16, n_chars * 100000 // 134217728)) END::INTEGER AS segments,
      least(3600, n_chars * greatest(1, ceil(n_chars % 33 / 4)))::DOUBLE AS budget FROM documents""",
    "strict_fields": """SELECT event_id, user_id AS a_long, NULL::BIGINT AS b_long, user_id::VARCHAR AS b_text, NULL::VARCHAR AS c_text,
      strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS utc, NULL::VARCHAR AS no_zone, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS local,
      'a,' || event_type || ',arg2,arg3,arg4,arg5' AS parameters FROM events""",
    "install_chains": "SELECT user_id, count(*) FILTER (event_type = 'signup') AS n_wanted FROM events GROUP BY 1 HAVING n_wanted <> 1",
    "stale_stages": """SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN 'succeeded' WHEN user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase') THEN 'running' ELSE 'interrupted' END AS state FROM events""",
    "resume_choices": """SELECT o_orderkey AS key, CASE WHEN o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') THEN 'restart' WHEN o_orderstatus <> 'P' AND o_custkey % 10 = 7 THEN 'restart' ELSE 'resume' END AS decision FROM orders""",
    "overlay_replace": """WITH o AS (SELECT DISTINCT s_nationkey AS nation, 'BUILDING' AS kind FROM supplier WHERE s_acctbal < 0), b AS (SELECT DISTINCT c_nationkey AS nation, c_mktsegment AS kind FROM customer)
      SELECT nation, kind, 'locale' AS value, 1 AS layer FROM o UNION ALL SELECT nation, kind, 'base', 0 FROM b WHERE (nation, kind) NOT IN (SELECT (nation, kind) FROM o)""",
    "signature_families": """WITH r AS (SELECT conv_id, list(role ORDER BY turn, role) AS p FROM conversations GROUP BY 1), d AS (SELECT DISTINCT p FROM r)
      SELECT 'talk' AS name, array_to_string(a.p, ',') AS short, array_to_string(b.p, ',') AS longer FROM d a JOIN d b ON len(b.p) > len(a.p) AND b.p[:len(a.p)] = a.p""",
    "member_owners": """WITH a AS (SELECT DISTINCT p_brand, p_type || '/' || p_size::VARCHAR AS m FROM part), n AS (SELECT DISTINCT p_name AS name, p_type || '/' || p_size::VARCHAR AS m FROM part),
      h AS (SELECT name, count(DISTINCT p_brand) AS k, min(p_brand) AS b FROM n JOIN a ON a.m = n.m GROUP BY 1) SELECT name, CASE WHEN k = 1 THEN b END AS owner FROM h""",
    "published_rows": """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'package' WHEN 'O' THEN 'loose' ELSE 'tree' END AS kind, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS entry,
      CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS package, CASE o_orderstatus WHEN 'O' THEN o_orderpriority WHEN 'P' THEN 't/' || o_orderpriority END AS source_path,
      (o_custkey % 3 = 0 AND o_custkey % 5 = 0) OR (o_custkey % 3 <> 0 AND o_custkey % 5 <> 0 AND o_orderpriority = '1-URGENT') AS included FROM orders""",
    "zero_states": """SELECT DISTINCT l_orderkey, error_code FROM (SELECT l_orderkey, unnest([CASE WHEN l_returnflag <> 'N' AND l_linenumber <> 1 THEN 'not-zero-state' END,
      CASE WHEN l_linenumber = 3 THEN 'delta-suffix' END, CASE WHEN l_linenumber <> 3 AND l_linestatus = 'F' THEN 'delta-service-file' END]) AS error_code FROM lineitem) WHERE error_code IS NOT NULL""",
    "space_needed": """WITH i AS (SELECT l_orderkey, l_partkey, max(round(l_extendedprice)::BIGINT) AS size FROM lineitem GROUP BY 1, 2),
      n AS (SELECT l_orderkey, coalesce(sum(size) FILTER (l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 20)), 0)::BIGINT AS needed FROM i GROUP BY 1)
      SELECT l_orderkey, needed, needed <= 150000 AS fits FROM n""",
    "server_rules": """WITH m AS (SELECT * FROM supplier WHERE starts_with(s_name, 'Supplier') AND s_nationkey BETWEEN 2 AND 19 AND s_acctbal >= -900)
      SELECT s_suppkey, error_code FROM (SELECT s_suppkey, unnest([CASE WHEN s_nationkey = 7 THEN 'group' END,
        CASE WHEN NOT (s_nationkey * 40 BETWEEN 200 AND 299 OR s_nationkey * 40 IN (404, 429) OR s_nationkey * 40 BETWEEN 500 AND 599) THEN 'status' END,
        CASE WHEN s_nationkey * 10.0 > 150 THEN 'price' END, CASE WHEN s_acctbal < s_nationkey * 10.0 * 4 THEN 'balance' END]) AS error_code FROM m) WHERE error_code IS NOT NULL""",
    "visible_modules": """SELECT DISTINCT p_brand AS module FROM part WHERE p_type IN (SELECT p_type FROM part WHERE p_size = 1) AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 50)""",
    "duration_forms": f"""SELECT doc_id, CASE WHEN n_chars >= 3600 THEN (n_chars // 3600)::VARCHAR || ':' || lpad((n_chars % 3600 // 60)::VARCHAR, 2, '0') ELSE (n_chars // 60)::VARCHAR END || ':' || lpad((n_chars % 60)::VARCHAR, 2, '0') AS clock,
      CASE WHEN n_chars >= 3600 THEN (n_chars // 3600)::VARCHAR || ' h' || CASE WHEN n_chars % 3600 // 60 > 0 THEN ' ' || (n_chars % 3600 // 60)::VARCHAR || ' min' ELSE '' END
        WHEN n_chars >= 60 THEN (n_chars % 3600 // 60)::VARCHAR || ' min' ELSE n_chars::VARCHAR || ' s' END AS words,
      CASE WHEN n_chars > 100 THEN ({_bytes_sql('(n_chars * 70)')}) || '/s' ELSE 'unknown' END AS speed FROM documents""",
}
