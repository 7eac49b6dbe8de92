"""Queries on layers, manifests and digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canon import canonical_json, fold_case, sha256
from ..operators import integrity, overlay, stats
from .tables import table


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = sha256(F.lower(F.trim(F.coalesce("text", F.lit("")))))
    precedence = F.expr("CAST(substring(source, 4) AS INT)")
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("layer"), key.alias("key"), precedence.alias("precedence"), "doc_id")


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlay.resolve_first_wins(_candidates(spark, sf_dir), keys=["layer", "key"], precedence="precedence", tie="doc_id")


_CANDIDATES = """c AS (SELECT lang AS layer, sha256(lower(trim(coalesce(text, '')))) AS key,
  CAST(substr(source, 4) AS INT) AS precedence, doc_id FROM documents)"""
_RESOLVED = f"""{_CANDIDATES},
l AS (SELECT layer, key, precedence, count(*) AS n, min(doc_id) AS tie FROM c GROUP BY ALL),
b AS (SELECT layer, key, arg_min(tie, precedence) AS winner, sum(n)::BIGINT AS n_candidates, arg_min(n, precedence) AS n_best
  FROM l GROUP BY layer, key),
r AS (SELECT *, CASE WHEN n_candidates = 1 THEN 'only-candidate' WHEN n_best > 1 THEN 'ambiguous' ELSE 'first-listed' END AS rule FROM b)"""


def overlay_winner(spark, sf_dir):
    return _resolved(spark, sf_dir)


def conflict_manifest(spark, sf_dir):
    return overlay.conflicting_candidates(_candidates(spark, sf_dir), _resolved(spark, sf_dir), keys=["layer", "key"], tie="doc_id")


def index_stats(spark, sf_dir):
    return stats.conflict_stats(_resolved(spark, sf_dir), ["layer"])


def overlay_layers(spark, sf_dir):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1)
    found = overlay.overlay_layers(table(spark, sf_dir, "orders"), keys=["o_custkey"], value=F.col("o_totalprice"), rank=rank, layers={0: "base", 1: "override"})
    return found.select("o_custkey", F.col("value").alias("price"), "layer", "n_layers")


def case_collisions(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return overlay.collisions(pages.select(F.upper(F.substring(F.md5("url"), 1, 1)).alias("side"), host.alias("host")), scope=[], name=F.when(F.col("side") < "8", F.initcap("host")).otherwise(F.col("host")), folded=fold_case(F.col("host")))


def manifest_size_audit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    actual, size = F.length("text").cast("long"), F.octet_length("text").cast("long")
    return docs.select("doc_id", F.col("n_chars").alias("declared"), actual.alias("actual"), size.alias("n_bytes"), sha256(F.col("text")).alias("digest"), (F.col("n_chars") == actual).alias("agrees"))


def manifest_presence_audit(spark, sf_dir):
    return integrity.presence(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


def reference_anti(spark, sf_dir):
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    checks = (
        ("supplier", lines, "l_suppkey", table(spark, sf_dir, "supplier"), "s_suppkey"),
        ("part", lines, "l_partkey", table(spark, sf_dir, "part"), "p_partkey"),
        ("lines", orders, "o_orderkey", lines.select("l_orderkey").distinct(), "l_orderkey"),
    )
    found = [integrity.missing_references(rows, column, known, other).select(F.lit(name).alias("check_name"), "reference", "n_rows") for name, rows, column, known, other in checks]
    return found[0].union(found[1]).union(found[2])


def order_violations(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    found = integrity.order_violations(events, "event_id", ["user_id", "ts"])
    return found.select("event_id", "user_id", "previous_user_id")


def totals_check(spark, sf_dir):
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    declared = table(spark, sf_dir, "orders").select("o_orderkey", cents("o_totalprice").alias("cents"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), cents("l_extendedprice").alias("line_cents"))
    return integrity.totals_differ(declared, lines, ["o_orderkey"], "cents", "line_cents")


def unique_key_violations(spark, sf_dir):
    return integrity.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def signature_consistency(spark, sf_dir):
    return integrity.inconsistent_groups(table(spark, sf_dir, "part"), ["p_brand"], ["p_type", "p_size"])


def split_contiguity(spark, sf_dir):
    return integrity.contiguity(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


def split_assembly(spark, sf_dir):
    return integrity.joined_digest(table(spark, sf_dir, "conversations"), "conv_id", ["turn", "text"], "text")


def digest_chain(spark, sf_dir):
    return integrity.digest_chain(table(spark, sf_dir, "conversations"), "conv_id", ["turn", "text"], "text")


def canonical_digest(spark, sf_dir):
    cents = F.round(F.col("value") * 100).cast("long")
    fields = {c: F.col(c) for c in ("event_id", "user_id", "event_type", "props")} | {"value_cents": cents}
    text = canonical_json(fields)
    return table(spark, sf_dir, "events").select("event_id", text.alias("line"), sha256(text).alias("digest"))


def invariant_violations(spark, sf_dir):
    checks = {
        "quantity-not-positive": F.col("l_quantity") > 0,
        "discount-out-of-range": F.col("l_discount").between(0, 0.08),
        "unknown-flag": F.col("l_returnflag").isin("A", "N", "R"),
        "price-below-quantity": F.col("l_extendedprice") >= F.col("l_quantity") * 100,
    }
    return integrity.violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], checks)


def set_difference(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    return integrity.set_difference(customers, suppliers, "nation")


def limit_violations(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    limits = {
        "too-many-lines": (F.count("*"), 6),
        "too-much-quantity": (F.sum(F.round("l_quantity").cast("long")), 150),
        "too-many-suppliers": (F.count_distinct("l_suppkey"), 6),
    }
    return integrity.limit_violations(lines, keys=["l_orderkey"], limits=limits)


def total_join(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    known = customers.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return integrity.total_join(orders.select("o_orderkey", "o_custkey"), known, ["o_custkey"], "customer")


def same_ids(spark, sf_dir):
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role").distinct()
    expected = talks.select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant").alias("role")).distinct()
    return integrity.same_ids(talks, expected, key="conv_id", order="turn", item="role")


def full_audit(spark, sf_dir):
    """Every check of the tables at once: how many violations each has."""
    checks = {
        "order-total": totals_check(spark, sf_dir),
        "duplicate-line": unique_key_violations(spark, sf_dir),
        "line-numbers": split_contiguity(spark, sf_dir).where("NOT contiguous"),
        "reference": reference_anti(spark, sf_dir),
        "declared-size": manifest_size_audit(spark, sf_dir).where("NOT agrees"),
        "unlabelled": manifest_presence_audit(spark, sf_dir).where("state <> 'present'"),
        "ambiguous-winner": overlay_winner(spark, sf_dir).where("rule = 'ambiguous'"),
        "invariant": invariant_violations(spark, sf_dir),
    }
    counts = [rows.agg(F.count("*").alias("n_violations")).select(F.lit(name).alias("check_name"), "n_violations") for name, rows in checks.items()]
    found = counts[0]
    for other in counts[1:]:
        found = found.union(other)
    return found


QUERIES = {
    f.__name__: f
    for f in (
        overlay_winner, overlay_layers, conflict_manifest, index_stats, case_collisions, manifest_size_audit, manifest_presence_audit,
        reference_anti, order_violations, totals_check, unique_key_violations, signature_consistency, split_contiguity, split_assembly,
        digest_chain, canonical_digest, invariant_violations, set_difference, limit_violations, total_join, same_ids, full_audit,
    )
}

SQL = {
    "overlay_winner": f"WITH {_RESOLVED} SELECT layer, key, winner, n_candidates, n_best, rule FROM r",
    "conflict_manifest": f"""WITH {_RESOLVED} SELECT layer, key, doc_id AS candidate, doc_id = winner AS won, n_candidates
      FROM c JOIN r USING (layer, key) WHERE n_candidates > 1""",
    "index_stats": f"""WITH {_RESOLVED} SELECT layer, count(*) AS n_entries, sum(n_candidates)::BIGINT AS n_candidates,
      count(*) FILTER (n_candidates > 1) AS n_conflicts, count(*) FILTER (rule = 'ambiguous') AS n_ambiguous FROM r GROUP BY layer""",
    "overlay_layers": """WITH s AS (SELECT o_custkey, max(o_totalprice) FILTER (o_orderstatus = 'F') AS f, max(o_totalprice) FILTER (o_orderstatus = 'O') AS o
      FROM orders GROUP BY 1) SELECT o_custkey, coalesce(o, f) AS price, CASE WHEN o IS NULL THEN 'base' ELSE 'override' END AS layer,
      (f IS NOT NULL)::BIGINT + (o IS NOT NULL)::BIGINT AS n_layers FROM s WHERE f IS NOT NULL OR o IS NOT NULL""",
    "case_collisions": """WITH h AS (SELECT upper(substr(md5(url), 1, 1)) AS side, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS host FROM pages)
      SELECT lower(host) AS folded, count(DISTINCT CASE WHEN side < '8' THEN upper(substr(host, 1, 1)) || lower(substr(host, 2)) ELSE host END) AS n_spellings, count(*) AS n_rows
      FROM h GROUP BY 1 HAVING n_spellings > 1""",
    "manifest_size_audit": """SELECT doc_id, n_chars AS declared, length(text)::BIGINT AS actual, octet_length(encode(text))::BIGINT AS n_bytes,
      sha256(text) AS digest, n_chars = length(text) AS agrees FROM documents""",
    "manifest_presence_audit": """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing'
      WHEN d.doc_id IS NULL THEN 'unmanifested' ELSE 'present' END AS state
      FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""",
    "reference_anti": """SELECT 'supplier' AS check_name, l_suppkey AS reference, count(*) AS n_rows FROM lineitem
      WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 2
      UNION ALL SELECT 'part', l_partkey, count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part) GROUP BY 2
      UNION ALL SELECT 'lines', o_orderkey, count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 2""",
    "order_violations": """SELECT event_id, user_id, previous_user_id FROM (SELECT event_id, user_id, ts, lag(user_id) OVER w AS previous_user_id,
      lag(ts) OVER w AS previous_ts FROM events WINDOW w AS (ORDER BY event_id))
      WHERE user_id < previous_user_id OR (user_id = previous_user_id AND ts <= previous_ts)""",
    "totals_check": """WITH s AS (SELECT l_orderkey, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS a FROM lineitem GROUP BY 1)
      SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS declared, coalesce(a, 0) AS actual, coalesce(a, 0) - round(o_totalprice * 100)::BIGINT AS difference
      FROM orders LEFT JOIN s ON l_orderkey = o_orderkey WHERE round(o_totalprice * 100)::BIGINT <> coalesce(a, 0)""",
    "unique_key_violations": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "signature_consistency": """SELECT p_brand, count(DISTINCT (p_type, p_size)) AS n_signatures FROM part GROUP BY 1 HAVING count(DISTINCT (p_type, p_size)) > 1""",
    "split_contiguity": """SELECT *, first_index = 1 AND last_index = n_rows AND n_distinct = n_rows AS contiguous FROM (
      SELECT l_orderkey, min(l_linenumber)::BIGINT AS first_index, max(l_linenumber)::BIGINT AS last_index, count(*) AS n_rows,
      count(DISTINCT l_linenumber) AS n_distinct FROM lineitem GROUP BY 1)""",
    "split_assembly": """SELECT conv_id, count(*) AS n_rows, sha256(string_agg(coalesce(text, ''), '' ORDER BY turn, text)) AS digest FROM conversations GROUP BY 1""",
    "digest_chain": """SELECT conv_id, len(t)::BIGINT AS n_rows, list_reduce(list_prepend('', t), lambda a, b: sha256(a || b)) AS digest
      FROM (SELECT conv_id, list(coalesce(text, '') ORDER BY turn, text) AS t FROM conversations GROUP BY 1)""",
    "canonical_digest": """WITH l AS (SELECT event_id, to_json({event_id: event_id, event_type: event_type, props: props, user_id: user_id,
      value_cents: round(value * 100)::BIGINT})::VARCHAR || chr(10) AS line FROM events) SELECT event_id, line, sha256(line) AS digest FROM l""",
    "invariant_violations": """SELECT l_orderkey, l_linenumber, error_code FROM (SELECT l_orderkey, l_linenumber, unnest([
      CASE WHEN NOT coalesce(l_quantity > 0, false) THEN 'quantity-not-positive' END,
      CASE WHEN NOT coalesce(l_discount BETWEEN 0 AND 0.08::DOUBLE, false) THEN 'discount-out-of-range' END,
      CASE WHEN NOT coalesce(l_returnflag IN ('A', 'N', 'R'), false) THEN 'unknown-flag' END,
      CASE WHEN NOT coalesce(l_extendedprice >= l_quantity * 100, false) THEN 'price-below-quantity' END]) AS error_code FROM lineitem)
      WHERE error_code IS NOT NULL""",
    "set_difference": """WITH c AS (SELECT DISTINCT c_nationkey AS nation FROM customer),
      s AS (SELECT DISTINCT s_nationkey AS nation FROM supplier)
      SELECT nation, 'missing' AS state FROM c WHERE nation NOT IN (SELECT nation FROM s)
      UNION ALL SELECT nation, 'unmanifested' FROM s WHERE nation NOT IN (SELECT nation FROM c)""",
    "limit_violations": """SELECT l_orderkey, error_code FROM (SELECT l_orderkey, unnest([CASE WHEN n > 6 THEN 'too-many-lines' END, CASE WHEN q > 150 THEN 'too-much-quantity' END,
      CASE WHEN s > 6 THEN 'too-many-suppliers' END]) AS error_code FROM (SELECT l_orderkey, count(*) AS n, sum(round(l_quantity)::BIGINT) AS q, count(DISTINCT l_suppkey) AS s
      FROM lineitem GROUP BY 1)) WHERE error_code IS NOT NULL""",
    "total_join": "SELECT o_custkey, o_orderkey, c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey",
    "same_ids": """WITH t AS (SELECT DISTINCT conv_id, turn, role FROM conversations), e AS (SELECT DISTINCT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END AS role FROM t)
      SELECT t.conv_id, count(*) AS n_differ, min(t.turn) AS first_place FROM t JOIN e ON e.conv_id = t.conv_id AND e.turn = t.turn WHERE t.role <> e.role GROUP BY 1""",
}

_AUDIT = {
    "order-total": SQL["totals_check"],
    "duplicate-line": SQL["unique_key_violations"],
    "line-numbers": f"SELECT * FROM ({SQL['split_contiguity']}) WHERE NOT contiguous",
    "reference": SQL["reference_anti"],
    "declared-size": f"SELECT * FROM ({SQL['manifest_size_audit']}) WHERE NOT agrees",
    "unlabelled": f"SELECT * FROM ({SQL['manifest_presence_audit']}) WHERE state <> 'present'",
    "ambiguous-winner": f"SELECT * FROM ({SQL['overlay_winner']}) WHERE rule = 'ambiguous'",
    "invariant": SQL["invariant_violations"],
}
SQL["full_audit"] = " UNION ALL ".join(f"SELECT '{name}' AS check_name, count(*) AS n_violations FROM ({sql})" for name, sql in _AUDIT.items())
