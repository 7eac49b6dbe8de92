"""Queries on calls, imports, overloads, states of stages and closures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import canon, paths
from ..operators import convert, digest_tree, evidence, graph, stages
from .runs import _EVENTS, _events
from .tables import table


def call_usage(spark, sf_dir):
    """Calls in source lines made of order lines, with brackets of all kinds and strings that hold some."""
    lines = table(spark, sf_dir, "lineitem")
    n, q = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("long").cast("string")
    last = F.when(F.col("l_discount") > 0.05, "None").otherwise("True")
    text = F.concat(
        F.lit("make_"), F.lower("l_returnflag"), F.lit("(\""), F.col("l_linestatus"), F.lit(", (x\", ["), q, F.lit(", 2], {'k': "), n, F.lit("}, size="), q, F.lit(", inner("), n, F.lit(", "), last, F.lit("))  # end(1, 2)"),
    )
    return evidence.call_shapes(lines.select("l_returnflag", text.alias("text")), keys=["l_returnflag"], text="text")


def import_usage(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    brand, kind, size = F.replace("p_brand", F.lit("#"), F.lit("_")), F.substring_index("p_type", " ", 1), F.col("p_size").cast("string")
    text = F.concat(F.lit("import "), brand, F.lit(".sub as m\nfrom pkg_"), size, F.lit(".x import load as l, save\nfrom . import other\nm."), kind, F.lit("("), size, F.lit(")\nm.width\nl (1)\nother.run()\n"))
    return evidence.import_usage(parts.select("p_partkey", text.alias("text")), keys=["p_partkey"], text="text")


_KINDS = ("int", "float", "str", "Any")


def _kinds(count, code):
    each = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.element_at(F.array(*map(F.lit, _KINDS)), (code(i) % 4 + 1).cast("int")))
    return F.when(count > 0, each).otherwise(F.array().cast("array<string>"))


def overload_choice(spark, sf_dir):
    """Signatures of brands that calls of their names speak for."""
    parts = table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size").cast("long")
    signatures = parts.select("p_brand", F.substring_index("p_type", " ", 1).alias("result"), _kinds(size % 5, lambda i: key * i + i).alias("params"))
    calls = parts.select("p_brand", _kinds(key % 4, lambda i: size + i * i).alias("kinds"))
    found = evidence.choose_overloads(signatures, calls, name="p_brand", params="params", result="result", kinds="kinds")
    return found.withColumn("params", F.array_join("params", ","))


def stage_faults(spark, sf_dir):
    """Events as stages, with fields that do not always fit their state."""
    e = _events(spark, sf_dir)
    state = F.element_at(F.create_map(*map(F.lit, ("click", "pending", "view", "running", "purchase", "succeeded", "error", "failed", "signup", "interrupted"))), F.col("event_type"))
    fields = {
        "attempt": F.col("cents") % 3, "input_digest": F.when(F.col("user_id") % 5 != 0, "d"), "started_at": F.when(F.col("cents") % 7 != 0, F.col("t")),
        "finished_at": F.when(F.col("cents") % 2 == 0, F.col("t")), "result_digest": F.when(F.col("cents") % 4 < 2, "r"), "error": F.when(F.col("user_id") % 3 == 0, "e"),
    }
    return stages.state_violations(e.select("event_id", state.alias("state"), *(c.alias(k) for k, c in fields.items())), ["event_id"])


def chain_states(spark, sf_dir):
    """Orders' lines as chains of versions: lists of whole states, branches, cycles and gaps."""
    lines = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    source = F.when((F.col("l_linestatus") == "O") | (n == 1), None).otherwise((n - 1).cast("string"))
    edges = lines.select("l_orderkey", source.alias("source"), F.when(n % 4 == 0, F.lit("1")).otherwise(n.cast("string")).alias("target"))
    return graph.chain_errors(edges, key="l_orderkey", source="source", target="target", start="0", ordered=True)


def reachable(spark, sf_dir):
    """What each supplier leads to, by rounds over new pairs."""
    edges = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("a"), (F.col("s_nationkey") * 2).cast("long").alias("b")).distinct()

    def step(new):
        return new.alias("n").join(edges.alias("e"), F.col("n.b") == F.col("e.a")).select(F.col("n.a").alias("a"), F.col("e.b").alias("b"))

    return stages.closure(edges, step, most=1000)[0]


def archive_names(spark, sf_dir):
    """Pages' paths as names in archives: whether they are safe, where they lie, what they bundle, and what their bytes are."""
    pages = table(spark, sf_dir, "pages")
    key = F.col("page_id")
    path = F.regexp_extract("url", "://[^/]*/([^?#]*)", 1)
    name = F.when(key % 5 == 0, F.concat(F.lit("C:"), path)).when(key % 7 == 0, F.concat(path, F.lit("\t"))).when(key % 11 == 0, F.concat(F.lit("x/mods/"), path)).otherwise(path)
    stem = F.concat(F.lit("lib/lib-"), key.cast("string"), F.when(key % 2 == 0, "-1.2-SNAPSHOT.swc").otherwise("-0.9.swc"))
    head = F.when(key % 3 == 0, F.unhex(F.lit("504B0304"))).when(key % 4 == 0, F.unhex(F.lit("377ABCAF271C00"))).otherwise(F.encode(F.coalesce("html", F.lit("")), "UTF-8"))
    source = F.concat(F.lit("# made by a tool\n# twice\nx = "), key.cast("string"), F.when(key % 2 == 0, "\nreturn\n# end\n").when(key % 3 == 0, "\n# Unsupported opcode: 9\n").otherwise("\n"))
    return pages.select(
        "page_id", name.alias("name"), paths.is_safe_archive_name(name).alias("safe"), paths.in_folders(name, ("x", "mods")).alias("inside"), paths.bundle_name(stem).alias("bundle"),
        convert.container_kind(head).alias("container"), convert.has_failure_mark(source).alias("failed"), canon.crc32_hex(F.encode(stem, "UTF-8")).alias("crc32"),
    )


def manifest_changes(spark, sf_dir):
    """Orders against a later state of them, in which urgent ones are open and cheap ones are gone."""
    was = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.round("o_totalprice").cast("long").alias("price"))
    now = table(spark, sf_dir, "orders").where("o_totalprice >= 20000").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", "O").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.round("o_totalprice").cast("long").alias("price")
    )
    columns, buckets = ["o_orderstatus", "price"], digest_tree.tree_buckets(was.count())
    trees = tuple(digest_tree.digest_tree(t, key="o_orderkey", columns=columns, buckets=buckets) for t in (was, now))
    return digest_tree.differing_lines(was, now, trees, key="o_orderkey", columns=columns, buckets=buckets)


QUERIES = {f.__name__: f for f in (call_usage, import_usage, overload_choice, stage_faults, chain_states, reachable, archive_names, manifest_changes)}

_K = "['int', 'float', 'str', 'Any']"
_BITS = "flatten(list_transform(str_split(stem, ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]))::BIGINT[]"
_CRC = f"xor(list_reduce([4294967295::BIGINT] || {_BITS}, lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"

SQL = {
    "call_usage": """SELECT l_returnflag, 'make_' || lower(l_returnflag) AS name, 5::BIGINT AS arity, 'string,name,name,keyword,call' AS kinds, count(*) AS n_calls FROM lineitem GROUP BY 1
      UNION ALL SELECT l_returnflag, 'inner', 2, CASE WHEN l_discount > 0.05 THEN 'number,none' ELSE 'number,bool' END, count(*) FROM lineitem GROUP BY 1, 4""",
    "import_usage": """SELECT p_partkey, replace(p_brand, '#', '_') AS module, split_part(p_type, ' ', 1) AS member, true AS called FROM part
      UNION ALL SELECT p_partkey, replace(p_brand, '#', '_'), 'width', false FROM part UNION ALL SELECT p_partkey, 'pkg_' || p_size, 'load', true FROM part UNION ALL SELECT p_partkey, 'pkg_' || p_size, 'save', false FROM part""",
    "overload_choice": f"""WITH s AS (SELECT DISTINCT p_brand, split_part(p_type, ' ', 1) AS result, list_transform(range(1, p_size % 5 + 1), lambda i: {_K}[(p_partkey * i + i) % 4 + 1]) AS p FROM part),
      c0 AS (SELECT DISTINCT p_brand, list_transform(range(1, p_partkey % 4 + 1), lambda i: {_K}[(p_size + i * i) % 4 + 1]) AS k FROM part),
      c1 AS (SELECT *, len(list_filter(k, lambda x: x <> 'Any')) > 0 AS tells FROM c0), c AS (SELECT p_brand, k FROM c1 QUALIFY tells OR NOT bool_or(tells) OVER (PARTITION BY p_brand)),
      f AS (SELECT s.*, k, CASE WHEN len(p) = len(k) THEN 10 ELSE 0 END - (len(p) - len(k)) + coalesce(list_sum(list_transform(range(1, len(k) + 1), lambda i:
        CASE WHEN k[i] = 'Any' THEN CASE WHEN p[i] = 'Any' THEN 0 ELSE -1 END WHEN p[i] = 'Any' THEN 0 WHEN p[i] = k[i] OR (k[i] = 'int' AND p[i] = 'float') THEN 3 ELSE -4 END)), 0) AS v
        FROM s JOIN c ON c.p_brand = s.p_brand AND len(p) >= len(k)),
      b AS (SELECT DISTINCT p_brand, result, p FROM (SELECT * FROM f QUALIFY v = max(v) OVER (PARTITION BY p_brand, k))),
      l AS (SELECT p_brand, min(len(k)) AS least FROM c GROUP BY 1),
      x AS (SELECT s.*, EXISTS (SELECT 1 FROM b WHERE b.p_brand = s.p_brand AND b.result = s.result AND b.p = s.p) AS chosen, EXISTS (SELECT 1 FROM b WHERE b.p_brand = s.p_brand) AS heard,
        EXISTS (SELECT 1 FROM b WHERE b.p_brand = s.p_brand AND b.result = s.result AND len(b.p) <> len(s.p) AND b.p[:least(len(b.p), len(s.p))] = s.p[:least(len(b.p), len(s.p))]) AS near FROM s)
      SELECT p_brand, result, array_to_string(p, ',') AS params, chosen, CASE WHEN least < len(p) THEN least END::INTEGER AS required FROM x LEFT JOIN l USING (p_brand) WHERE chosen OR near OR NOT heard""",
    "stage_faults": f"""WITH {_EVENTS}, s AS (SELECT event_id, event_type AS y, cents % 3 AS a, user_id % 5 <> 0 AS d, cents % 7 <> 0 AS b, cents % 2 = 0 AS f, cents % 4 < 2 AS r, user_id % 3 = 0 AS x FROM e),
      n AS (SELECT *, CASE y WHEN 'click' THEN 'pending' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'succeeded' WHEN 'error' THEN 'failed' ELSE 'interrupted' END AS st FROM s)
      SELECT event_id, error_code FROM (SELECT event_id, unnest([
        CASE WHEN y = 'click' AND a <> 0 THEN 'pending-with-attempt' END, CASE WHEN y <> 'click' AND a < 1 THEN 'without-attempt' END,
        CASE WHEN d = (y = 'click') THEN st || CASE WHEN d THEN '-with-' ELSE '-without-' END || 'input_digest' END,
        CASE WHEN b = (y = 'click') THEN st || CASE WHEN b THEN '-with-' ELSE '-without-' END || 'started_at' END,
        CASE WHEN f = (y IN ('click', 'view')) THEN st || CASE WHEN f THEN '-with-' ELSE '-without-' END || 'finished_at' END,
        CASE WHEN r = (y <> 'purchase') THEN st || CASE WHEN r THEN '-with-' ELSE '-without-' END || 'result_digest' END,
        CASE WHEN x = (y IN ('click', 'view', 'purchase')) THEN st || CASE WHEN x THEN '-with-' ELSE '-without-' END || 'error' END]) AS error_code FROM n) WHERE error_code IS NOT NULL""",
    "chain_states": """WITH RECURSIVE g AS (SELECT l_orderkey::VARCHAR AS k, CASE WHEN l_linestatus <> 'O' AND l_linenumber <> 1 THEN (l_linenumber - 1)::VARCHAR END AS given,
        CASE WHEN l_linenumber % 4 = 0 THEN '1' ELSE l_linenumber::VARCHAR END AS target FROM lineitem),
      lists AS (SELECT k FROM g GROUP BY 1 HAVING count(*) > 1 AND count(given) = 0), c AS (SELECT k, coalesce(given, '0') AS source, target FROM g WHERE k NOT IN (SELECT k FROM lists)),
      m AS (SELECT k, source, min(target) AS target FROM c GROUP BY 1, 2),
      r AS (SELECT k, source, target, ['0'] AS seen FROM m WHERE source = '0'
        UNION ALL SELECT m.k, m.source, m.target, list_append(r.seen, m.source) FROM r JOIN m ON m.k = r.k AND m.source = r.target WHERE NOT list_contains(r.seen, r.target)),
      b AS (SELECT DISTINCT k FROM (SELECT k, source FROM c GROUP BY 1, 2 HAVING count(*) > 1))
      SELECT k AS l_orderkey, 'duplicate-target' AS error_code FROM (SELECT DISTINCT k FROM (SELECT k, target FROM g WHERE k IN (SELECT k FROM lists) GROUP BY 1, 2 HAVING count(*) > 1))
      UNION ALL SELECT k, 'branch' FROM b UNION ALL SELECT k, 'no-start' FROM c GROUP BY 1 HAVING count(*) FILTER (source = '0') = 0
      UNION ALL SELECT DISTINCT k, 'cycle' FROM r WHERE list_contains(seen, target)
      UNION ALL SELECT DISTINCT c.k, 'disconnected' FROM c WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.k = c.k AND r.source = c.source) AND c.k NOT IN (SELECT k FROM b)""",
    "reachable": """WITH RECURSIVE e AS (SELECT DISTINCT s_suppkey AS a, (s_nationkey * 2)::BIGINT AS b FROM supplier), r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b) SELECT a, b FROM r""",
    "archive_names": f"""WITH p AS (SELECT page_id, html, regexp_extract(url, '://[^/]*/([^?#]*)', 1) AS x FROM pages),
      n AS (SELECT page_id, html, CASE WHEN page_id % 5 = 0 THEN 'C:' || x WHEN page_id % 7 = 0 THEN x || chr(9) WHEN page_id % 11 = 0 THEN 'x/mods/' || x ELSE x END AS name,
        'lib/lib-' || page_id || CASE WHEN page_id % 2 = 0 THEN '-1.2-SNAPSHOT.swc' ELSE '-0.9.swc' END AS stem FROM p), b AS (SELECT *, string_split(regexp_replace(name, '/$', ''), '/') AS parts, string_split(name, '/') AS whole FROM n)
      SELECT page_id, name, name NOT IN ('', '/') AND NOT contains(name, '\\') AND len(list_filter(parts, lambda s: s IN ('', '.', '..'))) = 0 AND page_id % 5 <> 0 AND NOT contains(name, chr(9)) AS safe,
        len(whole) > 2 AND whole[-3] = 'x' AND whole[-2] = 'mods' AS inside, 'lib-' || page_id || CASE WHEN page_id % 2 = 0 THEN '' ELSE '-0.9' END AS bundle,
        CASE WHEN page_id % 3 = 0 THEN 'zip' WHEN page_id % 4 = 0 THEN 'seven-zip' ELSE 'unknown' END AS container, page_id % 2 <> 0 AND page_id % 3 = 0 AS failed, printf('%08X', {_CRC}) AS crc32 FROM b""",
    "manifest_changes": """SELECT o_orderkey, CASE WHEN o_totalprice < 20000 THEN 'missing' ELSE 'changed' END AS state FROM orders WHERE o_totalprice < 20000 OR (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'O')""",
}
