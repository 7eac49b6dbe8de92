"""Queries on event series, text evidence, urls and classification."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.paths import is_allowed_url, is_safe_path, redact_url, url_host
from ..operators import convert, evidence, integrity, monitor, planning
from ..sources.archives import BATCH_BYTES, in_batches
from ..sources.catalogs import list_messages, pack_catalog
from .runs import _EVENTS, _events
from .tables import table




def idle_gap(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user_id", "t", "cents")
    return monitor.idle_gaps(rows, key="user_id", time=F.col("t"), tie="event_id", amount=F.col("cents"))


def slow_window(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user_id", "t", "cents")
    totals = monitor.cumulative(rows, key="user_id", time=F.col("t"), tie="event_id", amount=F.col("cents"))
    return monitor.slow_windows(totals, key="user_id", time=F.col("t"), tie="event_id", total="total", seconds=86400, least_rate=0.5)


def slow_state_carry(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user_id", "t", "event_type")
    decided = F.when(F.col("event_type") == "error", True).when(F.col("event_type") == "purchase", False)
    return monitor.carry_state(rows, key="user_id", order=["t", "event_id"], state=decided)


def progress_steps(spark, sf_dir):
    fold = monitor.ProgressFold(step=10, seconds=86400, whole=1_000_000)
    rows = _events(spark, sf_dir).select("user_id", "t", "event_id", F.struct("t", F.col("cents").cast("double").alias("amount")).alias("sample"))
    found = integrity.fold_ordered(rows, "user_id", ["t", "event_id"], "sample", fold.start, fold.take, fold.finish, "long")
    return found.withColumnRenamed("result", "n_reports")


def islands(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user_id", "t", "event_type")
    return monitor.islands(rows, key="user_id", time=F.col("t"), tie="event_id", kind="event_type", most_gap=6 * 3600)


def lookahead(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user_id", "t", "event_type")
    return monitor.look_ahead(rows, key="user_id", order=["t", "event_id"], wanted=F.col("event_type") == "error", steps=6)


def rebase_epochs(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user_id", "t", "event_type", "cents")
    cut = monitor.epochs(rows, key="user_id", order=["t", "event_id"], discard=F.col("event_type") == "signup")
    return cut.groupBy("user_id", "epoch").agg(F.count("*").alias("n_rows"), F.sum("cents").alias("cents"))


def nearest_match(spark, sf_dir):
    rows = _events(spark, sf_dir)
    anchors, points = rows.where("event_type = 'purchase'"), rows.where("event_type = 'click'")
    return evidence.nearest_after(anchors, points, key="user_id", time="t", anchor_id="event_id", point_id="event_id", before=12 * 3600, after=86400)


def as_of_containing(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "user_id", "t", "event_type")
    kind = F.col("event_type")
    return evidence.as_of(
        rows, key="user_id", order=["t", "event_id"], is_anchor=kind == "purchase", is_point=kind == "click", value=F.col("event_id"), time="t", within=2 * 86400
    )


def min_by_dedupe(spark, sf_dir):
    rows = _events(spark, sf_dir).select("user_id", "event_type", "t", "event_id", "cents")
    return integrity.keep_first(rows, ["user_id", "event_type"], "event_id")


def unambiguous_values(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return evidence.unambiguous(parts, keys=["p_brand", "p_size"], value=["p_type"], pick="p_partkey")


def usage_index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return evidence.word_usage(docs, keys=["lang"], text="text", pattern="([a-z]+)[.]")


ANY_LENGTH = (1 << 63) - 1


def overload_score(spark, sf_dir):
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").cast("long").alias("n"))
    shapes = spark.createDataFrame(
        [("short-user", "user", 0, 80), ("long-user", "user", 81, ANY_LENGTH), ("short-any", None, 0, 40), ("reply", "assistant", 0, ANY_LENGTH), ("any", None, 0, ANY_LENGTH)],
        "shape string, s_role string, low long, high long",
    )
    near = talks.join(F.broadcast(shapes), F.col("n").between(F.col("low"), F.col("high")))  # five shapes, whatever the rows
    score = F.when(F.col("s_role").isNull(), 1).when(F.col("s_role") == F.col("role"), 3).otherwise(-3)
    scored = near.select("conv_id", "turn", "role", "n", "shape", score.alias("score"))
    return evidence.best_scores(scored, key=["conv_id", "turn", "role", "n"], score="score")


def classify(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    bare = F.regexp_extract("url", "^([^?#]*)", 1)
    path = F.regexp_extract(bare, "://[^/]*(/.*)$", 1)
    return pages.select("page_id", convert.classify_text(path, F.coalesce("html", F.lit("")), {".html": "page", ".json": "data"}).alias("kind"), F.col("url").contains("?").alias("has_query"))


def url_policy(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    up = planning.upgrade_proven_hosts(pages, url="url", host=url_host(F.col("url")))
    return up.select(
        "page_id", "resolved", url_host(F.col("url")).alias("host"), redact_url(F.regexp_replace("url", "ref=", "token=")).alias("redacted"), is_allowed_url(F.col("url"), allow_http=False).alias("allowed")
    )


def safe_paths(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    relative = F.regexp_extract("url", "://[^/]*/([^?#]*)", 1)
    twisted = F.when(F.col("page_id") % 7 == 0, F.concat(relative, F.lit("/../x"))).when(F.col("page_id") % 11 == 0, F.concat(F.lit("a//"), relative)).otherwise(relative)
    return pages.select("page_id", twisted.alias("path"), is_safe_path(twisted).alias("safe"))


def converter_roundtrip(spark, sf_dir):
    """Documents packed into message catalogs, read back, and held against the originals."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, packed, size = [], [], 0
            last = batch.num_rows - 1
            for i, (k, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                paths.append(str(k))
                packed.append(pack_catalog({"": "Content-Type: text/plain; charset=UTF-8", f"document {k}": t.as_py() or ""}))
                size += len(packed[-1])
                if i == last or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pydict({"path": paths, "content": packed})
                    paths, packed, size = [], [], 0

    files = in_batches(docs).mapInArrow(pack, "path string, content binary")
    back = list_messages(files).where("message_id <> ''").select(F.col("path").cast("long").alias("doc_id"), F.element_at("texts", 1).alias("read"))
    return docs.join(back, "doc_id").select("doc_id", (F.col("text") == F.col("read")).alias("agrees"))


QUERIES = {
    f.__name__: f
    for f in (
        idle_gap, slow_window, slow_state_carry, progress_steps, islands, lookahead, rebase_epochs, nearest_match, as_of_containing, min_by_dedupe,
        unambiguous_values, usage_index, overload_score, classify, url_policy, safe_paths, converter_roundtrip,
    )
}

_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"
_W = "PARTITION BY user_id ORDER BY t, event_id"

SQL = {
    "converter_roundtrip": "SELECT doc_id, true AS agrees FROM documents",
    "idle_gap": f"""WITH {_EVENTS}, b AS (SELECT event_id, user_id, t, cents, coalesce(cents > max(cents) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS rises FROM e)
      SELECT *, t - max(CASE WHEN rises THEN t END) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS idle_seconds FROM b""",
    "slow_window": f"""WITH {_EVENTS}, c AS (SELECT event_id, user_id, t, cents, sum(cents) OVER ({_W} ROWS UNBOUNDED PRECEDING)::BIGINT AS total FROM e),
      j AS (SELECT c.event_id, max((o.t, o.event_id, o.total)) AS b FROM c JOIN c o ON o.user_id = c.user_id AND o.t <= c.t - 86400 GROUP BY 1),
      s AS (SELECT c.*, b[3] AS base_total, (total - b[3]) / (t - b[1]) AS v FROM c LEFT JOIN j USING (event_id))
      SELECT event_id, user_id, t, cents, total, base_total, round(v, 6) AS speed, round(v, 6) < 0.5 AS slow,
      coalesce(round(v, 6) < 0.5 AND NOT coalesce(lag(round(v, 6) < 0.5) OVER ({_W}), false), false) AS begins FROM s""",
    "slow_state_carry": f"""WITH {_EVENTS}, d AS (SELECT event_id, user_id, t, event_type, CASE WHEN event_type = 'error' THEN true WHEN event_type = 'purchase' THEN false END AS s FROM e)
      SELECT event_id, user_id, t, event_type, coalesce(last_value(s IGNORE NULLS) OVER ({_W} ROWS UNBOUNDED PRECEDING), false) AS state FROM d""",
    "progress_steps": f"""WITH RECURSIVE {_EVENTS}, r AS (SELECT user_id, t, cents::DOUBLE AS amount, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS i FROM e),
      s AS (SELECT user_id, i, amount AS done, floor(100 * amount / 1000000)::BIGINT // 10 AS level, t AS last, 1::BIGINT AS reports FROM r WHERE i = 1
        UNION ALL SELECT user_id, i, done, CASE WHEN due THEN now_level ELSE level END, CASE WHEN due THEN t ELSE last END, reports + CASE WHEN due THEN 1 ELSE 0 END
        FROM (SELECT r.user_id, r.i, r.t, s.done + amount AS done, level, last, reports, floor(100 * (s.done + amount) / 1000000)::BIGINT // 10 AS now_level,
          floor(100 * (s.done + amount) / 1000000)::BIGINT // 10 > level OR r.t - last >= 86400 AS due FROM s JOIN r ON r.user_id = s.user_id AND r.i = s.i + 1))
      SELECT user_id, max(i) AS n_rows, arg_max(reports, i) AS n_reports FROM s GROUP BY 1""",
    "islands": f"""WITH {_EVENTS}, n AS (SELECT user_id, event_id, t, event_type, CASE WHEN coalesce(lag(event_type) OVER ({_W}) <> event_type OR t - lag(t) OVER ({_W}) > 21600, true) THEN 1 ELSE 0 END AS new FROM e),
      i AS (SELECT *, sum(new) OVER ({_W} ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM n)
      SELECT user_id, island, min(event_type) AS event_type, count(*) AS n_rows, min(t) AS first_second, max(t) AS last_second FROM i GROUP BY 1, 2 HAVING count(*) >= 2""",
    "lookahead": f"""WITH {_EVENTS} SELECT event_id, user_id, t, event_type,
      coalesce(bool_or(event_type = 'error') OVER ({_W} ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING), false) AS ahead FROM e""",
    "rebase_epochs": f"""WITH {_EVENTS}, p AS (SELECT user_id, cents, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER ({_W} ROWS UNBOUNDED PRECEDING)::BIGINT AS epoch FROM e)
      SELECT user_id, epoch, count(*) AS n_rows, sum(cents)::BIGINT AS cents FROM p GROUP BY 1, 2""",
    "nearest_match": f"""WITH {_EVENTS}, a AS (SELECT user_id, event_id, t, lead(t) OVER ({_W}) AS nxt FROM e WHERE event_type = 'purchase'),
      j AS (SELECT a.user_id, a.event_id AS anchor, c.event_id AS point, abs(c.t - a.t) AS distance FROM a JOIN e c ON c.user_id = a.user_id AND c.event_type = 'click'
      AND c.t >= a.t - 43200 AND c.t < least(coalesce(nxt, a.t + 86400), a.t + 86400))
      SELECT user_id, anchor, point, distance FROM j QUALIFY distance = min(distance) OVER (PARTITION BY anchor)""",
    "as_of_containing": f"""WITH {_EVENTS}, w AS (SELECT event_id, user_id, t, event_type,
      last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER p AS m, last_value(CASE WHEN event_type = 'click' THEN t END IGNORE NULLS) OVER p AS mt
      FROM e WINDOW p AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
      SELECT event_id, user_id, t, event_type, CASE WHEN t - mt <= 172800 THEN m END AS matched, CASE WHEN t - mt <= 172800 THEN t - mt END AS age FROM w WHERE event_type = 'purchase'""",
    "min_by_dedupe": f"""WITH {_EVENTS} SELECT user_id, event_type, t, event_id, cents FROM e QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""",
    "unambiguous_values": """SELECT p_brand, p_size, min(p_type) AS p_type, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_type) = 1""",
    "usage_index": """SELECT lang, word, count(*) AS n_uses FROM (SELECT lang, unnest(regexp_extract_all(text, '([a-z]+)[.]', 1)) AS word FROM documents) GROUP BY 1, 2""",
    "overload_score": """WITH s(shape, s_role, low, high) AS (VALUES ('short-user', 'user', 0, 80), ('long-user', 'user', 81, 9223372036854775807), ('short-any', NULL, 0, 40),
      ('reply', 'assistant', 0, 9223372036854775807), ('any', NULL, 0, 9223372036854775807)),
      j AS (SELECT DISTINCT conv_id, turn, role, length(text)::BIGINT AS n, shape, CASE WHEN s_role IS NULL THEN 1 WHEN s_role = role THEN 3 ELSE -3 END AS score
      FROM conversations JOIN s ON length(text) BETWEEN low AND high)
      SELECT * FROM j QUALIFY score = max(score) OVER (PARTITION BY conv_id, turn, role, n)""",
    "classify": """WITH p AS (SELECT page_id, url, ltrim(coalesce(html, '')) AS h, regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '://[^/]*(/.*)$', 1) AS path FROM pages)
      SELECT page_id, CASE WHEN lower(path) LIKE '%.json' THEN 'data' WHEN lower(path) LIKE '%.html' THEN 'page' WHEN trim(h) = '' THEN 'empty' WHEN starts_with(h, '<') THEN 'markup'
      WHEN regexp_matches(h, '^[\\[{]') THEN 'json' ELSE 'text' END AS kind, contains(url, '?') AS has_query FROM p""",
    "url_policy": f"""WITH h AS (SELECT page_id, url, {_HOST} AS host FROM pages), s AS (SELECT DISTINCT host FROM h WHERE starts_with(url, 'https://'))
      SELECT page_id, CASE WHEN starts_with(url, 'http://') AND s.host IS NOT NULL THEN 'https://' || substr(url, 8) ELSE url END AS resolved, h.host,
      regexp_replace(regexp_replace(url, '([?&])ref=[^&#]*', '\\1token=REDACTED', 'g'), '://[^/?#]*@', '://') AS redacted,
      starts_with(url, 'https://') AND h.host <> '' AND NOT contains(url, '#') AS allowed FROM h LEFT JOIN s ON s.host = h.host""",
    "safe_paths": """WITH r AS (SELECT page_id, regexp_extract(url, '://[^/]*/([^?#]*)', 1) AS x FROM pages),
      p AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN x || '/../x' WHEN page_id % 11 = 0 THEN 'a//' || x ELSE x END AS path FROM r)
      SELECT page_id, path, length(path) > 0 AND NOT contains(path, '\\') AND len(list_filter(string_split(path, '/'), lambda s: s IN ('', '.', '..'))) = 0 AS safe FROM p""",
}
