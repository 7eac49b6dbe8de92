"""Operators on small tables with exact expected values."""

import hashlib

import pytest
from pyspark.sql import functions as F

from stratalith.functions import canon, formats, paths
from stratalith.operators import convert, evidence, graph, history, integrity, monitor, overlay, planning, stages, stats


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def layered(spark):
    data = [
        ("base", "same.txt", 0, "a.pkg"), ("base", "case.txt", 0, "a.pkg"), ("base", "only.bin", 0, "a.pkg"),
        ("base", "same.txt", 1, "b.pkg"), ("base", "case.txt", 1, "b.pkg"), ("base", "same.txt", 9, "loose"),
        ("base", "loose.txt", 9, "loose"), ("base", "loose.txt", 10, "loose2"), ("EN", "only.bin", 0, "en.pkg"), ("EN", "twice", 0, "p"), ("EN", "twice", 0, "q"),
    ]
    return spark.createDataFrame(data, "layer string, key string, precedence int, path string")


def test_first_listed_wins(spark):
    found = overlay.resolve_first_wins(layered(spark), keys=["layer", "key"], precedence="precedence", tie="path", fallback_from=9)
    assert rows(found, "layer", "key", "winner", "n_candidates", "rule") == sorted(
        [
            ("base", "same.txt", "a.pkg", 3, "first-listed"), ("base", "case.txt", "a.pkg", 2, "first-listed"), ("base", "only.bin", "a.pkg", 1, "only-candidate"),
            ("base", "loose.txt", "loose", 2, "loose-fallback"), ("EN", "only.bin", "en.pkg", 1, "only-candidate"), ("EN", "twice", "p", 2, "ambiguous"),
        ], key=str,
    )
    with pytest.raises(Exception, match="ambiguous winner"):
        overlay.require_unambiguous(found).collect()
    assert overlay.require_unambiguous(found.where("key <> 'twice'")).count() == 5
    assert overlay.conflicting_candidates(layered(spark), found, keys=["layer", "key"], tie="path").where("won").count() == 4


def test_overlay_replaces_by_null_safe_key(spark):
    base = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "path string, part string, v int")
    over = spark.createDataFrame([("a", None, 9), ("c", None, 3)], "path string, part string, v int")
    assert rows(overlay.overlay(base, over, keys=["path", "part"], value="v"), "path", "v", "layer") == [("a", 9, 1), ("b", 2, 0), ("c", 3, 1)]


def test_presence_and_references(spark):
    a, b = (spark.createDataFrame([(x,) for x in v], "k int") for v in ((1, 2, None), (2, 3)))
    assert rows(integrity.presence(a, b, ["k"]), "k", "state") == sorted([(1, "missing"), (2, "present"), (3, "unmanifested"), (None, "missing")], key=str)
    assert rows(integrity.missing_references(a, "k", b, "k"), "reference", "n_rows") == [(1, 1)]
    assert rows(integrity.set_difference(a, b, "k"), "k") == sorted([(1,), (3,), (None,)], key=str)


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_order_violations_cross_ranges(spark, width):
    data = [(1, 5), (2, 6), (4, 6), (7, 1), (8, 2), (100, 2)]
    found = integrity.lag_over_all(spark.createDataFrame(data, "n long, k int"), "n", ["k"], width=width)
    assert rows(found.where("previous_k IS NOT NULL AND k <= previous_k"), "n") == [(100,), (4,), (7,)]
    assert rows(found.where("previous_k IS NULL"), "n") == [(1,)]


def test_folds_hold_order(spark):
    data = [("a", 2, "y"), ("a", 1, "x"), ("a", 3, None), ("b", 1, "z")]
    talks = spark.createDataFrame(data, "k string, i int, t string").repartition(3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert rows(integrity.joined_digest(talks, "k", ["i"], "t"), "k", "n_rows", "digest") == [("a", 3, sha("xy")), ("b", 1, sha("z"))]
    chain = dict(rows(integrity.digest_chain(talks, "k", ["i"], "t"), "k", "digest"))
    assert chain["a"] == sha(sha(sha("x") + "y"))
    assert integrity.joined_digest(talks.where("k = 'none'"), "k", ["i"], "t").collect() == []


def test_violations_are_rows(spark):
    data = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    found = integrity.violations(data, ["id"], {"negative": F.col("v") >= 0, "small": F.col("v") > 1})
    assert rows(found, "id", "error_code") == [(2, "negative"), (2, "small"), (3, "negative"), (3, "small")]
    with pytest.raises(ValueError, match="check"):
        integrity.strict(found, "check")
    integrity.strict(found.where("false"), "check")


def test_contiguity_and_totals(spark):
    parts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 0), ("b", 1), ("c", 1), ("c", 1)], "g string, i int")
    assert rows(integrity.contiguity(parts, ["g"], "i"), "g", "contiguous") == [("a", True), ("b", False), ("c", False)]
    declared = spark.createDataFrame([("a", 3), ("b", 1), ("z", 4)], "g string, total long")
    assert rows(integrity.totals_differ(declared, parts, ["g"], "total", "i"), "g", "difference") == [("z", -4)]


def test_download_statistics(spark):
    data = spark.createDataFrame([("x", 100, False, 20), ("x", 200, True, 0)], "k string, size long, reused boolean, resumed long")
    got = stats.transfer_stats(data, keys=["k"], size="size", reused=F.col("reused"), resumed=F.col("resumed"), seconds=F.max(F.lit(10))).first()
    assert (got.n_items, got.n_reused, got.reused_bytes, got.resumed_bytes, got.network_bytes, got.network_rate) == (2, 1, 200, 20, 80, 8.0)


def test_roll_up(spark):
    data = [("r", 1, "ok"), ("r", 2, "failed"), ("r", 3, "ok"), ("s", 1, "ok")]
    found = stats.roll_up_runs(spark.createDataFrame(data, "run string, i int, state string"), run="run", order="i", state="state", done=F.col("state") == "ok")
    assert rows(found, "run", "completed", "n_stages", "current_state") == [("r", 1, 3, "failed"), ("s", 1, 1, "succeeded")]


def test_usage_percent(spark):
    data = [("h", 0.0, 100, 1000), ("h", 10.0, 150, 1100)]
    found = stats.usage_percent(spark.createDataFrame(data, "host string, t double, busy long, total long"), keys=["host"], order="t", busy="busy", total="total")
    assert rows(found, "percent") == [(50.0,)]


@pytest.mark.parametrize(
    ("age", "wait"), [(0, 12 * 3600), (3 * 86400 - 1, 12 * 3600), (3 * 86400, 86400), (10 * 86400 - 1, 86400), (10 * 86400, 7 * 86400), (100 * 86400, 7 * 86400)]
)
def test_retry_waits(spark, age, wait):
    due = spark.range(1).select(history.next_retry(F.lit(1000), F.lit(1000 + age)).alias("due")).first().due
    assert due == 1000 + age + wait
    blocked = lambda now, release: spark.range(1).select(history.is_blocked(F.lit(now), F.lit(due), F.lit(release), F.lit("r1")).alias("b")).first().b
    assert blocked(due - 1, "r1") and not blocked(due, "r1") and not blocked(due - 1, "r2")


def test_ledger(spark):
    data = [
        (1, "s", 100, False), (1, "s", 100, False), (2, "s", 59, False), (3, "s", 0, False), (4, "t", 50, True), (5, "u", 30, False), (6, "u", 40, True),
    ]
    ledger = spark.createDataFrame(data, "id int, service string, cents long, refund boolean")
    found = history.ledger_cost(ledger, keys=["service"], identity=["id"], cents=F.col("cents"), refund=F.col("refund"))
    assert rows(found, "service", "cost_cents") == [("s", 159), ("t", None), ("u", None)]
    bad = spark.createDataFrame([(1, 5), (1, 6), (2, 5), (2, 5)], "id int, cents long")
    assert rows(history.conflicting_postings(bad, key="id", content=["cents"]), "id") == [(1,)]


def test_outcomes_and_cycles(spark):
    data = [("a", 1, "ok"), ("a", 2, "bad"), ("a", 3, "bad"), ("b", 1, "bad"), ("b", 2, "ok"), ("c", 1, "off")]
    runs = spark.createDataFrame(data, "k string, t long, s string")
    s = F.col("s")
    assert rows(history.outcome(runs, keys=["k"], failed=s == "bad", cancelled=s == "off", succeeded=s == "ok"), "k", "result") == [("a", "failure"), ("b", "failure"), ("c", "cancelled")]
    assert rows(history.retry_cycles(runs, target="k", time="t", success=s == "ok", failure=s == "bad"), "k", "first_failed", "last_failed", "n_failures") == [("a", 2, 3, 2)]
    assert rows(history.since_last(runs, key="k", order=["t"], mark=s == "ok"), "k", "t", "cycle") == [("a", 1, 1), ("a", 2, 1), ("a", 3, 1), ("b", 1, 0), ("b", 2, 1), ("c", 1, 0)]


def test_chain_walk(spark):
    data = [
        ("fine", "950", "990"), ("fine", None, "950"), ("branch", "0", "1"), ("branch", "0", "2"), ("loop", "0", "1"), ("loop", "1", "0"),
        ("late", "5", "6"), ("apart", "0", "1"), ("apart", "8", "9"),
    ]
    edges = spark.createDataFrame(data, "part string, src string, dst string")
    walked = graph.walk_chain(edges, key="part", source="src", target="dst", start="0")
    assert rows(walked.where("part = 'fine'"), "hop", "dst") == [(1, "950"), (2, "990")]
    errors = graph.chain_errors(edges, key="part", source="src", target="dst", start="0")
    assert rows(errors, "part", "error_code") == sorted(
        [("branch", "branch"), ("loop", "cycle"), ("late", "no-start"), ("late", "disconnected"), ("apart", "disconnected")], key=str
    )


def test_redirects(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), *[(f"h{i}", f"h{i + 1}") for i in range(12)]], "src string, dst string")
    found = {r.src: (r.final, r.hops, r.state) for r in graph.follow_redirects(edges, source="src", target="dst").collect()}
    assert found["a"] == ("c", 2, "ok") and found["b"] == ("c", 1, "ok")
    assert found["x"][2] == "cycle" and found["h0"][2] == "too-many-hops" and found["h9"] == ("h12", 3, "ok")


def test_balanced_batches(spark):
    dealt = planning.balance_histogram({10: 3, 7: 2, 1: 100}, 4)
    loads = [sum(size * n[b] for size, n in dealt.items()) for b in range(4)]
    assert sum(loads) == 144 and max(loads) - min(loads) <= 1
    items = spark.range(200).selectExpr("id", "1 + (id * id) % 37 AS size")
    found = planning.balance_batches(items, item="id", size="size", bins=5)
    loads = [r.s for r in found.groupBy("batch").agg(F.sum("size").alias("s")).collect()]
    assert found.count() == 200 and len(loads) == 5 and max(loads) - min(loads) <= 37


def test_resume(spark):
    fields = "id int, url string, etag string, modified string"
    was = spark.createDataFrame([(1, "u", "e", "m"), (2, "u", None, "m"), (3, "u", "e", "m"), (4, "u", None, None)], fields)
    now = spark.createDataFrame([(1, "u", "e", "n"), (2, "u", "e", "m"), (3, "v", "e", "m"), (4, "u", None, None), (5, "u", "e", None)], fields)
    found = planning.resume_decision(was, now, key="id", fields=["url"], validators=["etag", "modified"])
    assert rows(found, "id", "decision") == [(1, "resume"), (2, "resume"), (3, "restart"), (4, "restart"), (5, "restart")]


def test_slow_window_warns_once(spark):
    data = [("x", 60 * i, i, 2400) for i in range(1, 6)]
    own = spark.createDataFrame(data, "k string, t long, i long, amount long")
    totals = monitor.cumulative(own, key="k", time=F.col("t"), tie="i", amount=F.col("amount"))
    found = monitor.slow_windows(totals, key="k", time=F.col("t"), tie="i", total="total", seconds=120, least_rate=50.0)
    assert rows(found, "t", "speed", "begins") == sorted([(60, None, False), (120, None, False), (180, 40.0, True), (240, 40.0, False), (300, 40.0, False)], key=str)


def test_owners_and_families(spark):
    modules = spark.createDataFrame([("m1", ["a", "b"]), ("m2", ["c"]), ("m3", ["c", "d"])], "module string, attributes array<string>")
    names = spark.createDataFrame([("e1", ["a"]), ("e2", ["c"]), ("e3", ["zz"])], "name string, members array<string>")
    assert rows(evidence.owners(modules, names, module="module", attributes="attributes", name="name", wanted="members"), "name", "owner") == [("e1", "m1"), ("e2", None), ("e3", None)]
    signatures = spark.createDataFrame([("f", ["int"]), ("f", ["int", "str"]), ("f", ["str", "int"])], "name string, params array<string>")
    assert rows(evidence.expand_families(signatures, name="name", params="params"), "short", "longer") == [(["int"], ["int", "str"])]


def one(spark, value, schema, column):
    return spark.createDataFrame([(value,)], f"v {schema}").select(column(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    ("path", "safe"), [("a/b.txt", True), ("/a", False), ("a//b", False), ("a/../b", False), ("./a", False), ("a\\b", False), ("", False), (None, False), ("a/b\x00", False), ("é/ü", True)]
)
def test_safe_paths(spark, path, safe):
    assert one(spark, path, "string", paths.is_safe_path) is safe


@pytest.mark.parametrize(("name", "safe"), [("C:/x", False), ("a/\x07", False), ("folder/", True), ("a/b", True)])
def test_archive_names(spark, name, safe):
    assert one(spark, name, "string", paths.is_safe_archive_name) is safe


def test_urls(spark):
    assert one(spark, "https://u:p@h.example/x?token=1&a=2#f", "string", paths.redact_url) == "https://h.example/x?token=REDACTED&a=2#f"
    allowed = lambda url, http: one(spark, url, "string", lambda c: paths.is_allowed_url(c, allow_http=http))
    assert allowed("https://h/x", False) and not allowed("http://h/x", False) and allowed("http://h/x", True)
    assert not any(allowed(u, True) for u in ("https://u@h/", "https://h/#f", "ftp://h/", "https:///x", None))
    assert one(spark, "x/lib-2.1.0-SNAPSHOT.swc", "string", paths.bundle_name) == "lib"
    assert one(spark, "res/gui/flash/swc/a.swc", "string", lambda c: paths.in_folders(c, ("gui", "flash", "swc"))) is True
    assert one(spark, "res/gui/swc/a.swc", "string", lambda c: paths.in_folders(c, ("gui", "flash", "swc"))) is False


def test_formats(spark):
    sizes = {0: "0 B", 1023: "1023 B", 1024: "1.0 KiB", 1536: "1.5 KiB", 5 << 20: "5.0 MiB", 3 << 30: "3.0 GiB"}
    assert {k: one(spark, k, "long", formats.format_bytes) for k in sizes} == sizes
    times = {5: "5s", 184: "3m 04s", 7380: "2h 03m", 93600: "1d 02h"}
    assert {k: one(spark, k, "long", formats.format_duration) for k in times} == times
    assert one(spark, 159, "long", formats.format_cents) == "€1.59"
    assert one(spark, "<a & 'b'>", "string", formats.escape_html) == "&lt;a &amp; &#x27;b&#x27;&gt;"
    assert one(spark, "a_b*", "string", formats.escape_markdown) == "a\\_b\\*"
    assert one(spark, "v.2.4.0.0 Common Test #927", "string", formats.readable_version) == "2.4.0.0 #927"
    assert one(spark, "none", "string", formats.readable_version) is None
    assert one(spark, "api_key=abc&x=1 https://u:p@h", "string", formats.redact_secrets) == "api_key=REDACTED&x=1 https://REDACTED@h"
    assert [one(spark, n, "int", lambda c: formats.retry_delay(c, base=1.0, cap=5.0)) for n in (1, 2, 3, 4, 5)] == [0.0, 1.0, 2.0, 4.0, 5.0]
    parts = lambda n: one(spark, n, "long", lambda c: formats.segment_count(c, least_size=512, target=128, most=16))
    assert [parts(n) for n in (100, 512, 1024, 1 << 20)] == [1, 4, 8, 16]


def test_canonical_forms(spark):
    row = spark.createDataFrame([(1, "é", None)], "b int, a string, c int")
    fields = {k: F.col(k) for k in ("b", "a", "c")}
    assert row.select(canon.canonical_json(fields).alias("x")).first().x == '{"a":"é","b":1}\n'
    assert row.select(canon.canonical_json(fields, keep_nulls=True).alias("x")).first().x == '{"a":"é","b":1,"c":null}\n'
    assert one(spark, "a", "string", canon.crc32_hex) == "E8B7BE43"
    assert one(spark, "Straße É", "string", canon.fold_case) == "strasse é"
    assert one(spark, "a b/é", "string", canon.percent_encode) == "a%20b/%C3%A9"
    assert one(spark, "a/é b", "string", lambda c: canon.path_of_components(canon.base64_components(c))) == "a/é b"


def test_conversions(spark):
    kinds = {b"PK\x03\x04...": "zip", b"7z\xbc\xaf\x27\x1c": "seven-zip", b"plain": "unknown", b"": "unknown", b"MZ..": "pe"}
    assert {k: one(spark, k, "binary", convert.container_kind) for k in kinds} == kinds
    assert one(spark, "# a\n# b\nx = 1\nreturn\n", "string", convert.strip_decompiler_marks) == "x = 1\n"
    assert one(spark, "# only\nreturn", "string", convert.strip_decompiler_marks) == "pass\n"
    assert one(spark, "Unsupported opcode: X", "string", convert.has_failure_mark) is True
    assert one(spark, "a\r\nb\rc\n", "string", formats.normalize_newlines) == "a\nb\nc\n"


def test_stages_are_kept_and_checked(spark, tmp_path):
    calls = []

    def double(t):
        calls.append(1)
        return t.select((F.col("id") * 2).alias("id"))

    steps = [stages.Stage("double", 1, double, key=("id",), checks={"odd": F.col("id") % 2 == 0}), stages.Stage("half", 1, lambda t: t.where("id > 2"), {"least": 2})]
    first, report = stages.run_stages(spark, str(tmp_path), spark.range(4), "v1", steps)
    assert rows(first, "id") == [(4,), (6,)] and [r["reused"] for r in report] == [False, False]
    assert [r["reused"] for r in stages.run_stages(spark, str(tmp_path), spark.range(4), "v1", steps)[1]] == [True, True]
    assert [r["reused"] for r in stages.run_stages(spark, str(tmp_path), spark.range(4), "v2", steps)[1]] == [False, False]
    assert len(calls) == 2
    bad = [stages.Stage("bad", 1, lambda t: t, key=("id",), checks={"odd": F.col("id") % 2 == 0})]
    with pytest.raises(ValueError, match="bad"):
        stages.run_stages(spark, str(tmp_path), spark.range(4), "v1", bad)


def test_stage_states(spark):
    data = [("r", "a", "succeeded", "t", "t", "d", None), ("r", "b", "running", "t", None, None, None), ("s", "a", "failed", "t", "t", "d", None), ("s", "b", "odd", None, None, None, None)]
    table = spark.createDataFrame(data, "run string, stage string, state string, started_at string, finished_at string, result_digest string, error string")
    table = table.withColumn("attempt", F.lit(1)).withColumn("input_digest", F.lit("i"))
    found = rows(stages.state_violations(table, ["run", "stage"]), "run", "stage", "error_code")
    assert found == [("s", "a", "failed-with-result_digest"), ("s", "a", "failed-without-error"), ("s", "b", "unknown-state")]
    none = spark.createDataFrame([], "run string")
    assert rows(stages.interrupt_stale(table, none, "run").where("stage = 'b'"), "state") == [("interrupted",), ("odd",)]


def test_fixpoint(spark):
    least = lambda t: t.select(F.least(F.col("id") + 1, F.lit(5)).alias("id"))
    found, rounds = stages.until_stable(spark.range(3), least, most=9)
    assert rows(found, "id") == [(5,)] * 3 and rounds == 5
    with pytest.raises(RuntimeError):
        stages.until_stable(spark.range(3), lambda t: t.select((F.col("id") + 1).alias("id")), most=2)


def test_total_join_raises(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(Exception, match="no match: k"):
        integrity.total_join(a, b, ["k"], "k").collect()
    assert rows(integrity.total_join(a.where("k = 1"), b, ["k"], "k"), "v") == [("x",)]


def test_source_usage(spark):
    text = "import game.player as p\nimport time\np.callback(1.5, None)\nplayer()\np.callback(2, x=3)\nf('a', True)\n"
    docs = spark.createDataFrame([("f.py", text)], "path string, text string")
    assert rows(evidence.import_names(docs, keys=["path"], text="text"), "module", "alias") == [("game.player", "p"), ("time", "time")]
    more = spark.createDataFrame([("g.py", "from a.b import c as d, e\nimport os, sys as s  # both\n  from . import (x, y)\nimportant = 1\n")], "path string, text string")
    assert rows(evidence.import_names(more, keys=["path"], text="text"), "module", "name", "alias") == [
        (".", "x", "x"), (".", "y", "y"), ("a.b", "c", "d"), ("a.b", "e", "e"), ("os", None, "os"), ("sys", None, "s"),
    ]
    found = rows(evidence.call_shapes(docs, keys=["path"], text="text"), "name", "arity", "kinds", "n_calls")
    assert found == [("f", 2, "string,bool", 1), ("p.callback", 2, "number,keyword", 1), ("p.callback", 2, "number,none", 1), ("player", 0, "", 1)]
    jobs = spark.createDataFrame([("build",), ("build / x",), ("builder",), ("test / build",)], "job string")
    names = spark.createDataFrame([("build",)], "name string")
    assert rows(evidence.match_names(jobs, names, row="job", name="name"), "job") == [("build / x",), ("build",)]


def test_preferred(spark):
    data = spark.createDataFrame([("a", 5), ("b", 9), ("c", 9)], "name string, size int")
    assert planning.preferred_or_first(data, preferred=F.col("name") == "a", order=["size"]).first().name == "a"
    largest = data.withColumn("less", -F.col("size"))
    assert planning.preferred_or_first(largest, preferred=F.lit(False), order=["less", "name"]).first().name == "b"


def test_long_chains_and_cycles_behind_a_tail(spark):
    edges = [("long", str(i), str(i + 1)) for i in range(300)] + [("rho", "0", "1"), ("rho", "1", "2"), ("rho", "2", "3"), ("rho", "3", "1")]
    edges = spark.createDataFrame(edges, "part string, src string, dst string")
    assert rows(graph.chain_errors(edges, key="part", source="src", target="dst", start="0"), "part", "error_code") == [("rho", "cycle")]
    walked = graph.walk_chain(edges, key="part", source="src", target="dst", start="0")
    assert walked.where("part = 'long'").agg(F.max("hop"), F.count("*")).first()[:] == (300, 300)
    assert rows(walked.where("cycle"), "part", "src", "dst", "hop") == [("rho", "3", "1", 4)]
    hops = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), *[(f"h{i}", f"h{i + 1}") for i in range(8)]], "src string, dst string")
    found = {r.src: (r.final, r.hops, r.state) for r in graph.follow_redirects(hops, source="src", target="dst").collect()}
    assert found["a"] == ("b", 3, "cycle") and found["b"] == ("b", 2, "cycle")
    assert found["h0"] == ("h8", 8, "ok")


def test_download_statistics_in_full(spark):
    data = [("s", 100, False, 20, 2, 4, [30], "web-seed"), ("s", 200, True, None, None, None, None, None), ("t", 5, False, 9, None, None, [], None)]
    table = spark.createDataFrame(data, "k string, size long, reused boolean, resumed long, attempts long, segments long, discarded array<long>, method string")
    columns = {c: F.col(c) for c in ("size", "reused", "resumed", "attempts", "segments", "discarded", "method")}
    got = stats.download_stats(table, keys=["k"], **columns, methods=["web-seed", "torrent"], seconds=F.max(F.lit(10)))
    one, two = sorted(got.collect())
    assert one.asDict() == {
        "k": "s", "n_items": 2, "n_fetched": 1, "n_reused": 1, "reused_bytes": 200, "resumed_bytes": 20, "network_bytes": 110, "attempts": 2, "n_parallel": 1,
        "parallel_segments": 4, "n_fallback_items": 1, "n_fallbacks": 1, "discarded_bytes": 30, "n_web-seed": 1, "n_torrent": 0, "seconds": 10, "network_rate": 11.0,
    }
    assert (two.resumed_bytes, two.network_bytes, two.n_parallel, two.network_rate) == (5, 0, 0, 0.0)


def test_run_state(spark):
    data = [
        ("a", 1, "success", "r1"), ("a", 2, "failure", "r2"), ("a", 3, "cancelled", None), ("a", 4, "failure", "r2"), ("a", 5, "failure", "r1"),
        ("b", 1, "failure", "r1"), ("b", 2, "failure", "r2"), ("b", 3, "failure", "r1"), ("b", 4, "failure", "r1"),
        ("c", 1, "failure", "r1"), ("c", 2, "success", "r1"), ("d", 1, "cancelled", None),
    ]
    runs = spark.createDataFrame(data, "k string, t long, result string, release string")
    found = history.run_state(runs, target="k", order=["t"], result=F.col("result"), release=F.col("release"), completed=F.col("t") * 10)
    assert sorted(map(tuple, found.collect())) == [
        ("a", "r1", "failure", "r2", 20, 40), ("b", None, "failure", "r1", 30, 40), ("c", "r1", "success", None, None, None), ("d", None, "cancelled", None, None, None),
    ]


def test_status_rules(spark):
    good = ("r1", "1.0", "failure", "r2", 100, 160, 60, "r2", 150, 160)
    bad = {
        "unknown-result": (2, "done"), "version-without-text": (1, None), "completed-before-start": (4, 200), "completed-in-future": (5, 2000), "duration": (6, 61),
        "failure-without-retry": (7, None), "retry-of-version": (7, "r1"), "retry-order": (8, 170), "retry-of-other-run": (9, 155),
    }
    table = [("good", *good), *((code, *good[:at], value, *good[at + 1 :]) for code, (at, value) in bad.items())]
    schema = "k string, version string, readable string, result string, run_release string, started long, completed long, seconds long, retry_release string, first_failed long, last_failed long"
    found = {(r.k, r.error_code) for r in integrity.violations(spark.createDataFrame(table, schema), ["k"], history.status_rules(now=F.lit(1000))).collect()}
    assert {(code, code) for code in bad} <= found and not any(k == "good" for k, _ in found)


def test_spellings_collide(spark):
    names = spark.createDataFrame([("a", "Straße"), ("a", "STRASSE"), ("a", "same"), ("a", "same"), ("b", "Same")], "scope string, name string")
    found = overlay.collisions(names, scope=["scope"], name=F.col("name"), folded=canon.fold_case(F.col("name")))
    assert rows(found, "scope", "folded", "n_spellings", "n_rows") == [("a", "strasse", 2, 2)]


def test_rank_over_all_of_one_value(spark):
    table = spark.range(500).selectExpr("id", "1 AS size")
    found = planning.rank_over_all(table, [F.desc("size"), F.asc("id")], rough=F.lit(3))
    assert {r.id: r["rank"] for r in found.collect()} == {i: i for i in range(500)}


def test_totals_cross_buckets(spark):
    from stratalith.operators.monitor import cumulative

    table = spark.range(200).selectExpr("id", "'k' AS k", "id * 37 AS t", "id % 5 AS n")
    found = {r.id: r.total for r in cumulative(table, key="k", time=F.col("t"), tie="id", amount=F.col("n"), bucket_seconds=100).collect()}
    assert found == {i: sum(j % 5 for j in range(i + 1)) for i in range(200)}


def test_times_and_parameter_names(spark):
    from stratalith.functions import formats

    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(formats.utc_text(F.lit("2024-03-31T01:30:00.9+02:00"))) == "2024-03-30T23:30:00Z"
    assert one(formats.utc_text(F.lit("2024-03-31T01:30:00"))) is None and one(formats.utc_text(F.lit("soon"))) is None
    assert one(formats.local_text(F.lit("2024-07-01T10:00:00Z"), "Europe/Berlin")) == "2024-07-01 12:00"
    assert one(formats.unique_names(F.array(F.lit("x"), F.lit(""), F.lit("x"), F.lit(None)))) == ["x", "arg1", "arg2", "arg3"]
    assert one(formats.retry_delay(F.lit(40), base=1.0, cap=1e9)) == 1024.0
    assert one(formats.rate(F.lit(5), F.lit(16), 3)) == 0.312
    assert one(canon.crc32_hex(F.lit(b"123456789"))) == "CBF43926"


def test_call_shapes_nested_and_quoted(spark):
    text = "f(\"a,b\", 'c)d')\ng(h(1, k()), (2, 3), x=[i(4)])\nbroken(1, (2\nm(n)(o)\n"
    docs = spark.createDataFrame([("f.py", text)], "path string, text string")
    found = rows(evidence.call_shapes(docs, keys=["path"], text="text"), "name", "arity", "kinds")
    assert found == [
        ("f", 2, "string,string"), ("g", 3, "call,name,keyword"), ("h", 2, "number,call"), ("i", 1, "number"), ("k", 0, ""), ("m", 1, "name"),
    ]


def test_unknown_kinds_raise(spark):
    from stratalith.operators import publish

    data = spark.createDataFrame([(1, "a"), (2, "z")], "id int, kind string")
    shaped = publish.by_kind(data, kind=F.col("kind"), fields={"a": {"x": F.col("id")}}, keep=["id"])
    assert shaped.where("id = 1").first().source.asDict() == {"kind": "a", "x": 1}
    with pytest.raises(Exception, match="unknown kind"):
        shaped.collect()


def test_sources_are_retained(spark):
    from stratalith.operators import publish

    files = spark.createDataFrame([("a.PYC",), ("b.mo",), ("c.txt",), ("d.pyc",)], "path string")
    kept = spark.createDataFrame([("d.pyc",)], "path string")
    assert rows(publish.unretained(files, kept, path="path", suffixes=[".pyc", ".mo"]), "path") == [("a.PYC",), ("b.mo",)]
    layers = spark.createDataFrame([("de", 1), (None, 2), (None, 1)], "layer string, n int")
    assert [tuple(r) for r in layers.orderBy(*publish.layer_order(F.col("layer"), [F.col("n")])).collect()] == [(None, 1), (None, 2), ("de", 1)]


def test_short_chains_are_walked_in_rows(spark, monkeypatch):
    """Chains of SHORT edges at most need no rounds of joins; the others' rows are the same as if they were short."""
    from stratalith.operators import graph

    edges = [("a", None, "1"), ("a", "1", "2"), ("a", "2", "1"), ("a", "9", "8"), ("b", "7", "8"), ("c", "0", "0"), ("d", None, "5"), ("d", "0", "4"), ("d", "4", "6"), (None, None, "1"), ("e", None, None)]
    edges += [("f", str(i), str(i + 1)) for i in range(70)]
    table = spark.createDataFrame(edges, "k string, s string, t string")
    walk = lambda: sorted(tuple(r) for r in graph.walk_chain(table, key="k", source="s", target="t", start="0").collect())
    rounds = []
    joins = graph._walk_joins
    monkeypatch.setattr(graph, "_walk_joins", lambda step, start: rounds.append({r.k for r in step.collect()}) or joins(step, start))
    mixed = walk()
    assert rounds == [{"f"}]
    want = [("a", "0", "1", 1, False), ("a", "1", "2", 2, False), ("a", "2", "1", 3, True), ("c", "0", "0", 1, True), ("d", "0", "4", 1, False), ("d", "4", "6", 2, False)]
    assert mixed == want + [("f", str(i), str(i + 1), i + 1, False) for i in sorted(range(70), key=str)]
    monkeypatch.setattr(graph, "SHORT", 0)
    assert walk() == mixed
