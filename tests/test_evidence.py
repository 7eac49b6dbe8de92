"""Calls, imports, overloads, names, times, counters, states and closures, each against a plain version."""

import keyword
import random

import pytest
from pyspark.sql import functions as F

from stratalith.functions import formats
from stratalith.operators import evidence, graph, stages, stats


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def calls(spark, text):
    docs = spark.createDataFrame([("f.py", text)], "path string, text string")
    return rows(evidence.call_shapes(docs, keys=["path"], text="text"), "name", "arity", "kinds", "n_calls")


@pytest.mark.parametrize(
    "text, want",
    [
        ("f(\"x\", [1, 2], {'a': 1})", [("f", 3, "string,name,name", 1)]),
        ("f(a[1, 2], {1: g(2, 3)}, (4, 5))", [("f", 3, "name,name,name", 1), ("g", 2, "number,number", 1)]),
        ("f(')', \"]},(\", '\\',', u'x', r\"y\")", [("f", 5, "string,string,string,string,string", 1)]),
        ("f(-1, +2.5e3, - x, 1 + 2, --3)", [("f", 5, "number,number,name,name,name", 1)]),
        ("f(x=1, y==2, *a, **k, lambda: 3,)", [("f", 5, "keyword,name,name,name,name", 1)]),
        ("f(a.b(1), a.b(1)[0], not True, True, None)", [("a.b", 1, "number", 2), ("f", 5, "call,call,name,bool,none", 1)]),
        ("f(1 # no, args, here\n, 2)", [("f", 2, "number,number", 1)]),
        ("f(1]}, 2) g[h(1)", [("f", 2, "number,number", 1), ("h", 1, "number", 1)]),
        ("f(" * 40 + ")" * 40, [("f", 0, "", 1), ("f", 1, "call", 39)]),
        ("", []),
    ],
)
def test_calls(spark, text, want):
    assert calls(spark, text) == want


def test_calls_of_null_texts(spark):
    assert calls(spark, None) == []


def test_import_usage(spark):
    text = "import a.b as c, d\nfrom e.f import g as h, i, *\nfrom . import j\nc.x(1); c.y; xc.z; d.u.v (2); h(3); i\nj.k(); self.d.w(); e.n()\n"
    docs = spark.createDataFrame([(1, text), (2, "c.x()"), (3, None), (4, "import q\nq.q.q()")], "k int, t string")
    assert rows(evidence.import_usage(docs, keys=["k"], text="t"), "k", "module", "member", "called") == [
        (1, "a", "x", True), (1, "a", "y", False), (1, "d", "u", False), (1, "d", "w", True), (1, "e", "g", True), (1, "e", "i", False), (4, "q", "q", True),
    ]


TYPES = ["int", "float", "str", "Any"]


def score(params, kinds):
    total = (10 if len(params) == len(kinds) else 0) - (len(params) - len(kinds))
    for p, k in zip(params, kinds):
        if k == "Any":
            total -= p != "Any"
        elif p != "Any":
            total += 3 if p == k or (k, p) == ("int", "float") else -4
    return total


def family(a, b):
    short, long = sorted((a, b), key=lambda s: len(s[1]))
    return a[0] == b[0] and len(short[1]) != len(long[1]) and long[1][: len(short[1])] == short[1]


@pytest.mark.parametrize("seed", range(4))
def test_overloads(spark, seed):
    rng = random.Random(seed)
    params = lambda least: tuple(rng.choice(TYPES) for _ in range(rng.randint(least, 4)))
    signatures = {(n, rng.choice(["int", "None"]), params(0)) for n in "abcdef" for _ in range(rng.randint(1, 7))}
    shapes = [(rng.choice("abcdeg"), params(0)) for _ in range(14)] + [("a", ("Any", "Any")), ("b", ("Any",))]
    want = set()
    for name in "abcdef":
        own = {s[1:] for s in signatures if s[0] == name}
        told = {k for n, k in shapes if n == name}
        counted = {k for k in told if any(x != "Any" for x in k)} or told
        chosen = set()
        for kinds in counted:
            scored = [(score(s[1], kinds), s) for s in own if len(s[1]) >= len(kinds)]
            chosen |= {s for v, s in scored if v == max(scored)[0]}
        beside = {s for s in own - chosen if any(family(s, c) for c in chosen)} if chosen else own
        least = min(map(len, counted), default=None)
        want |= {(name, s[0], s[1], s in chosen, least if least is not None and least < len(s[1]) else None) for s in chosen | beside}
    made = evidence.choose_overloads(
        spark.createDataFrame(sorted((n, r, list(p)) for n, r, p in signatures), "n string, r string, p array<string>"),
        spark.createDataFrame([(n, list(k)) for n, k in shapes * 2], "n string, k array<string>"), name="n", params="p", result="r", kinds="k",
    )
    assert {(r.n, r.r, tuple(r.p), r.chosen, r.required) for r in made.collect()} == want


def test_names_are_never_given_twice(spark):
    for seed in range(30):
        rng = random.Random(seed)
        raw = [rng.choice(["a", "arg1", "arg1_", "arg2", "arg3", "class", "", None, "a_2", "é b", "self"]) for _ in range(rng.randint(0, 8))]
        want, taken = [], {"self"}
        for i, x in enumerate(raw):
            name = x if x and x.isascii() and x.isidentifier() and not keyword.iskeyword(x) and x not in taken else f"arg{i}"
            while name in taken:
                name += "_"
            taken.add(name)
            want.append(name)
        df = spark.createDataFrame([(raw,)], "n array<string>")
        assert df.select(formats.unique_names(F.col("n"), taken=["self"]).alias("x")).first().x == want
    plain = spark.createDataFrame([(["a", "a", "a_2"],), ([],), (None,)], "n array<string>").select(formats.unique_names(F.col("n")).alias("x")).collect()
    assert [r.x for r in plain] == [["a", "arg1", "a_2"], [], None]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/St_Johns", "Asia/Tokyo"])
def test_times_do_not_hang_on_the_session(spark, zone):
    texts = ["2024-03-31T02:30:00Z", "2024-10-27T00:30:00Z", "2024-10-27T01:30:00.999Z", "2024-03-31T04:30:00+02:00", "1969-12-31T23:59:59Z", "0999-01-01T00:00:00Z", "2024-03-31T02:30:00", "soon"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(formats.utc_text(F.col("t")).alias("u"))
        got = [(r.u, r.tokyo, r.berlin) for r in df.select("u", formats.local_text(F.col("u"), "Asia/Tokyo").alias("tokyo"), formats.local_text(F.col("u"), "Europe/Berlin").alias("berlin")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[:4] == [
        ("2024-03-31T02:30:00Z", "2024-03-31 11:30", "2024-03-31 04:30"), ("2024-10-27T00:30:00Z", "2024-10-27 09:30", "2024-10-27 02:30"),
        ("2024-10-27T01:30:00Z", "2024-10-27 10:30", "2024-10-27 02:30"), ("2024-03-31T02:30:00Z", "2024-03-31 11:30", "2024-03-31 04:30"),
    ]
    assert [g[0] for g in got[4:]] == ["1969-12-31T23:59:59Z", "0999-01-01T00:00:00Z", None, None]


def test_counters_that_are_reset(spark):
    samples = spark.createDataFrame([("a", 0, 10), ("a", 10, 5), ("a", 20, 7), ("a", 100, 3), ("b", 0, None), ("b", 5, 4), ("b", 6, 9)], "k string, s long, v long")
    found = stats.counter_rates(samples, keys=["k"], time=F.timestamp_seconds("s"), counter="v", bucket_seconds=50)
    assert rows(found, "k", "bucket", "n_samples", "growth", "n_resets", "growth_rate") == [("a", 0, 3, 7, 1, 0.35), ("a", 100, 1, 0, 0, None), ("b", 0, 3, 5, 0, 0.833)]


def test_states_and_their_fields(spark):
    good = {
        "pending": (0, None, None, None, None, None), "running": (1, "d", 1, None, None, None), "succeeded": (2, "d", 1, 2, "r", None),
        "failed": (1, "d", 1, 2, None, "e"), "interrupted": (1, "d", 1, 2, None, "e"),
    }
    own = "state string, attempt int, input_digest string, started_at int, finished_at int, result_digest string, error string"
    table = spark.createDataFrame([(s, *v) for s, v in good.items()], own)
    assert stages.state_violations(table, ["state"]).collect() == []
    bad = [("interrupted", 1, "d", 1, None, None, None), ("pending", 1, None, None, None, None, None), ("running", 0, None, 1, None, None, None), ("odd", 1, "d", 1, None, None, None)]
    assert rows(stages.state_violations(spark.createDataFrame(bad, own), ["state"]), "state", "error_code") == [
        ("interrupted", "interrupted-without-error"), ("interrupted", "interrupted-without-finished_at"), ("odd", "unknown-state"),
        ("pending", "pending-with-attempt"), ("running", "running-without-input_digest"), ("running", "without-attempt"),
    ]


def test_ordered_lists_of_whole_states(spark):
    edges = [("list", None, "1", 1), ("list", None, "2", 2), ("twice", None, "1", 1), ("twice", None, "1", 2), ("one", None, "1", 1), ("chain", None, "1", 1), ("chain", "1", "2", 2), ("mixed", None, "1", 1), ("mixed", None, "2", 2), ("mixed", "2", "3", 3)]
    edges = spark.createDataFrame(edges, "k string, s string, t string, i int")
    errors = lambda ordered: rows(graph.chain_errors(edges, key="k", source="s", target="t", start="0", ordered=ordered), "k", "error_code")
    assert errors(True) == [("mixed", "branch"), ("twice", "duplicate-target")]
    assert errors(False) == [("list", "branch"), ("mixed", "branch"), ("twice", "branch")]
    last = graph.states_to_apply(edges.where("k <> 'mixed'"), key="k", source="s", order="i")
    assert rows(last, "k", "t") == [("chain", "1"), ("chain", "2"), ("list", "2"), ("one", "1"), ("twice", "1")]


def test_closure_by_deltas(spark):
    edges = [(a, b) for a, b in ((k, k + 1) for k in range(30))] + [(30, 5), (90, 91), (None, 1)]
    table = spark.createDataFrame(edges, "a int, b int")
    seen = []

    def step(new):
        seen.append(new.count())
        return new.alias("n").join(table.alias("e"), F.col("n.b") == F.col("e.a")).select(F.col("n.a").alias("a"), F.col("e.b").alias("b"))

    found, rounds = stages.closure(table, step, most=60)
    reach = {(a, b) for a, b in edges}
    while True:
        more = {(a, d) for a, b in reach for c, d in edges if b == c and b is not None} | reach
        if more == reach:
            break
        reach = more
    assert {tuple(r) for r in found.collect()} == reach and found.count() == len(reach)
    assert sum(seen) == len(reach) and rounds == len(seen)  # each row is worked on once
    with pytest.raises(RuntimeError):
        stages.closure(table, step, most=3)


def test_import_usage_splits_by_texts(spark, monkeypatch):
    """A task holds TEXTS texts; a key of several texts shares its aliases, whatever partition its names lie in."""
    monkeypatch.setattr(evidence, "TEXTS", 10)
    rows = [(k, f"import m{k} as x\nfrom p import q as z\nx.a(1)\nx.b\n") for k in range(99)] + [(7, "x.c(2)\nz (3)\n"), (None, "import n\nn.d\n")]
    found = evidence.import_usage(spark.createDataFrame(rows, "k long, text string"), keys=["k"], text="text")
    assert found.rdd.getNumPartitions() == 11
    got = {tuple(r) for r in found.collect()}
    want = {(k, f"m{k}", m, c) for k in range(99) for m, c in (("a", True), ("b", False))} | {(k, "p", "q", k == 7) for k in range(99)}
    assert got == want | {(7, "m7", "c", True), (None, "n", "d", False)}
