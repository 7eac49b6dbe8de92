"""Url rules and host reputation: brute force, the SQL counterpart on edge cases, and shrinkage."""

import pytest
from pyspark.sql import functions as F

from stratalith.llm import url_reputation as urls

EDGES = [
    (1, None, None), (2, "", "x"), (3, "no scheme/here", "x"), (4, "http://", ""), (5, "HTTP://Sub.Example.NET/en/a?b#c", "%%%"), (6, "https://example.net/EN/", "x"),
    (7, "https://example.net", "x"), (8, "https://a.net?x=://b.org/fr/", "x"), (9, "https://w.example.com/de/", "x"), (10, "https://example.com/de", "x"),
    (11, "https://a.org/fr/x", "x"), (12, "https://org/fr/", "x"), (13, "https://myexample.com/de/", "x"), (14, "https://u@h.example.com:8080/de/", "x"),
    (15, "https://example.net:80/en/", "x"), (16, "https://10.0.0.1/x", "x"), (17, "https://a.b.co.uk/x", "###"), (18, "https://İ.example.org/fr/", "x"),
    (19, "https://net/", "x"), (19, "https://net/", "x"), (None, "https://bets.example.org/", "x"), (20, "x://" + "a" * 60_000 + "/p", "x"), (21, "https://a.net#/en/", "x"),
]


def expected(url):
    """Host, path and rule, as they are defined."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    best = None
    for r in urls.RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.host + r.path) > len(best.host + best.path)):
            best = r
    return host, path, best and best.host + best.path, best and best.verdict


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 0.5) for r in rows], "page_id long, url string, html string, host string, bad_rate double")


def test_rules_are_brute_force(spark, tmp_path):
    pages(spark, EDGES).write.parquet(f"{tmp_path}/pages.parquet")
    got = urls.op1_url_reputation(spark, str(tmp_path)).collect()
    assert len(got) == len(EDGES)
    want = sorted(str((i, *expected(u)[:3])) for i, u, _ in EDGES)
    assert sorted(str((r.page_id, r.host, r.path, r.rule)) for r in got) == want
    verdicts = {r.rule: r.verdict for r in got if r.rule}
    assert verdicts == {r.host + r.path: r.verdict for r in urls.RULES if r.host + r.path in verdicts}
    assert {r.verdict for r in got} <= {"allow", "block"}


@pytest.mark.parametrize("case", ["edges", "empty", "hot"])
def test_sql_has_the_same_rows(spark, tmp_path, case):
    import duckdb

    rows = EDGES if case == "edges" else [(i, f"https://h{i % 40 if i % 3 else 0}.d{i % 5}.example.com/x", "%%%" if i % 40 == 1 else "x") for i in range(600)]
    table = pages(spark, rows)
    table = table.where("false") if case == "empty" else table
    table.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT page_id, url, html FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(urls.OP1_SQL)
    got = urls.op1_url_reputation(spark, str(tmp_path))
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(str(tuple(r)) for r in want.fetchall())
    assert got.columns == want.columns


def test_hosts_shrink_to_their_domain(spark):
    rows = [(i, f"https://h{i % 8}.bad.example/x", "b" if i % 10 else "g") for i in range(400)] + [(1000 + i, f"https://h{i % 8}.good.example/x", "g") for i in range(400)]
    rows += [(2000, "https://new.bad.example/", None), (2001, "https://new.good.example/", None)]
    judged = urls.judge_urls(pages(spark, rows).select("page_id", "url", "html"), F.when(F.col("html") == "b", 1).when(F.col("html") == "g", 0))
    found = {r.page_id: r for r in judged.where("page_id >= 2000").collect()}
    assert len(found) == 2
    assert found[2000].verdict == "block" and found[2001].verdict == "allow"
    assert found[2000].bad_rate > 0.8 and found[2001].bad_rate < 0.2
    labelled = {r.host: r for r in judged.where("page_id < 2000").collect()}
    assert all(r.verdict == ("block" if ".bad." in h else "allow") for h, r in labelled.items())


def test_unlabelled_levels_take_the_next(spark):
    """A host of a bad domain, a domain of a bad suffix and a suffix of its own, none with an outcome."""
    rows = [(i, f"https://h{i % 9}.spam{i % 30}.bad/x", "b") for i in range(600)] + [(1000 + i, f"https://h{i % 9}.fine{i % 30}.good/x", "g") for i in range(900)]
    rows += [(2000, "https://new.spam3.bad/", None), (2001, "https://new.other.bad/", None), (2002, "https://new.other.none/", None), (2003, "https://new.other.good/", None)]
    judged = urls.judge_urls(pages(spark, rows).select("page_id", "url", "html"), F.when(F.col("html") == "b", 1).when(F.col("html") == "g", 0), z=0.5)
    rate = {r.page_id: r.bad_rate for r in judged.where("page_id >= 2000").collect()}
    assert rate[2000] > rate[2001] > rate[2002] > rate[2003]
    assert rate[2002] == pytest.approx(601 / 1502)


def test_moments_of_huge_hosts(spark):
    """Counts whose squares leave a long behind."""
    counts = spark.createDataFrame([(4_000_000_000, 3_100_000_000), (10, 2), (0, 0)], "n long, y long")
    m = urls.moments(counts)
    assert m["m"] == 2 and m["nn"] == 16 * 10**18 + 100
    assert m["s"] == 3_100_000_000**2 * 10**6 // 4_000_000_000 + 4 * 10**5
    assert 1 <= urls.concentration(m) <= 1000
