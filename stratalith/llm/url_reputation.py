"""Operator 1: URL filter by Empirical-Bayes host reputation, with fixed host and path rules.

Labelled page outcomes are counted for each host and shrunk through beta-binomial priors: the
global rate shrinks suffixes, a suffix its registered domains, a domain its hosts. Concentrations
come from the data by the method of moments, so a level whose members differ little shrinks them
hard. A page without a rule is blocked when the lower posterior bound of its host's bad rate is
above ``block_above``.

Plain DataFrame operations. Host counts combine before the shuffle. Hosts with over 1/64 of all
pages (63 at most) are joined by broadcast, all others by a shuffle join in which pages of hot hosts
carry a key of their own, so no host gathers in one task.

Nulls, empties: a null url or one without ``://`` has empty host and path and is judged by the pages
that share them. A null outcome counts for nothing; a host without any other takes its domain's rate, a
domain without one its suffix's, a suffix the rate of all. Repeated pages count as often as they stand.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels under which names are registered; all others have one label.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "org.uk")
#: Words in a host, and runs of marks in a page, that label its outcome as bad.
BAD_HOST = "adult|casino|pills|bets"
BAD_HTML = "%%%|###|[$][$][$]"
HOT = 64


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    pattern = "://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def registered(host: Column, suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host, of two labels if it is one of ``suffixes``; an address
    of digits is its own domain."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    last = lambda n: F.substring_index(bare, ".", -n)
    two = last(2).isin(*suffixes)
    address = bare.rlike("^[0-9.]+$")
    domain = F.when(address, bare).when(two, last(3)).otherwise(last(2))
    suffix = F.when(address, F.lit("(address)")).when(two, last(2)).otherwise(last(1))
    return domain, suffix


def match_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The longest rule that fits, as its string and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.host + rule.path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def moments(groups: DataFrame) -> dict:
    """Sums over (n, y) that fix a level's mean and concentration, of groups with outcomes; whole numbers, so
    exact, and decimals, so that a group may hold any number of pages."""
    n, y = (f"CAST({c} AS DECIMAL(15, 0))" for c in "ny")
    row = groups.where("n > 0").select(
        F.count("*").alias("m"),
        F.sum("n").alias("n"),
        F.sum("y").alias("y"),
        F.sum(F.expr(f"CAST({n} * {n} AS DECIMAL(28, 0))")).alias("nn"),
        F.sum(F.expr(f"({y} * {y} * CAST(1000000 AS DECIMAL(7, 0))) div {n}")).alias("s"),
    ).first()
    return {k: int(v or 0) for k, v in row.asDict().items()}


def concentration(m: dict, default: float = 10.0) -> float:
    """Prior size by the method of moments for a beta-binomial, within [1, 1000]."""
    if not m["n"] or m["y"] in (0, m["n"]):
        return default
    p = m["y"] / m["n"]
    spread = m["s"] / 1e6 - m["n"] * p * p
    room = m["n"] - m["nn"] / m["n"] - (m["m"] - 1)
    if room <= 0:
        return default
    rho = min(max((spread / (p * (1 - p)) - (m["m"] - 1)) / room, 1 / 1001), 0.5)
    return (1 - rho) / rho


def host_reputation(counts: DataFrame, *, z: float) -> DataFrame:
    """(host, domain, suffix, rows, n, y) to (host, rows, bad_rate, bad_low): posterior mean and lower bound.

    Concentrations come from the groups with outcomes; one without takes the mean of its prior."""
    domains = counts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    of_host, of_domain, of_suffix = moments(counts), moments(domains), moments(suffixes)
    base = (of_suffix["y"] + 1) / (of_suffix["n"] + 2)
    k_host, k_domain, k_suffix = map(concentration, (of_host, of_domain, of_suffix))
    suffixes = suffixes.select("suffix", F.expr(f"(y + {k_suffix!r}D * {base!r}D) / (n + {k_suffix!r}D)").alias("ps"))
    domains = domains.join(suffixes, "suffix").select(
        "domain", "suffix", F.expr(f"(y + {k_domain!r}D * ps) / (n + {k_domain!r}D)").alias("pd")
    )
    mean = F.expr(f"(y + {k_host!r}D * pd) / (n + {k_host!r}D)")
    return (
        counts.join(domains, ["domain", "suffix"])
        .select("host", "rows", "n", mean.alias("bad_rate"))
        .withColumn("bad_low", F.expr(f"bad_rate - {z!r}D * sqrt(bad_rate * (1D - bad_rate) / (n + {k_host!r}D + 1D))"))
        .drop("n")
    )


def judge_urls(
    pages: DataFrame,
    outcome: Column,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[Rule, ...] = RULES,
    suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES,
    block_above: float = 0.5,
    z: float = 1.645,
) -> DataFrame:
    """Verdict of every page. ``outcome``: 1 bad, 0 good, null unlabelled; over the columns of pages.

    Returns id, host, path, rule, verdict, bad_rate, bad_low.
    """
    host, path = split_url(F.col(url_col))
    labelled = pages.select(host.alias("host"), outcome.cast("int").alias("bad"))
    domain, suffix = registered(F.col("host"), suffixes)
    counts = (
        labelled.groupBy("host")
        .agg(F.count("*").alias("rows"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("y"))
        .select("host", domain.alias("domain"), suffix.alias("suffix"), "rows", "n", "y")
    )
    counts = materialize(counts, "host-counts")
    total = counts.agg(F.sum("rows")).first()[0] or 0
    rated = materialize(host_reputation(counts, z=z), "host-rates")
    hot = rated.where(F.col("rows") * HOT > total).select(
        F.col("host").alias("hot_host"), F.col("bad_rate").alias("hot_rate"), F.col("bad_low").alias("hot_low")
    )
    cold = rated.where(F.col("rows") * HOT <= total).select(F.col("host").alias("key"), "bad_rate", "bad_low")
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    judged = pages.select(F.col(id_col), host.alias("host"), path.alias("path")).join(
        F.broadcast(hot), F.col("host") == F.col("hot_host"), "left"
    )
    # '#' never stands in a host: hot rows spread over keys that meet no host.
    key = F.when(F.col("hot_host").isNull(), F.col("host")).otherwise(
        F.concat(F.lit("#"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    )
    judged = judged.withColumn("key", key).join(cold, "key", "left")
    judged = judged.withColumn("bad_rate", F.coalesce("hot_rate", "bad_rate")).withColumn(
        "bad_low", F.coalesce("hot_low", "bad_low")
    )
    by_rate = F.when(F.col("bad_low") > block_above, "block").otherwise("allow")
    return judged.select(
        id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, by_rate).alias("verdict"), "bad_rate", "bad_low"
    )


def page_outcome() -> Column:
    """Weak label of a page: bad (1) if its host has a spam word or its html runs of marks."""
    host, _ = split_url(F.col("url"))
    bad = host.rlike(BAD_HOST) | F.coalesce(F.col("html").rlike(BAD_HTML), F.lit(False))
    return bad.cast("int")


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    judged = judge_urls(pages, page_outcome())
    return judged.select(
        "page_id", "host", "path", "rule", "verdict", F.round("bad_rate", 6).alias("bad_rate"), F.round("bad_low", 6).alias("bad_low")
    )


def _level_sql(source: str) -> str:
    p = "(y / n)"
    spread = f"(s / 1e6 - n * {p} * {p})"
    room = "(n - nn / n - (m - 1))"
    rho = f"least(greatest(({spread} / ({p} * (1 - {p})) - (m - 1)) / {room}, 1 / 1001::DOUBLE), 0.5)"
    return f"""(SELECT CASE WHEN n = 0 OR y = 0 OR y = n OR {room} <= 0 THEN 10.0::DOUBLE
        ELSE (1 - {rho}) / {rho} END AS k, n AS all_n, y AS all_y
      FROM (SELECT count(*)::DOUBLE AS m, sum(n)::DOUBLE AS n, sum(y)::DOUBLE AS y, sum(n::HUGEINT * n)::DOUBLE AS nn,
              sum((y::HUGEINT * y * 1000000) // n)::DOUBLE AS s FROM {source}))"""


_RULE_SQL = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{{{k}}}'"
    for k, r in enumerate(sorted(RULES, key=lambda r: -len(r.host + r.path)))
)
_SORTED = sorted(RULES, key=lambda r: -len(r.host + r.path))
_NAMES = _RULE_SQL.format(*(r.host + r.path for r in _SORTED))
_VERDICTS = _RULE_SQL.format(*(r.verdict for r in _SORTED))
_TWO = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)

OP1_SQL = f"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path, html FROM pages),
l AS (
  SELECT host, CASE WHEN regexp_matches(host, '{BAD_HOST}') OR coalesce(regexp_matches(html, '{BAD_HTML}'), false)
    THEN 1 ELSE 0 END AS bad FROM p),
b AS (
  SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare,
    count(*)::BIGINT AS n, sum(bad)::BIGINT AS y FROM l GROUP BY host),
g AS (SELECT host, n, y, bare, string_split(bare, '.') AS parts FROM b),
t AS (SELECT *, array_to_string(parts[-2:], '.') AS last2 FROM g),
h AS (
  SELECT host, n, y,
    CASE WHEN regexp_matches(bare, '^[0-9.]+$') THEN bare
      WHEN last2 IN ({_TWO}) THEN array_to_string(parts[-3:], '.') ELSE last2 END AS domain,
    CASE WHEN regexp_matches(bare, '^[0-9.]+$') THEN '(address)'
      WHEN last2 IN ({_TWO}) THEN last2 ELSE array_to_string(parts[-1:], '.') END AS suffix
  FROM t),
d AS (SELECT suffix, domain, sum(n)::BIGINT AS n, sum(y)::BIGINT AS y FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n)::BIGINT AS n, sum(y)::BIGINT AS y FROM d GROUP BY ALL),
kh AS {_level_sql('h')}, kd AS {_level_sql('d')}, ks AS {_level_sql('s')},
ps AS (SELECT suffix, (y + k * ((all_y + 1) / (all_n + 2))) / (n + k) AS ps FROM s, ks),
pd AS (SELECT domain, d.suffix, (y + k * ps) / (n + k) AS pd FROM d JOIN ps USING (suffix), kd),
r AS (SELECT host, n, k, (y + k * pd) / (n + k) AS bad_rate FROM h JOIN pd USING (domain, suffix), kh),
x AS (SELECT host, bad_rate, bad_rate - 1.645 * sqrt(bad_rate * (1 - bad_rate) / (n + k + 1)) AS bad_low FROM r)
SELECT page_id, host, path, CASE {_NAMES} END AS rule,
  coalesce(CASE {_VERDICTS} END, CASE WHEN bad_low > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  round(bad_rate, 6) AS bad_rate, round(bad_low, 6) AS bad_low
FROM p JOIN x USING (host)
"""

QUERIES = {"op1_url_reputation": op1_url_reputation}
SQL = {"op1_url_reputation": OP1_SQL}
