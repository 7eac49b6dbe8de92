"""Operator 4: secret scan over a trigram inverted index.

Each rule is a regular expression. From its parse tree a Boolean query over trigrams is derived: text
that can match holds the trigrams that the query asks for. Every Arrow batch is indexed like a segment
of a search engine: the postings of all trigrams that any rule asks for are built at once, queries are
answered by intersecting and uniting postings, and a rule's expression runs over the whole text of its
candidates alone. A rule without mandatory trigrams runs over every text. The index lives in the task,
so no rows are shuffled and a lost executor costs its batches alone.

Trigrams are taken from the text with A-Z lower-cased, so one index serves rules in either case.

Nulls, empties: a null text counts as empty; a document without a find has counts 0, the SHA-256 of the
empty string and empty spans. Equal rows give equal results.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import LOWER_ASCII, map_arrow, table

try:
    from re import _constants as sre
    from re import _parser as sre_parse
except ImportError:  # before Python 3.11
    import sre_constants as sre
    import sre_parse

#: Most strings that a literal set of the derivation holds before it is reduced to a query.
MOST_LITERALS = 64


@dataclass(frozen=True)
class Rule:
    """``keep`` decides on a match; base rules are counted and hashed, the method's come on top."""

    kind: str
    pattern: bytes
    keep: Callable[[re.Match], bool]
    base: bool = False


def either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_KEYWORD = "|".join(map(either_case, ("password", "passwd", "secret", "token"))) + "|" + either_case("api") + "_?" + either_case("key")
RULES = (
    Rule("assign", rf"""({_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".encode(), lambda m: len(m[2]) >= 6, True),
    Rule("access", rb"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20, True),
    # As [0-9a-f]+ of 24 or more: the first place from which 24 go is where a run begins.
    Rule("hex", rb"[0-9a-f]{24,}", lambda m: True, True),
    Rule("private_key", rb"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", lambda m: True),
    Rule("webtoken", rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", lambda m: True),
    Rule("bearer", rb"[Bb]earer\x20+[A-Za-z0-9._~+/-]{20,}=*", lambda m: True),
    Rule("code_host", rb"gh[pousr]_[A-Za-z0-9]{36,}", lambda m: True),
    Rule("chat", rb"xox[abprs]-[A-Za-z0-9-]{10,}", lambda m: True),
)

# A query is True (all texts), a trigram (bytes), or ("and" | "or", queries).
Query = object


def all_of(parts: list) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def any_of(parts: list) -> Query:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def literal_query(strings: set[bytes]) -> Query:
    """What a text holds that contains one of the strings."""
    return any_of([all_of([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def trigram_query(pattern: bytes) -> Query:
    """The Boolean trigram query of a regular expression, over lower-cased text."""

    def alternatives(items: list) -> set[bytes] | None:
        """The strings that a set of characters stands for, if few."""
        found: set[bytes] = set()
        for op, value in items:
            if op is sre.LITERAL:
                found.add(bytes([value]).translate(LOWER_ASCII))
            elif op is sre.RANGE and value[1] - value[0] < 8:
                found |= {bytes([v]).translate(LOWER_ASCII) for v in range(value[0], value[1] + 1)}
            else:
                return None
        return found

    def exact(node: tuple) -> set[bytes] | None:
        """All strings that a node matches, None if too many."""
        op, value = node
        if op is sre.LITERAL:
            return {bytes([value]).translate(LOWER_ASCII)}
        if op is sre.IN:
            found = alternatives(value)
            return found if found and len(found) <= 8 else None
        if op is sre.SUBPATTERN:
            return exact_all(value[3])
        if op is sre.BRANCH:
            parts = [exact_all(p) for p in value[1]]
            return None if None in parts else set().union(*parts)
        if op is sre.MAX_REPEAT and value[1] <= 1:
            inner = exact_all(value[2])
            return None if inner is None else inner | ({b""} if value[0] == 0 else set())
        return None

    def exact_all(nodes: list) -> set[bytes] | None:
        found = {b""}
        for node in nodes:
            part = exact(node)
            if part is None or len(found) * len(part) > MOST_LITERALS:
                return None
            found = {a + b for a in found for b in part}
        return found

    def query(nodes: list) -> Query:
        """Runs of exact nodes give literals; other nodes give their own queries."""
        parts, run = [], {b""}
        for node in [*nodes, None]:
            part = exact(node) if node else None
            if part is not None and len(run) * len(part) <= MOST_LITERALS:
                run = {a + b for a in run for b in part}
                continue
            parts.append(literal_query(run))
            run = part if part is not None else {b""}
            if node and part is None:
                op, value = node
                if op is sre.SUBPATTERN:
                    parts.append(query(value[3]))
                elif op is sre.BRANCH:
                    parts.append(any_of([query(p) for p in value[1]]))
                elif op is sre.MAX_REPEAT and value[0] >= 1:
                    parts.append(query(value[2]))
        return all_of(parts)

    return query(list(sre_parse.parse(pattern)))


def trigrams_of(query: Query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(trigrams_of, query[1]))


@cache
def plan() -> tuple[list, dict[bytes, int], np.ndarray]:
    """Compiled rules with queries, the number of each trigram, and a table from code to number + 1."""
    rules = [(rule, re.compile(rule.pattern), trigram_query(rule.pattern)) for rule in RULES]
    numbers = {t: k for k, t in enumerate(sorted(set().union(*(trigrams_of(q) for _, _, q in rules))))}
    codes = np.zeros(1 << 24, np.uint8)
    for t, k in numbers.items():
        codes[t[0] << 16 | t[1] << 8 | t[2]] = k + 1
    assert len(numbers) < 255
    return rules, numbers, codes


def postings(texts: list[bytes]) -> dict[int, np.ndarray]:
    """Sorted numbers of the texts that hold each trigram asked for. Long inputs go in blocks."""
    _, _, codes = plan()
    found: dict[int, list[np.ndarray]] = {}
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) < 1 << 22):
            size += len(texts[upto]) + 1
            upto += 1
        joined = np.frombuffer(b"\n".join(texts[at:upto]).translate(LOWER_ASCII), np.uint8).astype(np.int32)
        ends = np.cumsum([len(t) + 1 for t in texts[at:upto]])
        if len(joined) > 2:
            hits = codes[joined[:-2] << 16 | joined[1:-1] << 8 | joined[2:]]
            places = np.flatnonzero(hits)
            owners = np.searchsorted(ends, places, "right") + at
            for pair in np.unique(hits[places].astype(np.int64) << 40 | owners):
                found.setdefault(int(pair >> 40) - 1, []).append(int(pair & ((1 << 40) - 1)))
        at = upto
    return {k: np.array(v) for k, v in found.items()}


def candidates(query: Query, index: dict[int, np.ndarray], n: int) -> np.ndarray:
    """Numbers of the texts that answer a query."""
    if query is True:
        return np.arange(n)
    if isinstance(query, bytes):
        return index.get(plan()[1][query], np.array([], int))
    sets = [candidates(q, index, n) for q in query[1]]
    out = sets[0]
    for other in sets[1:]:
        out = np.intersect1d(out, other) if query[0] == "and" else np.union1d(out, other)
    return out


def spans_of(texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
    """For each text its finds (start, rule number, end) in code points, by start, then rule."""
    rules, _, _ = plan()
    index = postings(texts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, expression, query) in enumerate(rules):
        for i in candidates(query, index, len(texts)).tolist():
            text = texts[i]
            for m in expression.finditer(text):
                if rule.keep(m):
                    found[i].append((m.start(), k, m.end()))
    return [in_code_points(text, sorted(spans)) for text, spans in zip(texts, found, strict=True)]


def in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Places of bytes as places of code points: bytes that do not continue a character."""
    if not spans or text.isascii():
        return spans
    before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(before[a]), k, int(before[b])) for a, k, b in spans]


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, and its finds as array of (kind, start, end, base)."""
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, found array<struct<kind: string, start: long, end: long, base: boolean>>"

    def work(ids: list, texts: list) -> list:
        spans = spans_of([t or b"" for t in texts])
        return [ids, [[{"kind": RULES[k].kind, "start": a, "end": b, "base": RULES[k].base} for a, k, b in s] for s in spans]]

    return map_arrow(docs.select(id_col, text_col), work, schema)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = "array_join(transform({}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    counts = [f"CAST(size(filter(found, x -> x.kind = '{k}')) AS BIGINT) AS n_{k}" for k in ("assign", "access", "hex")]
    return found.selectExpr(
        "doc_id",
        *counts,
        f"sha2({joined.format('filter(found, x -> x.base)')}, 256) AS base_sha256",
        f"{joined.format('found')} AS spans",
    )


QUERIES = {"op4_secret_scan": op4_secret_scan}
