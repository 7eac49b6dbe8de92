"""Text scans against the patterns as they are written, on generated texts."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stratalith.llm import histogram_shards, license_scan, packing, pii, secret_scan, simhash

LOWER = {c: c + 32 for c in range(65, 91)}
MAIL = st.text(st.sampled_from("ab@.é-_%+ \n@."), max_size=40)
DIGITS = st.text(st.sampled_from("0123456789 -.+()é"), max_size=60)
WORDS = st.lists(st.sampled_from(["mit", "license", "MIT", "License", "apache", "general", "public", "é", "x9", "-", ",", "\n"]), max_size=25)
KEYS = st.lists(st.sampled_from(["token", "API_KEY", "apikey", "=", ":", " ", "'", '"', "abcdef", "12", "AKIA", "Z" * 16, "0f" * 12, "é", "secret", "."]), max_size=20)


@settings(max_examples=300, deadline=None)
@given(MAIL)
def test_mail_addresses(text):
    want = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    data = text.encode()
    got = pii.code_points(data, [(a, 0, b) for a, b in pii.emails(data)])
    assert [(a, b) for a, _, b in got] == want


@settings(max_examples=300, deadline=None)
@given(DIGITS)
def test_numbers(text):
    data = text.encode()
    for pattern, own in ((r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", pii._IP), (r"[0-9]([\x20-]?[0-9])+", pii._CARD), (r"\+[0-9][\x20().0-9-]+[0-9]", pii._PHONE)):
        want = [m.span() for m in re.finditer(pattern, text)]
        assert [(a, b) for a, _, b in pii.code_points(data, [(m.start(), 0, m.end()) for m in own.finditer(data)])] == want


@settings(max_examples=200, deadline=None)
@given(WORDS, st.sampled_from([" ", "-", "", " é "]))
def test_licenses(words, mark):
    text = mark.join(words)
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOWER))
    starts = [i for p in license_scan.BASE_PHRASES for i in range(len(own)) if own[i : i + len(p.split())] == p.split()]
    n_words, n_base, first, last, *_ = license_scan.scan_text(text.encode())
    assert (n_words, n_base, first, last) == (len(own), len(starts), min(starts, default=None), max(starts, default=None))


@settings(max_examples=200, deadline=None)
@given(st.lists(KEYS.map("".join), max_size=4))
def test_secrets(texts):
    for text, spans in zip(texts, secret_scan.spans_of([t.encode() for t in texts]), strict=True):
        want = []
        for k, rule in enumerate(secret_scan.RULES):
            for m in re.finditer(rule.pattern.decode(), text):
                if len(m[2]) >= 6 if rule.kind == "assign" else len(m[0]) >= 20 if rule.kind == "access" else True:
                    want.append((m.start(), k, m.end()))
        assert spans == sorted(want)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=30))
def test_packing_keeps_all(histogram):
    patterns = packing.pack_histogram(histogram, 64)
    made: dict = {}
    for count, lengths in patterns:
        assert count > 0 and sum(lengths) <= 64
        for n in lengths:
            made[n] = made.get(n, 0) + count
    assert made == histogram
    places = packing.place_entries(patterns)
    for n, total in histogram.items():
        taken = sorted((r, r + c) for length, r, c, _, _ in places if length == n)
        assert taken[0][0] == 0 and taken[-1][1] == total and all(a[1] == b[0] for a, b in zip(taken, taken[1:], strict=False))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 255), min_size=1, max_size=60), st.integers(0, 3))
def test_tree_splits_lose_no_pair(values, radius):
    fps = np.array(values, np.uint64)
    tree = simhash.grow(fps, np.uint64(255), radius, 3, np.random.default_rng(1))
    together = set()
    for _, at in simhash.route(fps, tree, np.uint64(255), radius):
        together |= {(i, j) for i in at.tolist() for j in at.tolist()}
    assert {i for i, _ in together} == set(range(len(fps)))
    for i in range(len(fps)):
        for j in range(len(fps)):
            if int(fps[i] ^ fps[j]).bit_count() <= radius:
                assert (i, j) in together


def test_probe_counts_are_exact(spark):
    rows = spark.range(500).selectExpr("id % 9 AS h", "id % 50 AS d", "1 + id % 7 AS size")
    keys = sorted((r.h * 64 + r.d, r["size"]) for r in rows.collect())
    probes = [1, 64, 65, 200, 300, 511, 576]
    n, b = histogram_shards.count_below(rows, probes, 6, 0)
    assert list(n) == [sum(k < p for k, _ in keys) for p in probes]
    assert list(b) == [sum(s for k, s in keys if k < p) for p in probes]
