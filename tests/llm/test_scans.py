"""Licences, secrets, packing and sharding against brute force on small tables and edge cases."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalith.llm import histogram_shards, license_scan, packing, secret_scan

SF = "/root/testdata/sf0.01"
LOWER = {c: c + 32 for c in range(65, 91)}
EDGES = [
    (1, None),
    (2, ""),
    (3, "MIT License mit license, MIT-license"),
    (4, "İ MİT License ſecret: abcdefgh"),
    (5, "x" * 300_000 + " SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\n"),
    (5, "repeat"),
    (None, 'API_KEY="abc123def" é token = abc é AKIA' + "A1" * 8 + " deadbeef" * 3),
    (7, "é" * 40 + "password:hunter22secret=zzzzzz " + "0123456789abcdef" * 2),
]


def edges(spark):
    rows = [(i, t, "clash", 1, "z") for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, h int, length string")


def expected_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in license_scan.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_license_scan_is_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(edges(spark).select("doc_id", "text"))
    texts = docs.collect()
    got = license_scan.scan_licenses(docs).collect()
    assert len(got) == len(texts)
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted((key((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got), key=str) == sorted(
        (key((r.doc_id, *expected_license(r.text))) for r in texts), key=str
    )
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1 for r in got)
    assert {r.labels for r in got if r.doc_id == 5} >= {"apache,bsd,mit", ""}


@pytest.mark.parametrize(
    ("expression", "labels", "share"),
    [
        ("mit", {"mit"}, 1.0),
        ("mit or apache-2.0 and gpl-3.0-only", {"mit", "apache", "gpl"}, 1.0),
        ("(mit or nosuch) and bsd-2-clause", {"mit", "bsd"}, 1.0),
        ("mit and nosuch", {"mit"}, 0.0),
        ("gpl-2.0 with classpath-exception-2.0", {"gpl"}, 1.0),
        ("mit and", set(), 0.0),
        ("(mit", set(), 0.0),
        ("mit) or (bsd", set(), 0.0),
        ("", set(), 0.0),
    ],
)
def test_expressions(expression, labels, share):
    assert license_scan.evaluate(expression) == (frozenset(labels), share)


def test_postfix_keeps_precedence():
    assert license_scan.postfix("a or b and c with d") == ["a", "b", "c", "d", "with", "and", "or"]
    assert license_scan.postfix("(a or b) and c") == ["a", "b", "or", "c", "and"]


KEYWORDS = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"


def expected_secrets(text):
    text, found = text or "", []
    for k, (kind, pattern, least) in enumerate(
        [
            ("assign", KEYWORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
            ("access", r"AKIA[A-Z0-9]+", 20),
            ("hex", r"[0-9a-f]+", 24),
        ]
    ):
        for m in re.finditer(pattern, text):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    spans = [s for _, _, s in sorted(found)]
    return [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")], spans


def test_secret_scan_is_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(edges(spark).select("doc_id", "text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, ((r.doc_id, [r.n_assign, r.n_access, r.n_hex], r.base_sha256) for r in secret_scan.op4_secret_scan(spark, str(tmp_path)).collect())))
    want = sorted(
        map(str, ((r.doc_id, n, hashlib.sha256(",".join(s).encode()).hexdigest()) for r in docs.collect() for n, s in [expected_secrets(r.text)]))
    )
    assert got == want


def test_secret_rules_of_the_method(spark):
    text = "-----BEGIN RSA PRIVATE KEY----- Bearer " + "Ab9_" * 6 + " ghp_" + "a1B2" * 9
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [f.kind for f in secret_scan.scan_secrets(docs).first().found] == ["private_key", "bearer", "code_host"]


def test_trigram_queries_are_mandatory():
    assert secret_scan.trigram_query(b"[0-9a-f]{24,}") is True
    assert secret_scan.trigram_query(b"abcd|xyz") == ("or", (("and", (b"abc", b"bcd")), b"xyz"))
    rng = np.random.default_rng(1)
    for rule, expression, query in secret_scan.plan()[0]:
        texts = [b"xx " + t + b" yy" for t in (b"SeCrEt = 'abcdefg'", b"AKIA" + b"Z" * 20, b"api_key:0000000", b"nothing", bytes(rng.integers(32, 127, 500, np.uint8)))]
        index = secret_scan.postings(texts)
        found = set(secret_scan.candidates(query, index, len(texts)).tolist())
        assert {i for i, t in enumerate(texts) if expression.search(t)} <= found, rule.kind


def test_packing_places_every_token_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(edges(spark).selectExpr("doc_id + 100000", "text"))
    marked = [(200_000, "hello <|endoftext|> world"), (200_001, "<|endoftext|>"), (200_002, " <|endoftext|><|endoftext|>\n<|endoftext"), (200_003, "a  <|endoftext|>  b")]
    docs = docs.union(spark.createDataFrame(marked, "doc_id long, text string"))
    got = packing.pack_documents(docs.withColumn("offset", F.lit(1))).collect()
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for r in docs.where("doc_id IS NULL OR doc_id <> 100005").collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for piece in sorted(by_doc[r.doc_id], key=lambda p: p.start):
            assert (piece.start, piece.doc_tokens) == (at, len(ids))
            assert piece.ids_crc32 == zlib.crc32(ids[at : at + piece.length].tobytes())
            at += piece.length
        assert at == len(ids)
    total = padded = 0
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda p: p.offset):
            assert piece.offset == at
            at += piece.length
        assert at <= packing.SEQUENCE
        total += at
        padded += packing.SEQUENCE
    assert total / padded > 0.98


@pytest.mark.parametrize("histogram", [{}, {1: 5000}, {2048: 3, 1025: 7, 1023: 9, 1: 2}, {100: 1000, 1500: 3}])
def test_histogram_packs_whole(histogram):
    patterns = packing.pack_histogram(histogram, 2048)
    made: dict = {}
    for count, lengths in patterns:
        assert sum(lengths) <= 2048
        for length in lengths:
            made[length] = made.get(length, 0) + count
    assert made == histogram
    used = sum(k * v for k, v in histogram.items())
    assert sum(c for c, _ in patterns) <= -(-used // 1024) + 1


def test_ranks_cross_buckets(spark):
    pieces = spark.range(500).selectExpr("id AS doc_id", "0L AS start", "CAST(500 + id % 3 AS BIGINT) AS length")
    got = packing.pack_pieces(pieces, order=("doc_id", "start")).collect()
    assert len(got) == len({(r.sequence_id, r.offset) for r in got}) == 500


def expected_shards(rows):
    rows = sorted(rows, key=lambda r: (r.h, r.d))
    total, before, out, slots = sum(r.size for r in rows), 0, {}, {}
    for r in rows:
        shard = before * histogram_shards.SHARDS // total
        out[(r.h, r.d)] = (shard, slots.setdefault(shard, 0))
        slots[shard] += 1
        before += r.size
    return out


@pytest.mark.parametrize("range_rows", [1_000_000, 5])
def test_shards_are_the_sorted_ones(spark, range_rows):
    hot = spark.range(300).selectExpr("id AS d", "77L AS h", "50L AS size")
    rest = spark.range(400).selectExpr("1000 + id AS d", "pmod(xxhash64(id), 1000000L) AS h", "1 + id % 40 AS size")
    rows = hot.union(rest).repartition(5)
    got = {(r.h, r.d): (r.shard, r.slot) for r in histogram_shards.shard_by_bytes(rows, range_rows=range_rows).collect()}
    assert got == expected_shards(rows.collect())


def test_shards_within_tolerance(spark):
    """Fewer rounds, shards equal in bytes but for the tolerance and a row; numbers stay gapless."""
    rows = spark.range(20_000).selectExpr("id AS d", "pmod(xxhash64(id), 1L << 58) AS h", "1 + id % 40 AS size").cache()
    got = histogram_shards.shard_by_bytes(rows, shards=10, range_rows=700, tolerance=0.01).groupBy("shard").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots")
    ).collect()
    each = rows.agg(F.sum("size")).first()[0] / 10
    assert len(got) == 10
    assert all(abs(r.bytes - each) <= 0.01 * each + 80 and r.n == r.slots == r.last + 1 for r in got)


def test_rows_without_ids_are_split(spark, tmp_path):
    spark.range(3_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'one text' AS text").write.parquet(f"{tmp_path}/documents.parquet")
    got = histogram_shards.op9_histogram_shards(spark, str(tmp_path)).groupBy("shard").count().collect()
    assert len(got) == 40 and max(r["count"] for r in got) - min(r["count"] for r in got) <= 1


def test_shards_of_edges(spark, tmp_path):
    edges(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = histogram_shards.op9_histogram_shards(spark, str(tmp_path)).collect()
    assert len(got) == len(EDGES)
    assert {(r["size"], r.text_crc32) for r in got} == {(len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in EDGES}
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("run", [secret_scan.op4_secret_scan, license_scan.op3_license_scan, packing.op2_packing, histogram_shards.op9_histogram_shards])
def test_empty_tables(spark, tmp_path, run):
    edges(spark).where("doc_id = 99").write.parquet(f"{tmp_path}/documents.parquet")
    assert run(spark, str(tmp_path)).collect() == []


def test_repeated_rows_are_ranked_in_many_buckets(spark):
    """Rows alike in id and text have turns of their own, so they share no bucket."""
    docs = spark.range(2_000).selectExpr("7L AS doc_id", "'the same text' AS text")
    pieces = packing.token_pieces(docs, id_col="doc_id", text_col="text", size=2048, end_token=1, vocabulary="byte_bpe_50k.json")
    assert pieces.select("turn").distinct().count() >= 250
    got = packing.pack_documents(docs).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 2_000


def test_rows_that_repeat_are_split(spark, tmp_path):
    """A third of all rows are one row: shards stay near equal in bytes."""
    rest = spark.range(2_000).selectExpr("id AS doc_id", "repeat(md5(CAST(id AS STRING)), 1 + CAST(id % 4 AS INT)) AS text")
    rest.unionByName(spark.range(1_000).selectExpr("CAST(7 AS BIGINT) AS doc_id", "repeat('one text ', 14) AS text")).write.parquet(f"{tmp_path}/documents.parquet")
    found = histogram_shards.op9_histogram_shards(spark, str(tmp_path))
    got = found.groupBy("shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("slot").alias("last"), F.count_distinct("slot").alias("slots")).collect()
    mean = sum(r.bytes for r in got) / 40
    assert len(got) == 40 and all(abs(r.bytes - mean) <= 0.001 * mean + 160 and r.n == r.slots == r.last + 1 for r in got)
