"""Operator 12 against removal by definition."""

import random

import pytest

from stratalith.llm import substrings
from stratalith.llm.substrings import op12_substrings, remove_repeats, rolling, word_hashes


def brute(rows, window):
    import xxhash

    docs = sorted(((i is None, i or 0, xxhash.xxh3_64_intdigest((t or "").encode()), k) for k, (i, t) in enumerate(rows)))
    words = [(t or "").encode().split() for _, t in rows]
    seen, gone = set(), [set() for _ in rows]
    for *_, k in docs:
        for s in range(len(words[k]) - window + 1):
            w = tuple(words[k][s : s + window])
            if w in seen:
                gone[k].update(range(s, s + window))
            seen.add(w)
    out = []
    for k, (i, _) in enumerate(rows):
        out.append((i, len(words[k]), len(gone[k]), b" ".join(w for n, w in enumerate(words[k]) if n not in gone[k]).decode()))
    return sorted(out, key=str)


def made(spark, rows, window, block, parts=3):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, kept string, chunk int").repartition(parts)
    found = remove_repeats(df, window=window, block=block).collect()
    for r in found:
        assert r.n_removed == sum(s.past - s.first for s in r.removed)
        assert all(s.past - s.first >= window for s in r.removed)
    return sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in found), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_is_removal_by_definition(spark, seed):
    rng = random.Random(seed)
    window, block = rng.choice([(4, 2), (5, 3), (20, 10), (7, 3)])
    word = lambda: rng.choice(["a", "bb", "é", "ein-sehr-langes-wort", "longer-than-sixteen-bytes", "A"])
    passages = [" ".join(word() for _ in range(rng.randint(window, 3 * window))) for _ in range(6)]
    gap = lambda: rng.choice([" ", "\n", "\t ", "\x0b", "  "])
    rows = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.3 else " ".join(f"{word()}{rng.randint(0, 30)}" for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 6))]
        rows.append((i, gap().join(parts)))
    rows += [(rng.randint(0, 119), rows[5][1]) for _ in range(5)] + [rows[9], rows[9], (None, rows[3][1]), (None, None), (3, ""), (200, " \n ")]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rng.choice([7, 1000])))
    try:
        assert made(spark, rows, window, block) == brute(rows, window)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_repeat_overlaps_itself(spark):
    rows = [(1, "- " * 50), (2, "- " * 19), (3, "x " + "- " * 20), (4, "- " * 5000)]
    assert made(spark, rows, 20, 10) == brute(rows, 20)


def test_neighbours_are_not_joined(spark):
    """Words of one document and the next are no window, and their repeats are told apart."""
    text = " ".join(f"w{k}" for k in range(20))
    rows = [(1, text), (2, text), (3, text), (4, " ".join(f"w{k}" for k in range(10))), (5, " ".join(f"w{k}" for k in range(10, 20)))]
    assert made(spark, rows, 20, 10, parts=1) == brute(rows, 20)
    assert [r.removed for r in remove_repeats(spark.createDataFrame(rows[:3], "doc_id long, text string").coalesce(1)).sort("id").collect()] == [[], [(0, 20)], [(0, 20)]]


def test_empty_table_and_long_texts(spark):
    assert made(spark, [], 20, 10) == []
    long = " ".join(str(k) for k in range(200_000))
    rows = [(1, long), (2, "a b " + long + " c"), (3, "x" * 2_000_000)]
    assert [r[:3] for r in made(spark, rows, 20, 10)] == [(1, 200_000, 0), (2, 200_003, 200_000), (3, 1, 0)]


def test_a_window_holds_a_block(spark):
    with pytest.raises(ValueError, match="whole block"):
        remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), window=20, block=11)


def test_words_are_told_apart():
    import numpy as np

    words = [b"a", b"a\x00", b"\x00a", b"aaaaaaaa", b"aaaaaaaab", b"baaaaaaaa", b"a" * 16, b"a" * 17, b"a" * 18, "é".encode(), b"\xc2\xa0"]
    texts = [b" ".join(words), b"", b"x\ry", b"", b"z"]
    h, n = word_hashes(b"".join(texts), np.array([len(t) for t in texts]))
    assert n.tolist() == [len(words), 0, 2, 0, 1] and len(set(h.tolist())) == len(words) + 3
    for width in (1, 3, 10, 20):
        r = rolling(np.tile(h[:5], 10), width)
        assert len(r) == 51 - width and (r[:5] == r[5:10]).all() and len(set(r[:5].tolist())) == 5


def test_query_is_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    found = op12_substrings(spark, sf)
    want = con.sql(f"SELECT {', '.join(found.columns)} FROM ({substrings.SQL['op12_substrings']})").fetchall()
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
