"""Near-duplicates of the pipeline by sets of runs, against brute force."""

import random

import corpus_pipeline
from stratalith.llm import simhash


def runs(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def fresh(rng, n):
    return ["".join(rng.choice("abcdefghilmnorstu") for _ in range(7)) for _ in range(n)]


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").select("doc_id").collect()}


def test_near_copies_among_templates(spark, monkeypatch):
    """Documents of one template are alike by 0.77 and stay; the near copy of each goes."""
    monkeypatch.setattr(simhash, "TILE", 60)
    rng = random.Random(2)
    template, rows = fresh(rng, 400), []
    for k in range(120):
        words = template + fresh(rng, 59)
        rows.append((k, " ".join(words)))
        words[rng.randrange(400, 459)] = "changed"
        rows.append((1_000 + k, " ".join(words)))
    a, b, c = runs(rows[0][1]), runs(rows[1][1]), runs(rows[2][1])
    assert 0.75 < len(a & c) / len(a | c) < 0.8 < 0.9 < len(a & b) / len(a | b)
    assert kept(spark, rows) == set(range(120))


def test_near_copies_joined_by_false_candidates(spark):
    """A forest of candidates may join near copies only through a document that is like neither."""
    rng = random.Random(3)
    words = fresh(rng, 100)
    rows = [(1, " ".join(words)), (2, " ".join(fresh(rng, 100))), (3, " ".join([*words[:-1], "changed"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links = spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")
    found = simhash.verified_links(links, docs, id_col="doc_id", text_col="text", width=5, least=0.8).collect()
    assert {tuple(sorted(r)) for r in found} == {(1, 3)}


def test_pairs_at_the_limit(spark):
    """Copies with text added that share just 0.8 of their runs are found nearly all."""
    rng = random.Random(4)
    rows = []
    for k in range(150):
        words = fresh(rng, 204)
        rows += [(k, " ".join(words)), (1_000 + k, " ".join(words + fresh(rng, 50)))]
    a, b = runs(rows[0][1]), runs(rows[1][1])
    assert len(a & b) / len(a | b) == 0.8
    stay = kept(spark, rows)
    assert set(range(150)) <= stay
    assert sum(i >= 1_000 for i in stay) <= 3


def test_filler_makes_no_copies(spark):
    """Documents whose words differ stay, however often one run is repeated in each; equal sets of runs go."""
    rng = random.Random(5)
    rows = [(k, " ".join(fresh(rng, 200) + ["-"] * 300)) for k in range(5)]
    rows.append((9, rows[0][1] + " -" * 500))
    assert kept(spark, rows) == set(range(5))


def test_texts_that_share_an_id_stay(spark):
    """An id that stands for different texts keeps each of them once; one that repeats a text keeps it once."""
    rng = random.Random(6)
    a, b, c = (" ".join(fresh(rng, 60)) for _ in range(3))
    docs = spark.createDataFrame([(1, a), (1, b), (1, a), (2, c), (2, c), (2, c.upper()), (3, a), (None, a)], "doc_id long, text string")
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    texts = sorted((str(r.doc_id), r.text.lower()) for r in got)
    assert texts == sorted([("1", a), ("1", b), ("2", c), ("None", a)])
