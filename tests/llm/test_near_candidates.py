"""The pipeline's near-dedup takes its candidates from SimHash fingerprints and vantage-point trees."""

import random

import corpus_pipeline
from stratalith.llm import simhash


def fresh(rng, n):
    return ["".join(rng.choice("abcdefghilmnorstu") for _ in range(7)) for _ in range(n)]


def test_candidates_come_from_the_trees(spark, monkeypatch):
    """Pairs that share 0.8 of their runs, of few and of many words, are links of the trees; unlike ones are not."""
    seen = []
    trees = simhash.near_links

    def watched(classes, **how):
        links = trees(classes, **how)
        seen.append({tuple(sorted((r.a, r.b))) for r in links.collect()})
        return links

    monkeypatch.setattr(simhash, "near_links", watched)
    rng = random.Random(11)
    rows = []
    for k in range(60):
        words = fresh(rng, 24 if k % 2 else 204)
        rows += [(k, " ".join(words)), (1_000 + k, " ".join(words + fresh(rng, 5 if k % 2 else 50)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stay = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").select("doc_id").collect()}
    planted = {(k, 1_000 + k) for k in range(60)}
    assert len(seen) == 1 and len(planted & seen[0]) >= 59
    assert len(seen[0] - planted) <= 3
    assert set(range(60)) <= stay and sum(i >= 1_000 for i in stay) <= 1
