"""SimHash groups, vector links and components against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratalith.llm import embedding_dedup, simhash
from stratalith.llm.common import connected_components

SF = "/root/testdata/sf0.01"
LOWER = {c: c + 32 for c in range(65, 91)}


def components_of(nodes, pairs):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        p, q = root(a), root(b)
        up[max(p, q)] = min(p, q)
    return {n: root(n) for n in nodes}


def expected_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, i) for i in range(2001, 2100)]
    edges = spark.createDataFrame([*pairs, (5, 5), (None, 3)], "a long, b long")
    got = {r.id: r.component_id for r in connected_components(edges).collect()}
    want = components_of({x for p in pairs for x in p}, pairs)
    assert {k: v for k, v in want.items() if k in got} == got
    assert all(want[k] == k for k in want.keys() - got.keys())


def test_components_without_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("size", [8_000, 60])
def test_simhash_is_brute_force(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(simhash, "SHARD_CLASSES", size)
    monkeypatch.setattr(simhash, "LEAF", 16)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(10_000, None), (10_001, ""), (10_002, " \t\n "), (10_003, "one"), (10_004, "ONE"), (10_005, "x y " * 40_000), (10_006, "one"), (10_007, "a b")]
    docs = docs.union(spark.createDataFrame(rows, "doc_id long, text string")).withColumns({"fps": F.lit(1), "component_id": F.lit("z")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = simhash.op6_simhash(spark, str(tmp_path)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {k: expected_fingerprint(t) for k, t in texts.items()}
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == want
    assert all(len(r.fingerprint) == 16 for r in got)
    ids = sorted(want)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (want[a] ^ want[b]).bit_count() <= 3]
    assert {r.doc_id: r.component_id for r in got} == components_of(ids, pairs)


@pytest.mark.parametrize(("radius", "blocks"), [(3, 2), (7, 4), (3, 1)])
def test_trees_lose_no_pair(spark, monkeypatch, radius, blocks):
    monkeypatch.setattr(simhash, "SHARD_CLASSES", 100)
    monkeypatch.setattr(simhash, "LEAF", 8)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 120, np.uint64)
    fps = {int(x) for x in base}
    for x in base:
        for _ in range(5):
            for b in rng.choice(64, rng.integers(1, radius + 2), replace=False):
                x ^= np.uint64(1) << np.uint64(b)
            fps.add(int(x))
    fps = sorted(fps)
    classes = spark.createDataFrame([(i, [simhash.signed(x)]) for i, x in enumerate(fps)], "rep long, fps array<long>")
    links = [(r.a, r.b) for r in simhash.near_links(classes, radius=radius, blocks=blocks).collect()]
    assert all((fps[a] ^ fps[b]).bit_count() <= radius for a, b in links)
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= radius]
    assert components_of(range(len(fps)), links) == components_of(range(len(fps)), pairs)


def test_shards_that_no_point_parts(spark, monkeypatch):
    """Fingerprints alike on a part are cut into chunks; each two chunks are compared."""
    monkeypatch.setattr(simhash, "SHARD_CLASSES", 50)
    monkeypatch.setattr(simhash, "LEAF", 8)
    rng = np.random.default_rng(8)
    fps = sorted({int(x) << 32 | 5 for x in rng.integers(0, 1 << 31, 300)} | {(1 << int(a)) | (1 << int(b)) | 5 for a, b in rng.integers(32, 64, (300, 2))})
    classes = spark.createDataFrame([(i, [simhash.signed(x)]) for i, x in enumerate(fps)], "rep long, fps array<long>")
    links = [(r.a, r.b) for r in simhash.near_links(classes).collect()]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    assert len(pairs) > len(fps)
    assert components_of(range(len(fps)), links) == components_of(range(len(fps)), pairs)


def test_hot_classes_join_apart(spark):
    from stratalith.llm.common import join_classes

    rows = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 200}") for i in range(1_000)] + [(5_000, None), (5_001, "none")], "id long, key string")
    classes = rows.where("id < 5000").groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("rep"))
    got = {r.id: r.rep for r in join_classes(rows, classes, key="key", size="n").collect()}
    assert got == {**{i: 1 if i % 2 else i % 200 for i in range(1_000)}, 5_000: None, 5_001: None}


def vectors(spark, rng, n, clusters):
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(n)]
    for size in clusters:
        centre = rng.standard_normal(16)
        rows += [(len(rows) + i, (centre + rng.standard_normal(16) * 0.05).tolist()) for i in range(size)]
    rows += [(len(rows) + i, rows[3][1]) for i in range(40)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    rows += [(len(rows) + i, v) for i, v in enumerate(bad)]
    return rows


@pytest.mark.parametrize(("window", "clusters"), [(256, [30, 5]), (8, [40, 3])])
def test_vectors_are_brute_force(spark, window, clusters):
    rows = vectors(spark, np.random.default_rng(11), 400, clusters)
    table = spark.createDataFrame([(i, v, 0, "z") for i, v in rows], "vec_id long, embedding array<double>, rep int, size string")
    got = {r.vec_id: r for r in embedding_dedup.dedup_vectors(table, window=window).collect()}
    fine = {i: np.array(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    cosine = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b))
    pairs = [(i, j) for i in fine for j in fine if j < i and len(fine[i]) == len(fine[j]) and cosine(fine[i], fine[j]) >= 0.95]
    degree = {i: 0 for i, _ in rows}
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    found = sum(min(got[i].n_links, degree[i]) for i in degree)
    assert all(got[i].n_links <= degree[i] for i in degree)
    assert found >= 0.97 * sum(degree.values())
    want = components_of(degree, pairs)
    assert sum(got[i].component_id == want[i] for i in degree) >= 0.98 * len(degree)
    assert all(got[i].kept == (got[i].component_id == i) for i in degree)


@pytest.mark.parametrize(("tile", "window", "n"), [(8192, 256, 5_000), (64, 16, 500)])
def test_dense_clusters_and_topics_keep_their_links(spark, monkeypatch, tile, window, n):
    """A cluster of copies that no window holds, and a topic of vectors that are near but not linked, with
    planted pairs: levels widen where they must, in groups of bounded rows."""
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rng = np.random.default_rng(12)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    noise = lambda k: unit(rng.standard_normal((k, 32)))
    centre, other = noise(2)
    topic = unit(np.sqrt(0.88) * centre + np.sqrt(0.12) * noise(n // 2))
    copies = unit(other + 0.1 * noise(n))
    planted = unit(topic[: n // 5] + 0.29 * noise(n // 5))
    x = np.vstack([noise(n // 2), topic, copies, planted])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.dedup_vectors(table, window=window).collect()}
    links = np.concatenate([(x[k : k + 500] @ x.T >= 0.95).sum(axis=1) - 1 for k in range(0, len(x), 500)])
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= links).all()
    own = slice(n, 2 * n)
    # windows of the query's width find all; of narrow ones the law's share may be missed
    assert links[own].min() > window and found[own].sum() >= (1 if window == 256 else 1 - embedding_dedup.MISSED) * links[own].sum()
    pairs = [*range(n // 2, n), *range(2 * n, len(x))]
    assert links[pairs].sum() > n // 5 and found[pairs].sum() >= 0.97 * links[pairs].sum()


@pytest.mark.parametrize(("run", "name", "schema"), [
    (simhash.op6_simhash, "documents", "doc_id long, text string"),
    (embedding_dedup.op7_embedding_dedup, "embeddings", "vec_id long, embedding array<float>"),
])
def test_empty_tables(spark, tmp_path, run, name, schema):
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert run(spark, str(tmp_path)).collect() == []
