"""Operator 11 against plain integer clustering, and how much its balls spare."""

import hashlib
import math

import numpy as np
import pytest

from stratalith.llm import centroids
from stratalith.llm.centroids import cluster_vectors, grow_tree, nearest_in, op11_centroids


def brute(rows, k, rounds, scale, dimensions):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest())
    middle = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(middle))
    for _ in range(rounds):
        own = [[] for _ in middle]
        for _, v in kept:
            own[near(v)[1]].append(v)
        middle = [[sum(x) // len(vs) for x in zip(*vs, strict=True)] if vs else c for vs, c in zip(own, middle, strict=True)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=str), middle


def made(spark, rows, dimensions=4, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, distance int, cluster string")
    found, middle = cluster_vectors(df, k=5, rounds=3, dimensions=dimensions, scale=64, **more)
    return sorted((tuple(r) for r in found.collect()), key=str), middle.tolist()


@pytest.mark.parametrize("parts", [1, 3])
def test_is_plain_clustering(spark, parts):
    rng = np.random.default_rng(parts)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=4) + (i % 3))], 0, "x") for i in range(400)]
    rows += [(1000 + i, [0.5, -0.5, 0.25, 1.0], 0, "x") for i in range(200)]  # copies
    rows += [(7, rows[7][1], 0, "x"), (7, rows[9][1], 0, "x"), (None, rows[3][1], 0, "x")]  # repeated rows, repeated and null ids
    rows += [(5000, None, 0, "x"), (5001, [], 0, "x"), (5002, [1.0, None, 0.0, 0.0], 0, "x"), (5003, [float("nan")] * 4, 0, "x"), (5004, [float("-inf")] * 4, 0, "x"), (5005, [1.0] * 5, 0, "x")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "150")
    try:
        got, middle = made(spark, rows, dimensions=4)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, centres = brute([r[:2] for r in rows], 5, 3, 64, 4)
    assert got == want
    assert middle == centres


def test_few_and_no_vectors(spark):
    assert made(spark, []) == ([], [])
    assert made(spark, [(3, [1.0, 2.0, 3.0, 4.0], 0, "x")]) == ([(3, 0, 0)], [[64, 128, 192, 256]])
    assert made(spark, [(3, None, 0, "x")]) == ([], [])


def test_ties_take_the_smaller_number(spark):
    tree, _ = grow_tree(np.array([[0, 0], [2, 0], [4, 0]]))
    n, sums, chosen, _ = nearest_in(tree, np.array([[4, 0], [0, 0]]), each=True)
    assert dict(zip(map(tuple, tree.vectors.tolist()), chosen.tolist(), strict=True)) == {(0, 0): 1, (2, 0): 0, (4, 0): 0}
    assert n.tolist() == [2, 1] and sums.tolist() == [[6, 0], [0, 0]]


def test_values_beyond_the_bound_raise(spark):
    with pytest.raises(Exception, match="beyond"):
        made(spark, [(3, [1e30, 2.0, 3.0, 4.0], 0, "x")])


def test_far_vectors_keep_trees_flat():
    points = np.zeros((2000, 3), np.int64)
    points[:, 0] = np.minimum(2 ** (np.arange(2000) % 27), 1 << 26)
    points[:, 1] = np.arange(2000)
    tree, order = grow_tree(points)
    assert sorted(order.tolist()) == list(range(2000)) and (tree.vectors == points[order]).all()
    assert len(tree.first) < 2000 and tree.sums[0].tolist() == points.sum(axis=0).tolist()


def test_balls_go_whole():
    """In groups apart, nearly all vectors go with their ball."""
    rng = np.random.default_rng(3)
    middle = rng.integers(-500, 500, (16, 64))
    points = middle[rng.integers(0, 16, 8000)] + rng.integers(-8, 9, (8000, 64))
    _, _, chosen, compared = nearest_in(grow_tree(points)[0], middle, each=True)
    assert compared < 400


def test_query_is_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    found = op11_centroids(spark, sf)
    want = con.sql(f"SELECT {', '.join(found.columns)} FROM ({centroids.SQL['op11_centroids']})").fetchall()
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
