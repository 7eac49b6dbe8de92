"""Operator 11: centroid clustering over whole numbers, with partition-local ball trees that take whole balls to a centroid.

Vectors become whole numbers, floor(``SCALE`` * x). Each batch of a partition grows one metric tree: a ball has its
middle, radius, count and the exact sum of its vectors, and is halved around two far vectors until it holds ``LEAF``
vectors or copies of one. Trees are written once and read in each round. From the root down a ball keeps the centroids
that can be nearest to any vector in it: those whose distance from the middle is not over the least one by two radii or
more (triangle inequality, with a margin above the rounding of floats, so ties are never cut). A ball left with one
centroid adds its count and sum as a whole; leaves compare their vectors with the centroids left, exactly.

A round sends one partial sum for each tree and centroid, added up in Spark; the driver sees k rows. Nothing else grows
with the data there. A task holds one tree, of one Arrow batch.

Defined results: vectors that are null, of another length than the dimensions, or that hold null or non-finite
components are left out. Rows without an id are assigned, but are drawn as first centroids only after all with one.
Repeated rows are vectors of their own; of vectors with one id the smaller one by components is drawn first.
Fewer vectors than k give fewer centroids; an empty table gives no rows. Components are exact up to ``MOST`` after
scaling, beyond which distances leave 64 bits: such a vector raises.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_type, discard, in_batches, materialize, table

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 16, 3, 64, 64, 1
LEAF = 24
LEAST_SHARE = 0.05
MOST = 1 << 27

_TREE = "ids binary, missing binary, vectors binary, first binary, past binary, left binary, right binary, counts binary, sums binary, radii binary"


@dataclass
class Tree:
    """Vectors in the order of the leaves, and its balls: ranges of vectors, children (-1: a leaf), counts, sums, radii."""

    vectors: np.ndarray
    first: np.ndarray
    past: np.ndarray
    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray
    sums: np.ndarray
    radii: np.ndarray


def grow_tree(vectors: np.ndarray, leaf: int = LEAF) -> tuple[Tree, np.ndarray]:
    """The ball tree over integer rows, and the place in ``vectors`` of each of its rows."""
    points = vectors.astype(np.float64)
    order = np.arange(len(vectors))
    first, past, left, right, radii = [0], [len(vectors)], [-1], [-1], [0.0]
    todo = [0]
    while todo:
        ball = todo.pop()
        a, z = first[ball], past[ball]
        own = points[order[a:z]]
        away = ((own - own.mean(axis=0)) ** 2).sum(axis=1)
        radii[ball] = float(np.sqrt(away.max()))
        if z - a <= leaf or (own == own[0]).all():
            continue
        one = own[away.argmax()]
        near_one = ((own - one) ** 2).sum(axis=1)
        other = own[near_one.argmax()]
        nearer = near_one - ((own - other) ** 2).sum(axis=1)
        goes = nearer <= 0
        if not LEAST_SHARE <= goes.mean() <= 1 - LEAST_SHARE:  # a few far vectors: halves instead, so trees stay flat
            goes = np.zeros(z - a, bool)
            goes[np.argpartition(nearer, (z - a) // 2)[: (z - a) // 2]] = True
        order[a:z] = np.concatenate([order[a:z][goes], order[a:z][~goes]])
        middle = a + int(goes.sum())
        for side, (b, e) in ((left, (a, middle)), (right, (middle, z))):
            side[ball] = len(first)
            todo.append(len(first))
            first.append(b)
            past.append(e)
            left.append(-1)
            right.append(-1)
            radii.append(0.0)
    first, past = np.array(first, np.int64), np.array(past, np.int64)
    ordered = vectors[order]
    below = np.vstack([np.zeros((1, vectors.shape[1]), np.int64), np.cumsum(ordered, axis=0)])
    return Tree(ordered, first, past, np.array(left, np.int64), np.array(right, np.int64), past - first, below[past] - below[first], np.array(radii)), order


def nearest_in(tree: Tree, centroids: np.ndarray, *, each: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, int]:
    """(counts, sums) for each centroid, the nearest centroid of each vector if ``each``, and how many vectors were compared one by one."""
    k = len(centroids)
    n, sums = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
    chosen = np.empty(len(tree.vectors), np.int64) if each else None
    centres = tree.sums / tree.counts[:, None]
    far = np.sqrt(np.stack([((centres - c) ** 2).sum(axis=1) for c in centroids.astype(np.float64)], axis=1))
    scale = 1 + float(np.abs(centres).max(initial=0)) + float(np.abs(centroids).max(initial=0))
    margin = 1e-9 * scale * centroids.shape[1]
    lengths = (centroids * centroids).sum(axis=1)
    compared = 0
    todo = [(0, np.arange(k))] if len(tree.vectors) else []
    while todo:
        ball, left = todo.pop()
        d = far[ball, left]
        left = left[d - d.min() <= 2 * tree.radii[ball] + margin]
        a, z = tree.first[ball], tree.past[ball]
        if len(left) == 1:
            n[left[0]] += tree.counts[ball]
            sums[left[0]] += tree.sums[ball]
            if chosen is not None:
                chosen[a:z] = left[0]
        elif tree.left[ball] >= 0:
            todo += [(tree.left[ball], left), (tree.right[ball], left)]
        else:
            own = tree.vectors[a:z]
            compared += z - a
            # |v - c|^2 but for |v|^2, in whole numbers; argmin takes the smaller number of ties
            best = left[(lengths[left] - 2 * (own @ centroids[left].T)).argmin(axis=1)]
            np.add.at(n, best, 1)
            np.add.at(sums, best, own)
            if chosen is not None:
                chosen[a:z] = best
    return n, sums, chosen, compared


def _packed(array: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(array, kind).tobytes()


def plant(vectors: DataFrame, *, id_col: str, vector_col: str, dimensions: int, scale: int, tag: str = "balls") -> DataFrame:
    """A written table of trees, one row for each batch of vectors with ``dimensions`` finite components."""
    arrow = arrow_type(_TREE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(scale * flat.reshape(batch.num_rows, dimensions))
            if np.abs(whole).max() > MOST:
                raise ValueError(f"a component is beyond {MOST} after scaling: squared distances would leave 64 bits")
            tree, order = grow_tree(whole.astype(np.int64))
            missing = np.asarray(batch.column(0).is_null())[order]
            ids = np.asarray(batch.column(0).fill_null(0))[order]
            row = [
                _packed(ids, np.int64), _packed(missing, np.uint8), _packed(tree.vectors, np.int32), _packed(tree.first, np.int32), _packed(tree.past, np.int32),
                _packed(tree.left, np.int32), _packed(tree.right, np.int32), _packed(tree.counts, np.int64), _packed(tree.sums, np.int64), _packed(tree.radii, np.float64),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([b], f.type) for b, f in zip(row, arrow, strict=True)], schema=arrow)

    kept = kept_vectors(vectors, id_col=id_col, vector_col=vector_col, dimensions=dimensions)
    return materialize(in_batches(kept).mapInArrow(run, _TREE), tag)


def kept_vectors(vectors: DataFrame, *, id_col: str, vector_col: str, dimensions: int) -> DataFrame:
    """(id, vector) of vectors with all components there and finite."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.where((F.size(vector_col) == dimensions) & finite)
    return kept.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))


def _trees(batch: pa.RecordBatch, dimensions: int) -> Iterator[tuple[np.ndarray, np.ndarray, Tree]]:
    kinds = (np.int64, np.uint8, np.int32, np.int32, np.int32, np.int32, np.int32, np.int64, np.int64, np.float64)
    for i in range(batch.num_rows):
        ids, missing, vectors, *rest = (np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(batch.columns, kinds, strict=True))
        first, past, left, right, counts, sums, radii = rest
        yield ids, missing, Tree(vectors.reshape(-1, dimensions).astype(np.int64), first, past, left, right, counts, sums.reshape(-1, dimensions), radii)


def first_centroids(vectors: DataFrame, *, id_col: str, vector_col: str, k: int, dimensions: int, scale: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``seed:id``, as whole numbers in that order."""
    kept = kept_vectors(vectors, id_col=id_col, vector_col=vector_col, dimensions=dimensions)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.orderBy(drawn.asc_nulls_last(), "vector").limit(k).collect()
    return np.floor(scale * np.array([r["vector"] for r in rows], np.float64)).astype(np.int64).reshape(-1, dimensions)


def _round(trees: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round; empty ones stay."""
    schema = "cluster int, n long, sums array<long>"
    arrow = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, tree in _trees(batch, centroids.shape[1]):
                n, sums, _, _ = nearest_in(tree, centroids, each=False)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((some, n[some], list(sums[some])), arrow, strict=True)], schema=arrow)

    parts = trees.mapInArrow(run, schema).select("cluster", "n", F.posexplode("sums").alias("i", "s"))
    whole = parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    moved = centroids.copy()
    for r in whole.collect():  # k * dimensions rows
        moved[r["cluster"], r["i"]] = int(r["s"]) // r["n"]
    return moved


def cluster_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """A written table (id, cluster, distance) of the nearest centroid of each vector after ``rounds`` rounds, and the centroids."""
    centroids = first_centroids(vectors, id_col=id_col, vector_col=vector_col, k=k, dimensions=dimensions, scale=scale, seed=seed)
    schema = "id long, cluster int, distance long"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema), centroids
    trees = plant(vectors, id_col=id_col, vector_col=vector_col, dimensions=dimensions, scale=scale)
    for _ in range(rounds):
        centroids = _round(trees, centroids)
    arrow = arrow_type(schema)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, missing, tree in _trees(batch, dimensions):
                _, _, chosen, _ = nearest_in(tree, centroids, each=True)
                off = tree.vectors - centroids[chosen]
                columns = (pa.array(ids, mask=missing.astype(bool)), pa.array(chosen, pa.int32()), pa.array((off * off).sum(axis=1)))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    assigned = materialize(trees.mapInArrow(assign, schema), "assigned")
    discard(trees)
    return assigned, centroids


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import hashlib

    assigned, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()  # k rows
    of = {r["cluster"]: int(r["inertia"]) for r in sums}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame([(c, of[c], sum(of.values()), digest[c]) for c in of], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES = {"op11_centroids": op11_centroids}

_DISTANCE = f"list_sum(list_transform(range(1, {DIMENSIONS + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT"
_ASSIGN = f"""a{{n}} AS MATERIALIZED (SELECT r, vec_id, v, m.cluster AS cluster, m.distance AS distance FROM (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{{{'distance': d, 'cluster': cluster}}}}) AS m
  FROM (SELECT r, vec_id, v, cluster, {_DISTANCE} AS d FROM kept, c{{n}}) GROUP BY r))"""
_MOVE = f"""s{{n}} AS (SELECT cluster, i, sum(v[i]) AS s, count(*) AS n FROM a{{n}}, range(1, {DIMENSIONS + 1}) t(i) GROUP BY ALL),
m{{n}} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{{n}} GROUP BY cluster),
c{{next}} AS MATERIALIZED (SELECT cluster, coalesce(m{{n}}.c, c{{n}}.c)::BIGINT[] AS c FROM c{{n}} LEFT JOIN m{{n}} USING (cluster))"""
SQL = {
    "op11_centroids": f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMENSIONS}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, v) - 1)::INTEGER AS cluster, v AS c FROM kept
  QUALIFY cluster < {CLUSTERS}),
"""
    + ",\n".join(_ASSIGN.format(n=n) + ",\n" + _MOVE.format(n=n, next=n + 1) for n in range(ROUNDS))
    + ",\n"
    + _ASSIGN.format(n=ROUNDS)
    + f"""
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} USING (cluster)"""
}
