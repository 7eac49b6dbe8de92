"""Operator 7: near-duplicate vectors by sorted projection passes.

Equal vectors are folded into one class first. In each pass every class gets 64 signs of random
projections; classes are sorted by them as one number, so that vectors at a small angle tend to share a
long beginning and stand near each other. Each class is compared with the ``window`` classes before it,
by cosine in double precision. All passes of a level are one sort and one exchange of vectors.

How many passes a level makes follows from the angle, the window and the count of classes; whether that was
enough is read from the data. A partner that shares more leading signs with a class than the classes at both
ends of its window do stands within the window, and a pair at the least cosine shares k signs with a known
probability. So each class has a bound on the probability that such a partner was missed in all passes. Those
above ``MISSED``, in a dense topic or among many copies, and those with a window filled with links go to a next
level by themselves, with a window four times as wide, until none is left or the window holds all that are
left, which is exact. A pair is in danger only if both its ends are, so a level need not look at the others.

Every class carries its ranks in all passes, so a pair is counted in the first pass that compares it and
in no other, and no list of pairs is written: a block returns sums of links for its classes, and a
spanning forest for the components. A task's group holds TILE rows of a block and TILE before it at most:
wider windows are compared in several groups.

Nulls, empties: a vector that is null, empty, zero, or holds a null or a number that is not finite, or
whose id is null, links with nothing: n_links 0, component_id its id. Vectors of different lengths do
not link. Repeated rows count as other vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_type, connected_components, discard, join_classes, materialize, table
from .simhash import Forest

LEAST_COSINE, WINDOW, MISSED = 0.95, 256, 0.02
#: Rows that one side of a group holds, and of these the rows compared at once.
TILE, ROWS_AT_ONCE = 8192, 512


def passes_for(n: int, window: int, least: float, missed: float = MISSED) -> int:
    """Passes after which a pair at the least cosine is missed with the probability given.

    A window of w among n classes holds those that share about log2(n / w) leading signs; one sign is
    shared with probability 1 - angle / pi.
    """
    if window >= n:
        return 1
    found = together(least) ** math.log2(n / window)
    return max(4, math.ceil(math.log(missed) / math.log(1 - found)))


def together(least: float) -> float:
    """Probability that two vectors at the least cosine share a sign."""
    return 1 - math.acos(least) / math.pi


def unit_rows(column: pa.Array, size: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def projection_keys(classes: DataFrame, passes: int, before: int = 0) -> DataFrame:
    """(pass, size, key, rep): 64 projection signs of each class in each pass, as an ordered long. ``before``
    passes drew other projections."""
    schema = "pass int, size int, key long, rep long"
    arrow = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(at))
                x = unit_rows(part.column("embedding"), int(size))
                for p in range(passes):
                    planes = np.random.default_rng([7, before + p, int(size)]).standard_normal((int(size), 64))
                    signs = np.packbits(x @ planes > 0, axis=1).view(">u8")[:, 0].astype(np.uint64)
                    key = (signs ^ np.uint64(1 << 63)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), p, np.int32)), pa.array(np.full(len(at), size, np.int32)), pa.array(key), part.column("rep")],
                        schema=arrow,
                    )

    return classes.select("rep", "size", "embedding").mapInArrow(run, schema)


def ranks(keys: DataFrame, n: int, window: int, least: float) -> DataFrame:
    """(rep, ranks array<long>, missed): each class's place in the order of each pass, and the logarithm of a
    bound on the probability that a partner at the least cosine is in none of its windows."""
    ordered = keys.sort("pass", "size", "key", "rep").select("pass", "rep", "size", "key", F.monotonically_increasing_id().alias("at"))
    ordered = materialize(ordered, "projection-order")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    # one row for each partition of the sort
    sizes = sorted((r["part"], r["n"]) for r in ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, rows = 0, []
    for number, count in sizes:
        rows.append((number, before))
        before += count
    starts = keys.sparkSession.createDataFrame(rows or [(0, 0)], "part long, before long")
    placed = ordered.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("r", F.col("before") + place - F.col("pass") * n)
    placed = placed.select("pass", "rep", "size", "key", "r")
    # the leading signs that a class shares with the one a window further on bound both their windows
    ends = placed.select("pass", (F.col("r") - window).alias("r"), F.col("rep").alias("end"), F.col("size").alias("end_size"), F.col("key").alias("end_key"))
    signs = F.expr("CASE WHEN size <> end_size THEN 0 WHEN key = end_key THEN 65 ELSE 65 - length(bin(key ^ end_key)) END")
    edges = placed.join(ends, ["pass", "r"]).select("pass", signs.alias("signs"), F.explode(F.array("rep", "end")).alias("rep"))
    rows_of = placed.select("pass", "rep", "r", F.lit(0).alias("signs")).unionByName(edges.select("pass", "rep", F.lit(None).cast("long").alias("r"), "signs"))
    by_class = rows_of.groupBy("rep", "pass").agg(F.max("r").alias("r"), F.max("signs").alias("signs"))
    passes = by_class.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("pass", "r", "signs"))).alias("p"))  # as many as passes
    # found for certain without classes at both ends; else never taken for certain
    escaped = F.expr(f"aggregate(p, 0D, (sum, x) -> sum + if(x.signs = 0, -745D, ln(1D - 0.999999D * pow({together(least)!r}D, x.signs))))")
    return passes.select("rep", F.transform("p", lambda x: x["r"]).alias("ranks"), escaped.alias("missed"))


def window_links(placed: DataFrame, windows: list[int], first_pass: int, *, least: float) -> DataFrame:
    """Rows (kind, a, b) from the passes from ``first_pass`` on over (rep, n, size, embedding, ranks). links: b
    more vectors are linked to class a. edge: a and b are linked, a spanning forest of each group. full: a is
    linked to all classes between it and an end of its window.
    ``windows``: that of each place in ranks."""
    window = windows[-1]
    block = min(4 * window, TILE)
    tiles = -(-window // TILE)
    # a row is at home in its block, with each tile of the window before it; and before the blocks that reach it
    tasks = F.expr(
        f"""explode(flatten(transform(filter(sequence(0, {len(windows) - 1}), p -> p >= {first_pass}), p ->
          concat(transform(sequence(0, {tiles - 1}), t -> struct(p, ranks[p] div {block} AS block, t AS tile)),
            transform(filter(sequence(ranks[p] div {block}, (ranks[p] + {window}) div {block}), b -> b * {block} > ranks[p]),
              b -> struct(p, b AS block, CAST((b * {block} - ranks[p] - 1) div {TILE} AS INT) AS tile))))))"""
    )
    sent = placed.select("rep", "n", "size", "embedding", "ranks", tasks.alias("to")).select("to.*", "rep", "n", "size", "embedding", "ranks")
    schema = "kind string, a long, b long"
    out = arrow_type(schema)

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        p, first, tile = rows.column("p")[0].as_py(), rows.column("block")[0].as_py() * block, rows.column("tile")[0].as_py()
        order = rows.column("ranks").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        by_rank = np.argsort(order[:, p])
        rows, order = rows.take(pa.array(by_rank)), order[by_rank]
        place, sizes = order[:, p], rows.column("size").to_numpy()
        reps, weights = rows.column("rep").to_numpy(), rows.column("n").to_numpy()
        sums = np.zeros(len(reps), np.int64)
        full = np.zeros(len(reps), bool)
        forest = Forest(len(reps))
        edges: list[tuple[int, int]] = []
        for size in np.unique(sizes):  # in order of size: each is a run
            at = np.flatnonzero(sizes == size)
            x = unit_rows(rows.column("embedding").combine_chunks().take(pa.array(at)), int(size))
            for lo in range(0, len(at), ROWS_AT_ONCE):
                own = np.arange(lo, min(lo + ROWS_AT_ONCE, len(at)))
                own = own[place[at[own]] >= first]  # the others are at home in a block before
                if not len(own):
                    continue
                far = np.searchsorted(place[at], place[at[own[0]]] - window)
                near = np.arange(far, own[-1] + 1)
                if tile:  # the block's own rows meet in its first group
                    near = near[place[at[near]] < first]
                gap = place[at[own]][:, None] - place[at[near]][None, :]
                linked = (x[own] @ x[near].T >= least) & (gap > 0) & (gap <= window)
                if tiles == 1 or tile == tiles - 1:  # the end of the window is here
                    i, j = np.nonzero(linked & (gap == window))
                    filled = linked[i].sum(axis=1) >= np.minimum(window, (gap[i] > 0).sum(axis=1))
                    full[at[own[i[filled]]]] = full[at[near[j[filled]]]] = True
                i, j = np.nonzero(linked)
                i, j = at[own[i]], at[near[j]]
                new = np.ones(len(i), bool)
                for q in range(p):
                    new &= np.abs(order[i, q] - order[j, q]) > windows[q]
                i, j = i[new], j[new]
                np.add.at(sums, i, weights[j])
                np.add.at(sums, j, weights[i])
                edges += forest.link(i, j)
        with_links, filled = np.flatnonzero(sums), np.flatnonzero(full)
        pairs = np.array(edges, np.int64).reshape(-1, 2)
        kinds = ["links"] * len(with_links) + ["edge"] * len(pairs) + ["full"] * len(filled)
        a = np.concatenate([reps[with_links], reps[pairs[:, 0]], reps[filled]])
        b = np.concatenate([sums[with_links], reps[pairs[:, 1]], 0 * filled])
        return pa.Table.from_arrays([pa.array(kinds, pa.string()), pa.array(a), pa.array(b)], schema=out)

    return sent.groupBy("p", "block", "tile").applyInArrow(compare, schema)


def all_links(classes: DataFrame, *, least: float, window: int) -> DataFrame:
    """Links of all classes (rep, n, size, embedding), level by level."""
    live = classes.withColumns({"ranks": F.array().cast("array<long>"), "missed": F.lit(0.0)})
    windows: list[int] = []
    found = None
    while True:
        n = live.count()
        passes, before = passes_for(n, window, least), len(windows)
        own = ranks(projection_keys(live, passes, before), n, window, least)
        own = own.select("rep", F.col("ranks").alias("new_ranks"), F.col("missed").alias("new_missed"))
        live = live.join(own, "rep").select(
            "rep", "n", "size", "embedding", F.concat("ranks", "new_ranks").alias("ranks"), (F.col("missed") + F.col("new_missed")).alias("missed")
        )
        last, live = live, materialize(live, "vector-ranks")
        discard(last)
        windows += [window] * passes
        part = materialize(window_links(live, windows, before, least=least), "links")
        found = part if found is None else found.unionByName(part)
        full = part.where("kind = 'full'").select(F.col("a").alias("rep"), F.lit(True).alias("full")).distinct()
        live = live.join(full, "rep", "left").where((F.col("missed") > math.log(MISSED)) | F.col("full")).drop("full")
        last, live = live, materialize(live, "vectors-in-danger")
        discard(last)
        if window >= n or live.isEmpty():
            return found
        window *= 4


def dedup_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST_COSINE, window: int = WINDOW
) -> DataFrame:
    """id, n_links, component_id, kept for each vector."""
    own = vectors.select(F.col(id_col).alias("vid"), F.col(vector_col).alias("embedding"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    valid = (
        F.col("vid").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.exists("embedding", bad)
        & F.exists("embedding", lambda x: x != 0)
    )
    own = own.withColumn("valid", F.coalesce(valid, F.lit(False)))
    classes = (
        own.where("valid").groupBy("embedding").agg(F.min("vid").cast("long").alias("rep"), F.count("*").alias("n"))
        .withColumn("size", F.size("embedding"))
    )
    classes = materialize(classes, "vector-classes")
    found = all_links(classes, least=least, window=window)
    sums = found.where("kind = 'links'").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("links"))
    components = connected_components(found.where("kind = 'edge'").select("a", "b")).withColumnRenamed("id", "rep")
    named = classes.join(sums, "rep", "left").join(components, "rep", "left").select(
        "embedding", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component_id", "rep").alias("component")
    )
    joined = join_classes(own.where("valid"), materialize(named, "named"), key="embedding", size="n").select("vid", "links", "component")
    alone = own.where("NOT valid").select("vid", F.lit(0).cast("long").alias("links"), F.col("vid").cast("long").alias("component"))
    return joined.unionByName(alone).select(
        F.col("vid").alias(id_col),
        F.col("links").alias("n_links"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("component") == F.col("vid"), F.lit(True)).alias("kept"),
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {"op7_embedding_dedup": op7_embedding_dedup}

#: All pairs by definition; the passes find these but for the share that MISSED allows.
SQL = {
    "op7_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE vec_id IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r(id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, p.b FROM r JOIN p ON p.a = r.other),
c AS (SELECT id, min(other) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id"""
}
