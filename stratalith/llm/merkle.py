"""Operator 13: Merkle manifest of a dataset, built and proved by supersteps in which nodes message each other.

Each group of rows is a tree: its leaves stand in order of id, and while several nodes remain, each ``FAN`` in a row have
a parent. The groups' roots, in order of group, are the leaves of one more tree, whose root stands for the dataset.

Up: in a superstep each node of an unfinished tree messages (place, digest) to its parent; a parent that has heard from
all its children hashes their digests in order and speaks in the next one. A tree that is down to one node falls silent.
Down: each parent sends its children their siblings' digests before its own path, so a leaf gets its proof, level by
level. A leaf folds the claimed digest of its row with that proof; the row is verified if this gives the root.

Places come from a range partition and one count for each range and group, so a group that holds most rows is numbered
by many tasks. A node gets ``FAN`` messages at most; supersteps grow with the logarithm of the rows. Digests alone are
shuffled, texts are read once. Levels are tables of the shared folder, so a lost executor costs a superstep. The driver
sees the root, and the largest number of leaves in a tree.

Defined results: a null field counts as ``-``, so no row is left out; a null group is a group, and the first. Null ids come
first in their group. Rows that repeat an id are leaves of their own, in order of their digests; equal rows stand in
any order. A group of one row has that leaf as its root, and a single group's root is the dataset's. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialize, small_side, table

FAN = 8
#: Leaves for each task of a superstep.
TASK_LEAVES = 250_000

_NODE = "tree long, i long, n long, digest binary"


def field(value: Column) -> Column:
    """A field as ``-`` if it is null, else its length in bytes, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(fields: list[Column]) -> Column:
    """SHA-256 of fields, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def join_digests(digests: Iterable[bytes]) -> bytes:
    """A parent's digest: that of its children's, as lower-case hex one after the other."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def fold(digest: bytes, proof: bytes, places: list[tuple[int, int]]) -> bytes:
    """The root that a leaf and its proof give. ``places``: (place, number of leaves) in its tree, and that tree's in the upper one."""
    at = 0
    for i, n in places:
        while n > 1:
            before, others = i % FAN, min(FAN, n - i // FAN * FAN) - 1
            run = [proof[at + 32 * k : at + 32 * k + 32] for k in range(others)]
            digest = join_digests([*run[:before], digest, *run[before:]])
            at, i, n = at + 32 * others, i // FAN, -(-n // FAN)
    return digest


def height(n: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def number_leaves(rows: DataFrame) -> DataFrame:
    """A written table with ``tree`` (the group's place among the groups), ``i`` (the row's place in its group) and ``n``
    (the group's rows), of rows with group, id and digest."""
    order = ["_group", F.col("id").asc_nulls_first(), "digest", "_salt"]
    own = rows.withColumn("_group", F.coalesce(F.concat(F.lit("1"), "group"), F.lit("0")))
    own = materialize(own.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id())), "digests")  # parts equal rows
    placed = own.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    within = Window.partitionBy("_part", "_group").orderBy(*order[1:])
    placed = materialize(placed.withColumn("_within", F.row_number().over(within) - 1).drop("_salt"), "placed")
    counts = placed.groupBy("_part", "_group").agg(F.count("*").alias("_n"))
    group = Window.partitionBy("_group")
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", "_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("n"))
    counts = materialize(counts, "counts")  # a row for each range and group
    groups = counts.select("_group").distinct().sort("_group").rdd.map(lambda r: r[0]).zipWithIndex()
    trees = small_side(rows.sparkSession.createDataFrame(groups, "_group string, tree long"))
    found = placed.join(small_side(counts.join(trees, "_group")), ["_part", "_group"])
    leaves = materialize(found.select(*rows.columns, "tree", (F.col("_before") + F.col("_within")).alias("i"), "n"), "leaves")
    discard(own, placed, counts)
    return leaves


def _tasks(spark: SparkSession, n: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_LEAVES))


def _keep(spark: SparkSession, nodes: RDD, tag: str) -> DataFrame:
    return materialize(spark.createDataFrame(nodes, _NODE, verifySchema=False), tag)


def _parent(heard: tuple[tuple[int, int], list]) -> tuple[int, int, int, bytes]:
    """What a parent is once all its children have spoken."""
    (tree, i), messages = heard
    n = messages[0][1]
    if len(messages) != min(FAN, n - FAN * i):
        raise ValueError(f"node {i} of tree {tree} heard from {len(messages)} children")
    return tree, i, -(-n // FAN), join_digests(m[2] for m in sorted(messages))


def climb(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Levels of all trees, each one a written table (tree, i, n, digest). ``most``: leaves of the largest tree."""
    spark, levels = nodes.sparkSession, [nodes.select("tree", "i", "n", "digest")]
    while most > 1:
        speak = levels[-1].where("n > 1").rdd.map(lambda r: ((r[0], r[1] // FAN), (r[1] % FAN, r[2], r[3])))
        most = -(-most // FAN)
        heard = speak.aggregateByKey([], lambda a, m: [*a, m], lambda a, b: a + b, _tasks(spark, most))
        levels.append(_keep(spark, heard.map(_parent), f"level-{len(levels)}"))
    return levels


def _told(parent: tuple) -> Iterator[tuple]:
    """A path for each child of a parent: its siblings' digests, then the parent's own path."""
    _, (children, states) = parent
    children = sorted(children, key=lambda c: c[0])
    for path, subroot in states:
        run = b"".join(c[1] for c in children)
        for k, child in enumerate(children):
            yield child, run[: 32 * k] + run[32 * k + 32 :] + path, subroot


def descend(levels: list[RDD], tops: RDD, tasks: list[int]) -> RDD:
    """(leaf, path, subroot) of each leaf. ``levels``: ((tree, i, n), (i, digest, ...)) of each level; ``tops``:
    (tree, levels above the leaves, path, subroot) of each tree's root."""
    state = None
    for k in reversed(range(len(levels))):
        own = tops.filter(lambda t, k=k: t[1] == k).map(lambda t: ((t[0], 0), (t[2], t[3])))
        if state is not None:
            children = levels[k].filter(lambda c: c[0][2] > 1).map(lambda c: ((c[0][0], c[0][1] // FAN), c[1]))
            told = children.cogroup(state, numPartitions=tasks[k]).flatMap(lambda x: ((x[0][0], t) for t in _told(x)))
        if k == 0:
            alone = levels[0].filter(lambda c: c[0][2] == 1).map(lambda c: ((c[0][0], 0), c[1])).join(own, tasks[0])
            lone = alone.map(lambda x: (x[1][0], x[1][1][0], x[1][1][1]))
            return lone if state is None else told.map(lambda x: x[1]).union(lone)
        state = own if state is None else told.map(lambda x: ((x[0], x[1][0][0]), (x[1][1], x[1][2]))).union(own)
    raise AssertionError


def manifest(rows: DataFrame) -> DataFrame:
    """Leaves with their roots and proofs, of rows (id long, group string, digest binary, claimed binary).

    Columns: id, leaf, subroot, root, proof (siblings' digests in order, 32 bytes each), folded_root (of the claimed
    digest, or the leaf's own where it is null), verified.
    """
    spark = rows.sparkSession
    schema = "id long, leaf binary, subroot binary, root binary, proof binary, folded_root binary, verified boolean"
    leaves = number_leaves(rows.select("id", "group", "digest", "claimed"))
    most, n_trees, n_leaves = leaves.agg(F.max("n"), F.max("tree") + 1, F.count("*")).first()
    if not n_leaves:
        return spark.createDataFrame([], schema)
    levels = climb(leaves, most)
    roots = levels[0].where("n = 1")
    for level in levels[1:]:
        roots = roots.unionByName(level.where("n = 1"))
    roots = materialize(roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("i"), F.lit(n_trees).cast("long").alias("n"), "digest"), "roots")
    upper = climb(roots, n_trees)
    root = upper[-1].where("n = 1").first()["digest"]

    of_level = lambda df: df.rdd.map(lambda r: ((r[0], r[1], r[2]), (r[1], bytes(r[3]))))
    crown = spark.sparkContext.parallelize([(0, height(n_trees), b"", root)], 1)
    paths = descend([of_level(df) for df in upper], crown, [_tasks(spark, n_trees)] * len(upper))
    sizes = leaves.where("i = 0").select("tree", "n").rdd.map(lambda r: (r[0], r[1]))
    tops = paths.map(lambda p: (p[0][0], (p[0][1], p[1]))).join(sizes, _tasks(spark, n_trees))
    tops = tops.map(lambda t: (t[0], height(t[1][1]), t[1][0][1], t[1][0][0]))
    tops = materialize(spark.createDataFrame(tops, "tree long, height long, path binary, subroot binary", verifySchema=False), "tops")
    tops_rdd = tops.rdd.map(lambda r: (r[0], r[1], bytes(r[2]), bytes(r[3])))

    keep = leaves.select("tree", "i", "n", "id", "digest", "claimed")
    first = keep.rdd.map(lambda r: ((r[0], r[1], r[2]), (r[1], bytes(r[4]), r[0], r[2], r[3], None if r[5] is None else bytes(r[5]))))
    tasks = [_tasks(spark, n_leaves // FAN**k) for k in range(len(levels))]

    def prove(got: tuple) -> tuple:
        (i, digest, tree, n, own_id, claimed), proof, subroot = got
        folded = fold(digest if claimed is None else claimed, proof, [(i, n), (tree, n_trees)])
        return own_id, digest, subroot, root, proof, folded, folded == root

    found = descend([first, *(of_level(df) for df in levels[1:])], tops_rdd, tasks).map(prove)
    return spark.createDataFrame(found, schema, verifySchema=False)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("lang").alias("group"), row_digest([F.col(c) for c in fields]).alias("digest"),
        row_digest([*(F.col(c) for c in fields[:-1]), tampered]).alias("claimed"),
    )
    text = lambda c: F.lower(F.hex(c))
    return manifest(rows).select(
        F.col("id").alias("doc_id"), *(text(c).alias(c) for c in ("leaf", "subroot", "root")), F.sha2(text("proof"), 256).alias("proof_sha256"),
        text("folded_root").alias("folded_root"), "verified",
    )


QUERIES = {"op13_merkle": op13_merkle}

_LEVELS, _UPPER_LEVELS = 8, 3
_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}, '-')"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))


def _climb_sql(name: str, levels: int) -> str:
    return ",\n".join(
        f"{name}{k + 1} AS MATERIALIZED (SELECT tree, i // {FAN} AS i, (any_value(n) + {FAN - 1}) // {FAN} AS n, "
        f"CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d, list(d ORDER BY i) AS run FROM {name}{k} GROUP BY tree, i // {FAN})"
        for k in range(levels)
    )


def _fold_sql(came: str, name: str, tree: str, place: str, count: str, levels: int) -> tuple[str, str]:
    steps = []
    for k in range(levels):
        before, after = f"run[1:(f.{place} // {FAN**k}) % {FAN}]", f"run[(f.{place} // {FAN**k}) % {FAN} + 2:]"
        steps.append(
            f"{name}f{k} AS (SELECT f.* EXCLUDE (folded, proof), proof || array_to_string({before} || {after}, '') AS proof, "
            f"CASE WHEN f.{count} <= {FAN**k} THEN folded ELSE sha256(array_to_string({before} || [folded] || {after}, '')) END AS folded "
            f"FROM {came} f JOIN {name}{k + 1} t ON t.tree = {tree} AND t.i = f.{place} // {FAN ** (k + 1)})"
        )
        came = f"{name}f{k}"
    return ",\n".join(steps), came


def _sql() -> str:
    lower, came = _fold_sql("own", "l", "f.tree", "i0", "n0", _LEVELS)
    upper, came = _fold_sql(came, "t", "0", "tree", "n_trees", _UPPER_LEVELS)
    bits = "flatten(list_transform(str_split(doc_id::VARCHAR, ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]))::BIGINT[]"
    crc = f"xor(list_reduce([4294967295::BIGINT] || {bits}, lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
    tampered = f"CASE WHEN {crc} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END"
    return f"""WITH d AS MATERIALIZED (SELECT doc_id, lang, sha256({_HEAD} || {_FIELD.format("text")}) AS leaf, sha256({_HEAD} || {_FIELD.format("changed")}) AS claimed
  FROM (SELECT *, {tampered} AS changed FROM documents)),
own AS MATERIALIZED (SELECT doc_id, leaf, claimed AS folded, '' AS proof, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i0,
  count(*) OVER (PARTITION BY lang) AS n0, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, (SELECT count(*) FROM (SELECT DISTINCT lang FROM d)) AS n_trees FROM d),
l0 AS (SELECT tree, i0 AS i, n0 AS n, leaf AS d FROM own),
{_climb_sql("l", _LEVELS)},
t0 AS (SELECT 0 AS tree, tree AS i, count(*) OVER () AS n, d FROM l{_LEVELS}),
{_climb_sql("t", _UPPER_LEVELS)},
{lower},
{upper}
SELECT doc_id, leaf, s.d AS subroot, r.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.d AS verified
FROM {came} f JOIN l{_LEVELS} s USING (tree), t{_UPPER_LEVELS} r"""


SQL = {"op13_merkle": _sql()}
