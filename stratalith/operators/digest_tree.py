"""Trees of digests over tables, so two of them are compared by the branches that differ.

Lines fall into buckets by a hash of their key, so a line that is added or gone changes its own bucket alone. A bucket's
digest is that of its lines in order, a node's that of its ``fan`` children in order. A tree is a small table that is kept
beside its table; a comparison goes down from the root through nodes that differ, and only then reads lines, those of the
buckets that differ. All is built-in functions; a bucket holds some ``LEAF_LINES`` lines, however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.checkpoints import kept, release

LEAF_LINES, FAN = 64, 16


def tree_buckets(lines: int, *, leaf_lines: int = LEAF_LINES, fan: int = FAN) -> int:
    """Buckets for so many lines: the least power of ``fan`` that gives each ``leaf_lines`` at most, on average."""
    buckets = 1
    while buckets * leaf_lines < lines:
        buckets *= fan
    return buckets


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets))


def _line(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def digest_tree(rows: DataFrame, *, key: str, columns: list[str], buckets: int, fan: int = FAN) -> DataFrame:
    """(level, node, digest, n_lines) of a tree over a table, level 0 the buckets; of no rows an empty table.

    Equal lines are counted before they meet, so a line that many rows repeat is one. A null key is a key.
    """
    lines = rows.select(_bucket(key, buckets).alias("node"), _line([key, *columns]).alias("line")).groupBy("node", "line").agg(F.count("*").alias("n"))
    own = lines.groupBy("node").agg(F.array_sort(F.collect_list(F.concat_ws(":", "line", "n"))).alias("parts"), F.sum("n").alias("n_lines"))
    level = kept(own.select(F.lit(0).alias("level"), "node", F.sha2(F.array_join("parts", ""), 256).alias("digest"), "n_lines"))
    levels, width = [level], buckets
    while width > 1:
        parts = F.array_sort(F.collect_list(F.struct("node", "digest")))
        up = levels[-1].groupBy(F.floor(F.col("node") / fan).alias("node")).agg(parts.alias("parts"), F.sum("n_lines").alias("n_lines"))
        joined = F.array_join(F.transform("parts", lambda p: F.concat_ws(":", p["node"].cast("string"), p["digest"])), ",")
        levels.append(up.select(F.lit(len(levels)).alias("level"), "node", F.sha2(joined, 256).alias("digest"), "n_lines"))
        width = -(-width // fan)
    tree = levels[0]
    for level in levels[1:]:
        tree = tree.unionByName(level)
    found = kept(tree)
    release(levels[0])
    return found


def differing_buckets(one: DataFrame, other: DataFrame, *, buckets: int, fan: int = FAN) -> DataFrame:
    """(node) of the buckets that two trees of as many buckets do not share, from the root down."""
    top, width = 0, buckets
    while width > 1:
        top, width = top + 1, -(-width // fan)
    at = None
    for level in range(top, -1, -1):
        left, right = (t.where(F.col("level") == level).select("node", F.col("digest").alias(name)) for t, name in ((one, "a"), (other, "b")))
        if at is not None:
            left, right = (t.join(at, F.floor(t["node"] / fan) == at["parent"], "left_semi") for t in (left, right))
        found = kept(left.join(right, "node", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("node"))
        if at is not None:
            release(at)
        if level == 0:
            return found
        at = found.select(F.col("node").alias("parent"))
        at._kept_at = found._kept_at
    raise AssertionError


def differing_lines(one: DataFrame, other: DataFrame, trees: tuple[DataFrame, DataFrame], *, key: str, columns: list[str], buckets: int, fan: int = FAN) -> DataFrame:
    """(key, state) of keys whose lines differ: ``changed``, ``missing`` (in one alone) or ``added`` (in the other alone)."""
    nodes = differing_buckets(*trees, buckets=buckets, fan=fan)

    def lines(rows: DataFrame, side: int) -> DataFrame:
        own = rows.withColumn("_node", _bucket(key, buckets)).join(nodes, F.col("_node") == F.col("node"), "left_semi")
        counted = own.groupBy(key, _line([key, *columns]).alias("_line")).agg(F.count("*").alias("_n"))
        return counted.withColumn("_side", F.lit(side))

    both = lines(one, 1).unionByName(lines(other, 2))
    kinds = both.groupBy(key, "_line", "_n").agg(F.bit_or("_side").alias("_sides"))
    found = kinds.groupBy(key).agg(F.bit_or("_sides").alias("_all"), F.min("_sides").alias("_least"))
    state = F.when(F.col("_all") == 1, "missing").when(F.col("_all") == 2, "added").otherwise("changed")
    return found.where("_least < 3").select(key, state.alias("state"))
