"""Walks over version edges and redirects, and checks of chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.checkpoints import kept, release


#: Edges of a key that one row holds; a key with more is walked by joins.
SHORT = 64


def walk_chain(edges: DataFrame, *, key: str, source: str, target: str, start: str) -> DataFrame:
    """Each edge of the walk from ``start`` in each key, with its hop and whether it closes a cycle.

    A null source counts as the start; of several edges from a source the smallest target is taken. A key of SHORT
    edges at most is walked in a row of its own. Of longer ones reach is doubled: what lies within n hops is joined with jumps of n hops, and jumps with themselves, so rounds grow
    with the logarithm of the longest walk, whatever its length, and a row holds no path.
    """
    own = edges.select(F.col(key).cast("string").alias("k"), F.coalesce(F.col(source).cast("string"), F.lit(start)).alias("s"), F.col(target).cast("string").alias("t"))
    step = kept(own.groupBy("k", "s").agg(F.min("t").alias("t")))
    sizes = step.groupBy("k").agg(F.count("*").alias("n"))
    longer = kept(sizes.where(F.col("n") > SHORT).select("k"))
    if longer.isEmpty():
        walked = _walk_rows(step, start)
    else:
        walked = _walk_rows(step.join(longer, "k", "left_anti"), start).unionByName(_walk_joins(step.join(longer, "k", "left_semi"), start))
    return walked.select(F.col("k").alias(key), F.col("s").alias(source), F.col("t").alias(target), "hop", "cycle")


def _walk_rows(step: DataFrame, start: str) -> DataFrame:
    """(k, s, t, hop, cycle) of the walks of keys whose edges a row can hold."""
    chains = step.where("k IS NOT NULL AND t IS NOT NULL").groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("s", "t"))).alias("to"))

    def onward(walk, _):
        goes = F.map_contains_key("to", walk["node"]) & ~F.array_contains(walk["path"], walk["node"])
        return F.when(goes, F.struct(F.try_element_at("to", walk["node"]).alias("node"), F.array_append(walk["path"], walk["node"]).alias("path"))).otherwise(walk)

    begin = F.struct(F.lit(start).alias("node"), F.array().cast("array<string>").alias("path"))
    walks = chains.select("k", "to", F.aggregate(F.map_keys("to"), begin, onward, lambda walk: walk["path"]).alias("path"))
    hops = walks.select("k", "to", "path", F.posexplode("path").alias("at", "s")).withColumn("t", F.try_element_at("to", "s"))
    back = F.array_position("path", F.col("t"))  # 0 if the target has not been walked from
    return hops.select("k", "s", "t", (F.col("at") + 1).alias("hop"), ((back > 0) & (back <= F.col("at") + 1)).alias("cycle"))


def _walk_joins(step: DataFrame, start: str) -> DataFrame:
    """The same of keys of any length."""
    step = kept(step)
    jump, span = step.select("k", F.col("s").alias("node"), F.col("t").alias("far")), 1
    reach = new = kept(step.where(F.col("s") == start).select("k", F.col("s").alias("node"), F.lit(0).alias("hop")))
    while not new.isEmpty():
        far = reach.join(jump, ["k", "node"]).groupBy("k", F.col("far").alias("node")).agg((F.min("hop") + span).alias("hop"))
        last, new = new, kept(far.join(reach, ["k", "node"], "left_anti"))
        old, old_jump, spent = reach, jump, last
        reach = kept(reach.unionByName(new))
        live = new.select("k").distinct()  # chains that are walked to their end need no further jumps
        onward = jump.select("k", F.col("node").alias("far"), F.col("far").alias("further"))
        jump = kept(jump.join(live, "k", "left_semi").join(onward, ["k", "far"]).select("k", "node", F.col("further").alias("far")))
        release(old, old_jump, spent)
        span *= 2
    ends = reach.select("k", F.col("node").alias("t"), F.col("hop").alias("end_hop"))
    walked = step.join(reach.withColumnRenamed("node", "s"), ["k", "s"]).join(ends, ["k", "t"])
    return walked.select("k", "s", "t", (F.col("hop") + 1).alias("hop"), (F.col("end_hop") <= F.col("hop")).alias("cycle"))


def chain_errors(edges: DataFrame, *, key: str, source: str, target: str, start: str, ordered: bool = False) -> DataFrame:
    """(key, error_code): branch, no-start, cycle, disconnected or duplicate-target. A key that branches is not said to be
    disconnected, as one of its branches alone is walked.

    ``ordered``: of a key with several edges, all without a source, the edges are a list of whole states, each of which stands
    for itself; there only a target that comes twice is wrong.
    """
    named = edges.select(F.col(key).cast("string").alias(key), F.col(source).cast("string").alias("_given"), F.col(target).cast("string").alias(target))
    found = {}
    if ordered:
        lists = listed_states(edges, key=key, source=source).select(F.col(key).cast("string").alias(key))
        states = named.join(lists, key, "left_semi")
        found["duplicate-target"] = states.groupBy(key, target).agg(F.count("*").alias("n")).where("n > 1").select(key).distinct()
        named = kept(named.join(lists, key, "left_anti"))
        edges = named.select(key, F.col("_given").alias(source), target)
    own = named.select(key, F.coalesce(F.col("_given"), F.lit(start)).alias(source))
    walked = kept(walk_chain(edges, key=key, source=source, target=target, start=start))
    branch = own.groupBy(key, source).agg(F.count("*").alias("n")).where("n > 1").select(key).distinct()
    starts = own.groupBy(key).agg(F.count_if(F.col(source) == start).alias("n"))
    apart = own.join(walked.select(key, source), [key, source], "left_anti").join(branch, key, "left_anti").select(key).distinct()
    found |= {"branch": branch, "no-start": starts.where("n = 0").select(key), "cycle": walked.where("cycle").select(key).distinct(), "disconnected": apart}
    parts = [part.select(key, F.lit(code).alias("error_code")) for code, part in found.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def listed_states(edges: DataFrame, *, key: str, source: str) -> DataFrame:
    """(key, n_states) of keys with several edges, none of which has a source: ordered lists of whole states."""
    return edges.groupBy(key).agg(F.count("*").alias("n_states"), F.count(source).alias("_n")).where("n_states > 1 AND _n = 0").select(key, "n_states")


def states_to_apply(edges: DataFrame, *, key: str, source: str, order: str) -> DataFrame:
    """The edges that bring a key to its newest state: of an ordered list of whole states the last alone, else all."""
    lists = listed_states(edges, key=key, source=source).select(key)
    last = edges.join(lists, key, "left_semi").groupBy(key).agg(F.max(order).alias(order))
    return edges.join(last, [key, order], "left_semi").unionByName(edges.join(lists, key, "left_anti"))


def follow_redirects(edges: DataFrame, *, source: str, target: str, most_hops: int = 8) -> DataFrame:
    """Where each source ends up: final place, hops, and ok, cycle or too-many-hops.

    A walk that comes back to any place it has seen is a cycle, whether its source is in it or not. Each row
    holds its walk of ``most_hops`` + 1 places at most; each round puts walks behind walks, so their length
    doubles. Of several targets of a source the smallest is taken.
    """
    walks = kept(edges.groupBy(F.col(source).alias("src")).agg(F.min(target).alias("t")).select("src", F.array("src", "t").alias("path")))
    reach = 1
    while reach <= most_hops:
        onward = walks.select(F.col("src").alias("at"), F.slice("path", 2, most_hops + 1).alias("more"))
        both = walks.withColumn("at", F.element_at("path", -1)).join(onward, "at", "left")
        longer = F.slice(F.concat("path", F.coalesce("more", F.slice("path", 1, 0))), 1, most_hops + 2)
        longer = kept(both.select("src", longer.alias("path")))
        release(walks)
        walks, reach = longer, reach * 2
    seen_again = F.expr("get(filter(sequence(1, size(path) - 1), i -> array_position(path, path[i]) <= i), 0)")
    placed = walks.withColumn("again", seen_again).withColumn("hops", F.least(F.coalesce("again", F.size("path") - 1), F.lit(most_hops + 1)))
    state = F.when(F.col("hops") > most_hops, "too-many-hops").when(F.col("again").isNotNull(), "cycle").otherwise("ok")
    return placed.select(F.col("src").alias(source), F.expr("path[hops]").alias("final"), "hops", state.alias("state"))


def prefix_length(rows: DataFrame, *, key: str, index: str, start: int = 0) -> DataFrame:
    """How many whole numbers from ``start`` on each key has without a gap, by an anti join."""
    have = rows.select(key, F.col(index).cast("long").alias("i")).where(F.col("i") >= start).distinct()
    nexts = have.select(key, (F.col("i") - 1).alias("i"))
    ends = have.join(nexts, [key, "i"], "left_anti")
    has_start = have.groupBy(key).agg(F.min("i").alias("first"))
    first_end = ends.groupBy(key).agg(F.min("i").alias("end"))
    length = F.when(F.col("first") == start, F.col("end") - start + 1).otherwise(0).cast("long")
    keys = rows.select(key).distinct()
    joined = keys.join(has_start, key, "left").join(first_end, key, "left")
    return joined.select(key, F.coalesce(length, F.lit(0)).alias("prefix"))
