"""Operator 6: near-duplicates by SimHash fingerprints and vantage-point trees.

Documents become fingerprints of 64 bits. Two fingerprints within ``radius`` bits are linked; the links'
components are the groups. Equal fingerprints are folded into one class first, whatever its size.

Pairs are found exactly by vantage-point trees. A fingerprint is seen as ``blocks`` parts; a pair within
``radius`` differs in at most ``radius // blocks`` bits on one part at least. A part is seen as pieces, one more
than that radius, so a pair is equal on one piece at least. Each piece has a tree, on the Hamming distance
over it: a vantage point parts fingerprints by their distance at a median. Two that are equal on the piece are
never parted, so a class lies in one shard of each tree, however many shards there are. Where no point parts a
piece any more, the tree goes on over the whole part; those inside that lie within the part's radius of the
boundary then go to the outer side as well, since by the triangle inequality only they can have a partner there.

The top levels of the trees are grown from a sample of classes (``SAMPLE``, or PER_SHARD for each shard if that is
more) and cut all classes into shards; only a piece's value that OVERSIZE // 2 shards hold is cut over the part
there, with copies. Within a shard the tree goes on, down to leaves that are compared by XOR. The sample only
steers the cut: every class is placed, and no pair is lost whatever the sample was. A shard that no vantage point
could part is cut into chunks, and each two chunks are compared in a task of their own.

A shard returns a spanning forest of the links that it finds, never all pairs, so a dense group of n
fingerprints gives n - 1 rows. Components are joined over all shards by contraction in shared tables.

Nulls, empties: a null or empty text has fingerprint zero. Rows with a null id get a fingerprint and
take part in no group but their fingerprint's: component_id is the smallest id there is in it, or null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_ASCII, arrow_type, connected_components, join_classes, map_arrow, materialize, small_side, table

SEED, SHINGLE, RADIUS, BLOCKS = 42, 3, 3, 2
#: Classes in the sample that steers the cut, classes that a shard should hold, classes that a leaf compares at once.
SAMPLE, SHARD_CLASSES, LEAF = 20_000, 32_000, 256
#: Classes in the sample for each shard at least; shards of more than OVERSIZE times their classes are cut.
PER_SHARD, OVERSIZE = 8, 4
#: Documents and runs that one side of a comparison of sets holds.
TILE, TILE_RUNS = 1_000, 1_000_000


def shingle_hashes(text: bytes | None, width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, repeats included; of the whole if there are fewer."""
    import xxhash

    words = (text or b"").translate(LOWER_ASCII).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    hash_of = xxhash.xxh64_intdigest
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    spans = zip(starts, starts[width:], strict=False)
    return np.fromiter((hash_of(joined[a : b - 1], SEED) for a, b in spans), np.uint64, len(words) - width + 1)


def majority_bits(hashes: np.ndarray) -> int:
    """64 bits, each set if it is set in over half the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8)
        counts += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def remix(hashes: np.ndarray, round_: int) -> np.ndarray:
    """Other hashes of the same shingles: round 0 as they are, each further one mixed anew."""
    if not round_:
        return hashes
    x = hashes + np.uint64(0x9E3779B97F4A7C15 * round_ & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, *, id_col: str, text_col: str, width: int = SHINGLE) -> DataFrame:
    """id and ``fps``: an array of one fingerprint as a signed long."""

    def work(ids: list, texts: list) -> list:
        return [ids, [[signed(majority_bits(shingle_hashes(text, width)))] for text in texts]]

    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, fps array<long>"
    return map_arrow(docs.select(id_col, text_col), work, schema)


def masks(blocks: int) -> list[int]:
    """The bits of each part."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]


def pieces(part: int, radius: int) -> list[int]:
    """The bits of each piece of a part: two within the radius on it are within ``radius // len(pieces)`` on a piece."""
    bits = [1 << k for k in range(64) if part >> k & 1]
    n = min(radius + 1, len(bits))
    return [sum(bits[len(bits) * k // n : len(bits) * (k + 1) // n]) for k in range(n)]


def distance(fps: np.ndarray, point: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((fps ^ point) & mask)


def boundary(d: np.ndarray, radius: int) -> int | None:
    """A boundary that makes the larger side smallest, copies counted; None if none makes it shrink."""
    counts = np.bincount(d, minlength=66)
    inside = np.cumsum(counts)
    lower = np.concatenate([np.zeros(radius, inside.dtype), inside[: len(inside) - radius]])
    larger = np.maximum(inside, len(d) - lower)
    best = int(np.argmin(larger))
    return best if larger[best] <= 0.9 * len(d) else None


def grow(fps: np.ndarray, mask: np.uint64, radius: int, most: int, rng: np.random.Generator) -> tuple | None:
    """Top of a tree over a sample: (vantage point, boundary, inner, outer), None for a leaf."""
    if len(fps) <= most:
        return None
    for point in rng.choice(fps, min(3, len(fps)), replace=False):
        d = distance(fps, point, mask)
        at = boundary(d, radius)
        if at is not None:
            inner, outer = fps[d <= at], fps[d > at - radius]
            return int(point), at, grow(inner, mask, radius, most, rng), grow(outer, mask, radius, most, rng)
    return None


def route(fps: np.ndarray, tree: tuple | None, mask: np.uint64, radius: int) -> list[tuple[int, np.ndarray]]:
    """(leaf number, places) of the fingerprints in each leaf of a grown tree, overlaps included."""
    found: list[tuple[int, np.ndarray]] = []
    number = 0

    def walk(node: tuple | None, at: np.ndarray) -> None:
        nonlocal number
        if node is None:
            if len(at):
                found.append((number, at))
            number += 1
            return
        point, edge, inner, outer = node
        d = distance(fps[at], np.uint64(point), mask)
        walk(inner, at[d <= edge])
        walk(outer, at[d > edge - radius])

    walk(tree, np.arange(len(fps)))
    return found


class Forest:
    """Union-find over places; ``link`` gives those of the pairs that join two trees."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        up = self.up[at]
        while (further := self.up[up]).tobytes() != up.tobytes():
            up = further
        self.up[at] = up
        return up

    def root(self, x: int) -> int:
        while self.up[x] != x:
            x = int(self.up[x])
        return x

    def link(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        if not len(a):
            return []
        p, q = self.roots(a), self.roots(b)
        apart = np.flatnonzero(p != q)
        a, b, p, q = a[apart], b[apart], p[apart], q[apart]
        key = np.minimum(p, q) * len(self.up) + np.maximum(p, q)
        _, first = np.unique(key, return_index=True)
        first.sort()  # pairs come closest first and are taken so
        made = []
        for i in first.tolist():
            x, y = self.root(int(a[i])), self.root(int(b[i]))
            if x != y:
                self.up[max(x, y)] = min(x, y)
                made.append((int(a[i]), int(b[i])))
        return made


def links_within(fps: np.ndarray, cuts: list[tuple[int, int]], close, forest: Forest, rng: np.random.Generator) -> list[tuple[int, int]]:
    """Forest links among fingerprints of a shard: the tree goes on until leaves are small.

    ``cuts`` are (mask, radius): the next is taken where no point parts by the one before. ``close(a, b)`` gives those of the pairs of places a and b that are linked, and their distances. Of
    a leaf's pairs the closest are linked first.
    """
    made: list[tuple[int, int]] = []
    stack = [(np.arange(len(fps)), 0)]
    while stack:
        at, k = stack.pop()
        if len(at) > LEAF and k < len(cuts):
            mask, radius = cuts[k]
            for point in rng.choice(at, min(3, len(at)), replace=False):
                d = distance(fps[at], fps[point], np.uint64(mask))
                edge = boundary(d, radius)
                if edge is not None:
                    stack += [(at[d <= edge], k), (at[d > edge - radius], k)]
                    break
            else:
                stack.append((at, k + 1))
            continue
        for i in range(0, len(at), LEAF):
            for j in range(0, i + 1, LEAF):
                a, b = at[i : i + LEAF], at[j : j + LEAF]
                x, y, far = close(a, b)
                order = np.argsort(far, kind="stable")
                if i == j:
                    order = order[x[order] > y[order]]
                made += forest.link(a[x[order]], b[y[order]])
    return made


def near_links(
    classes: DataFrame, *, radius: int = RADIUS, blocks: int = BLOCKS, part_radius: int | None = None, sketch_radius: int | None = None
) -> DataFrame:
    """Links (a, b) between classes (rep long, fps array<long>): a spanning forest of each shard.

    Each fingerprint has its trees: a pair is linked if one of them is within ``radius``. With ``part_radius``, that one must
    have a part within it, too (radius // blocks, which any pair within the radius has on a part, if None). With
    ``sketch_radius``, all fingerprints of the pair must differ in so many bits at most together.

    ``classes`` is read four times: give a table.
    """
    spark = classes.sparkSession
    n = classes.count()
    first = classes.first()
    columns = 0 if first is None else len(first["fps"])
    wanted = max(SAMPLE, PER_SHARD * n // SHARD_CLASSES)
    sample = classes.sample(min(1.0, wanted / n), 7).select("fps").collect() if n > SHARD_CLASSES else []
    part_radius = radius // blocks if part_radius is None else part_radius
    most = max(2, SHARD_CLASSES * len(sample) // max(n, 1))
    rng = np.random.default_rng(7)
    trees = []
    for column in range(columns):
        seen = np.array([r["fps"][column] for r in sample], np.int64).view(np.uint64)
        for part in masks(blocks):
            for piece in (own := pieces(part, part_radius)):
                cuts = [(piece, part_radius // len(own)), (part, part_radius)]
                top = grow(seen, np.uint64(piece), cuts[0][1], most, rng)
                # values that hold far too many go on over the part
                full = {leaf: at for leaf, at in route(seen, top, np.uint64(piece), cuts[0][1]) if len(at) > OVERSIZE // 2 * most}
                trees.append((column, cuts, top, {leaf: grow(seen[at], np.uint64(part), part_radius, most, rng) for leaf, at in full.items()}))
    sent = spark.sparkContext.broadcast(trees)
    placed_schema = "shard long, rep long, fps array<long>"
    placed_arrow, tally_arrow = arrow_type(placed_schema), arrow_type("shard long, n long")

    def places(fps: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Shards in tree t, and the places of the fingerprints that go there: a shard is named by its tree, leaf and branch."""
        column, ((piece, reach), (part, beyond)), top, further = sent.value[t]
        own = np.ascontiguousarray(fps[:, column]).view(np.uint64)
        shards, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for leaf, at in route(own, top, np.uint64(piece), reach):
            for branch, among in route(own[at], further.get(leaf), np.uint64(part), beyond):
                shards.append(np.full(len(among), t << 48 | leaf << 24 | branch))
                found.append(at[among])
        return np.concatenate(shards), np.concatenate(found)

    def fps_of(batch: pa.RecordBatch, column: int) -> np.ndarray:
        return batch.column(column).flatten().to_numpy().reshape(batch.num_rows, -1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            fps = fps_of(batch, 1)
            for t, (column, *_) in enumerate(sent.value):
                shards, at = places(fps, t)
                own = (fps if sketch_radius is not None else fps[:, [column]])[at]  # a shard needs no others without a sketch
                offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * own.shape[1])
                lists = pa.ListArray.from_arrays(offsets, pa.array(own.ravel())).cast(placed_arrow.field(2).type)
                yield pa.RecordBatch.from_arrays([pa.array(shards), batch.column(0).take(pa.array(at)), lists], schema=placed_arrow)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for t in range(len(sent.value)):
                    shards, counts = np.unique(places(fps_of(batch, 0), t)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(shards), pa.array(counts.astype(np.int64))], schema=tally_arrow)

    out = arrow_type("a long, b long")

    def compare(shard: pa.Table) -> pa.Table:
        column, cuts, *_ = sent.value[shard.column("shard")[0].as_py() >> 48]
        part = np.uint64(cuts[1][0])
        reps = shard.column("rep").to_numpy()
        flat = shard.column("fps").combine_chunks()
        flat = flat.flatten().to_numpy().reshape(len(reps), -1).view(np.uint64)
        own = np.ascontiguousarray(flat[:, column if sketch_radius is not None else 0])

        def close(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            bits = own[a][:, None] ^ own[b][None, :]
            apart = np.bitwise_count(bits)
            x, y = np.nonzero((apart <= radius) & (np.bitwise_count(bits & part) <= part_radius))
            if sketch_radius is None:
                return x, y, apart[x, y]
            differ = np.bitwise_count(flat[a[x]] ^ flat[b[y]]).sum(axis=1, dtype=np.int32)
            near = differ <= sketch_radius
            return x[near], y[near], differ[near]

        made = links_within(own, cuts, close, Forest(len(own)), np.random.default_rng(7))
        pairs = np.array(made, np.int64).reshape(-1, 2)
        return pa.Table.from_arrays([pa.array(reps[pairs[:, 0]]), pa.array(reps[pairs[:, 1]])], schema=out)

    placed = classes.select("rep", "fps").mapInArrow(place, placed_schema)
    if n <= OVERSIZE * SHARD_CLASSES:
        return placed.groupBy("shard").applyInArrow(compare, "a long, b long")
    sizes = classes.select("fps").mapInArrow(tally, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n"))
    # fewer than one for each SHARD_CLASSES classes
    large = sizes.where(F.col("n") > OVERSIZE * SHARD_CLASSES).select("shard", F.ceil(F.col("n") / SHARD_CLASSES).alias("chunks"))
    large = materialize(large, "large-shards")
    if large.isEmpty():
        return placed.groupBy("shard").applyInArrow(compare, "a long, b long")
    own = "pmod(xxhash64(rep), chunks)"
    pairs = F.expr(
        f"""CASE WHEN chunks IS NULL THEN array(struct(-1L AS one, -1L AS other)) ELSE transform(filter(sequence(0L, chunks - 1), j -> j <> {own}),
          j -> struct(least(j, {own}) AS one, greatest(j, {own}) AS other)) END"""
    )
    placed = placed.join(F.broadcast(large), "shard", "left").select("shard", "rep", "fps", F.explode(pairs).alias("to"))
    return placed.select("shard", "to.*", "rep", "fps").groupBy("shard", "one", "other").applyInArrow(compare, "a long, b long")


def similar_pairs(at: np.ndarray, runs: np.ndarray, m: int, least: float, forest: Forest) -> list[tuple[int, int]]:
    """Forest links among ``m`` sets that share ``least`` or more: set ``at[i]`` holds ``runs[i]``, each run once.

    Shared runs are counted exactly: by a matrix product for runs in many sets, pair by pair for others.
    """
    sizes = np.bincount(at, minlength=m)
    order = np.lexsort((at, runs))
    at, runs = at[order], runs[order]
    _, starts, held = np.unique(runs, return_index=True, return_counts=True)
    number = np.repeat(np.arange(len(starts)), held)
    often = held * 8 > m
    shared = np.zeros((m, m), np.float32)
    dense = np.flatnonzero(often & (held > 1))
    for k in range(0, len(dense), 2048):
        block = dense[k : k + 2048]
        column = np.full(len(starts), -1)
        column[block] = np.arange(len(block))
        places = np.flatnonzero(column[number] >= 0)
        has = np.zeros((m, len(block)), np.float32)
        has[at[places], column[number[places]]] = 1
        shared += has @ has.T
    few = np.flatnonzero(~often[number] & (held[number] > 1))
    at, number = at[few], number[few]
    for apart in range(1, len(at)):
        same = number[apart:] == number[:-apart]
        if not same.any():
            break
        x, y = at[:-apart][same], at[apart:][same]
        np.add.at(shared, (x, y), 1)
        np.add.at(shared, (y, x), 1)
    made: list[tuple[int, int]] = []
    for lo in range(0, m, LEAF):
        own = shared[lo : lo + LEAF].astype(np.float64)
        x, y = np.nonzero(own >= least * (sizes[lo : lo + LEAF, None] + sizes[None, :] - own))
        x += lo
        made += forest.link(x[x > y], y[x > y])
    return made


def verified_links(links: DataFrame, docs: DataFrame, *, id_col: str, text_col: str, width: int, least: float) -> DataFrame:
    """Links between documents that share ``least`` or more of their different runs of ``width`` words.

    ``links`` need only join each pair in question by a path: all pairs within its components are
    compared, so a forest of candidates loses none. Small components share a task's group; one of more
    than TILE documents or TILE_RUNS runs is cut into chunks, and each two chunks are a group. A group returns a
    forest of verified links.

    Runs are compared by hashes of 32 bits. Only documents with a link are read as sets, and their texts
    are moved only if these are many; an id that repeats is read once.
    """
    members = small_side(connected_components(links).select(F.col("id").alias("end"), "component_id"))
    own = docs.select(F.col(id_col).cast("long").alias("end"), F.col(text_col).alias("words")).join(members, "end")

    def work(ids: list, components: list, texts: list) -> list:
        return [ids, components, [np.unique(shingle_hashes(t, width).astype(np.uint32)).view(np.int32) for t in texts]]

    sets = map_arrow(own.select("end", "component_id", "words"), work, "end long, component_id long, runs array<int>")
    sets = materialize(sets.dropDuplicates(["end"]), "runs")
    sizes = sets.groupBy("component_id").agg(F.count("*").alias("n"), F.sum(F.size("runs")).alias("runs"))
    chunks = F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("runs") / TILE_RUNS))
    large = small_side(sizes.withColumn("chunks", chunks).where("chunks > 1").select("component_id", "chunks"))
    total = sets.agg(F.count("*"), F.sum(F.size("runs"))).first()
    parts = max(1, -(-total[0] // TILE), -(-(total[1] or 0) // TILE_RUNS))
    groups = F.expr(
        f"""CASE WHEN chunks IS NULL
          THEN array(struct(pmod(xxhash64(component_id), {parts}) AS part, -1L AS one, -1L AS other))
          ELSE transform(filter(sequence(0L, chunks - 1), j -> j <> pmod(xxhash64(end), chunks)), j ->
            struct(component_id AS part, least(j, pmod(xxhash64(end), chunks)) AS one, greatest(j, pmod(xxhash64(end), chunks)) AS other)) END"""
    )
    placed = sets.join(large, "component_id", "left").select("end", "runs", F.explode(groups).alias("to")).select("to.*", "end", "runs")
    out = arrow_type("a long, b long")

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by("end")
        ends, runs = rows.column("end").to_numpy(), rows.column("runs").combine_chunks()
        at = np.repeat(np.arange(len(ends)), runs.value_lengths().to_numpy())
        made = similar_pairs(at, runs.flatten().to_numpy(), len(ends), least, Forest(len(ends)))
        pairs = np.array(made, np.int64).reshape(-1, 2)
        return pa.Table.from_arrays([pa.array(ends[pairs[:, 0]]), pa.array(ends[pairs[:, 1]])], schema=out)

    return placed.groupBy("part", "one", "other").applyInArrow(compare, "a long, b long")


def similar_documents(docs: DataFrame, *, id_col: str, text_col: str, width: int, least: float, rounds: int, **how) -> DataFrame:
    """component_id for each row: the smallest id reachable over pairs that share ``least`` or more of their
    different runs of ``width`` words; and runs_id, a digest of the set of its runs.

    Documents with equal sets of runs are one class. A class has ``rounds`` fingerprints of its runs, each run once, under
    other hashes each; the trees of ``near_links`` find the candidates among them, by its radii. Candidates are compared on
    their runs.
    """
    import xxhash

    def work(ids: list, texts: list) -> list:
        sets = [np.unique(shingle_hashes(t, width)) for t in texts]
        return [ids, [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], [[signed(majority_bits(remix(s, k))) for k in range(rounds)] for s in sets]]

    sets = map_arrow(docs.select(id_col, text_col), work, f"`{id_col}` {dict(docs.dtypes)[id_col]}, runs_id binary, fps array<long>")
    sets = materialize(sets, "run-sets")
    classes = sets.groupBy("runs_id", "fps").agg(F.min(id_col).cast("long").alias("rep"), F.count("*").alias("n")).where("rep IS NOT NULL")
    classes = materialize(classes, "classes")
    links = near_links(classes, **how)
    found = connected_components(verified_links(links, docs, id_col=id_col, text_col=text_col, width=width, least=least))
    named = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "runs_id", "n", F.coalesce("component_id", "rep").alias("component_id")
    )
    return join_classes(sets.select(id_col, "runs_id"), materialize(named, "named"), key="runs_id", size="n").select(id_col, "component_id", "runs_id")


def near_duplicates(fps: DataFrame, *, id_col: str, **how) -> DataFrame:
    """component_id for each row of (id, fps): the smallest id reachable over links."""
    fps = materialize(fps, "fingerprints")
    classes = fps.groupBy("fps").agg(F.min(id_col).cast("long").alias("rep"), F.count("*").alias("n")).where("rep IS NOT NULL")
    classes = materialize(classes, "classes")
    components = connected_components(near_links(classes, **how))
    named = classes.join(components.withColumnRenamed("id", "rep"), "rep", "left").select("fps", "n", F.coalesce("component_id", "rep").alias("component_id"))
    return join_classes(fps, materialize(named, "named"), key="fps", size="n").select(id_col, "fps", "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(fingerprints(docs, id_col="doc_id", text_col="text"), id_col="doc_id")
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.col("fps")[0]), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op6_simhash": op6_simhash}
