"""What the operators of this subpackage share: tables, shared storage, Arrow mapping, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Upper to lower case for A-Z alone, on UTF-8 bytes; all other bytes stay.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where none is set, on one machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = f"file://{tempfile.mkdtemp(prefix='stratalith-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors.

    The files go when the session's JVM ends, or by ``discard``.
    """
    spark = df.sparkSession
    where = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(where)
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    written = spark.read.schema(df.schema).parquet(where)
    written._written_at = path
    return written


def discard(*written: DataFrame | None) -> None:
    """Delete tables of ``materialize`` whose readers are all written themselves."""
    for df in written:
        path = getattr(df, "_written_at", None)
        if path is not None:
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: A key with more than 1/HOT of all rows (so HOT - 1 keys at most) is joined by broadcast.
HOT = 64


def join_classes(rows: DataFrame, classes: DataFrame, *, key: str, size: str) -> DataFrame:
    """Rows with the columns of their class, null without one. ``classes`` has one row for each key, which
    ``size`` rows hold: keys with a large share are joined by broadcast, the others by a shuffle."""
    total = classes.agg(F.sum(size)).first()[0] or 0
    hot = F.broadcast(classes.where(F.col(size) * HOT > total))
    cold = classes.where(F.col(size) * HOT <= total)
    rest = rows.join(hot.select(key), key, "left_anti").join(cold, key, "left")
    return rows.join(hot, key).unionByName(rest)


#: Ids of one column that may be broadcast (8 MB); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def small_side(ids: DataFrame) -> DataFrame:
    """A written table of ids, marked for broadcast if it was counted and found small."""
    ids = materialize(ids, "ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def arrow_type(schema: str | T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema))


#: Bytes of an Arrow batch: texts of any length then take a bounded share of a worker, and of its JVM.
BATCH_BYTES = 4 << 20


def in_batches(df: DataFrame) -> DataFrame:
    """The table, for mapping in Arrow: its session's batches are bounded by BATCH_BYTES, if they were larger."""
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    return df


def map_arrow(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Map batches in Arrow. ``work(*columns)`` gets the columns of one batch, strings as bytes
    (null: None), and returns one list or array for each output column."""
    out = T.StructType.fromDDL(schema)
    arrow = arrow_type(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = work(*(_plain(c) for c in batch.columns))
                arrays = [pa.array(v, type=f.type) for v, f in zip(made, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return in_batches(df).mapInArrow(run, out)


def _plain(column: pa.Array) -> list:
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return column.to_pylist()


def connected_components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Smallest id reachable over ``edges(a long, b long)``: rows ``(id, component_id)``.

    Rounds of contraction: each node points to its smallest neighbour, pointers are followed
    twice, edges are renamed and loops dropped, until no edge is left. Every round at least halves
    the nodes that still have edges, so rounds grow with the logarithm of the largest component.
    Edges and pointers stay in tables of the shared folder. Only nodes with an edge are returned;
    a null end is ignored.
    """
    both = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    live = materialize(both.where("a <> b").distinct(), "edges")
    found = None
    while not live.isEmpty():
        ends = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = ends.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("p"))
        once = materialize(up, "pointers")
        nxt = once.select(F.col("id").alias("p"), F.col("p").alias("pp"))
        up = materialize(once.join(nxt, "p").select("id", F.col("pp").alias("p")), "pointers")
        old_found, old_live = found, live
        found = (
            up.select("id", F.col("p").alias("component_id"))
            if found is None
            else found.join(up.withColumnRenamed("id", "component_id"), "component_id", "left").select(
                "id", F.coalesce("p", "component_id").alias("component_id")
            )
        )
        found = materialize(found, "components")
        live = (
            live.join(up.select(F.col("id").alias("a"), F.col("p").alias("pa")), "a")
            .join(up.select(F.col("id").alias("b"), F.col("p").alias("pb")), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
        live = materialize(live, "edges")
        discard(once, up, old_found, old_live)
    if found is None:
        return live.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    return found
