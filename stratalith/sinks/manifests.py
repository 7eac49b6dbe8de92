"""Writing manifests as JSON lines with a digest and a count, and sealing a folder of them."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.canon import canonical_json
from .checkpoints import kept


#: Lines that a part of a manifest holds at most.
PART_LINES = 200_000


def manifest_parts(spark, path: str) -> DataFrame:
    """(part, records, sha256, whole) of each file of a manifest, of its bytes as they are; whole: its last
    line is closed. A part holds PART_LINES lines at most, so a task reads no more at once."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    newline = F.expr("length(content) - length(translate(decode(content, 'ISO-8859-1'), '\n', ''))")
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("part"),
        newline.cast("long").alias("records"),
        F.sha2("content", 256).alias("sha256"),
        ((F.length("content") == 0) | (F.expr("right(decode(content, 'ISO-8859-1'), 1)") == "\n")).alias("whole"),
    )


def manifest_reference(parts: DataFrame) -> DataFrame:
    """One row (records, digest) for ordered parts: the SHA-256 of a single part's bytes; of several, that of a
    line ``sha256 records`` for each in order of their names. Anyone can take both from the published files."""
    held = parts.where("records > 0")
    lines = F.array_sort(F.collect_list(F.struct("part", "sha256", "records")))  # one for each PART_LINES lines
    whole = F.array_join(F.transform(lines, lambda x: F.concat_ws(" ", x["sha256"], x["records"].cast("string"))), "\n")
    one = F.when(F.count("*") == 1, F.first("sha256")).when(F.count("*") == 0, F.sha2(F.lit(""), 256))
    return held.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.coalesce(one, F.sha2(F.concat(whole, F.lit("\n")), 256)).alias("digest"))


def write_manifest(rows: DataFrame, path: str, *, order: list[str], part_lines: int = PART_LINES) -> dict:
    """Write rows as canonical lines, ordered over all files, and return {records, digest}.

    Spark's commit makes the files appear at once; the digest is taken from what was written.
    """
    line = F.rtrim(canonical_json({c: F.col(c) for c in rows.columns}), F.lit("\n"))
    lines = rows.orderBy(*(F.asc_nulls_first(c) for c in order)).select(line.alias("value"))
    lines.write.option("maxRecordsPerFile", part_lines).text(path)
    return manifest_reference(manifest_parts(rows.sparkSession, path)).first().asDict()


def descriptor_line(descriptor: dict) -> str:
    """The descriptor as one canonical line."""
    return json.dumps(descriptor, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False) + "\n"


def identity_digest(descriptor: dict, *, apart: tuple[str, ...] = ("id", "created_at")) -> str:
    """Digest of what a descriptor says, but for its own id and what changes with each run."""
    same = {k: v for k, v in descriptor.items() if k not in apart}
    return f"sha256:{hashlib.sha256(descriptor_line(same).encode()).hexdigest()}"


def write_seal(spark, path: str, descriptor: dict) -> str:
    """Put ``snapshot.json`` with its id, and READY with its digest, into a folder; READY comes last. Returns the id."""
    own = {**descriptor, "id": identity_digest(descriptor)}
    line = descriptor_line(own).encode()
    for name, data in (("snapshot.json", line), ("READY", f"sha256:{hashlib.sha256(line).hexdigest()}\n".encode())):
        file = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        out = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, False)
        out.write(bytearray(data))
        out.close()
    return own["id"]


def seal_errors(spark, path: str) -> DataFrame:
    """(error_code) of a sealed folder: READY that is not the descriptor's digest, a descriptor that is not canonical,
    an id that is not that of its content."""
    files = spark.read.format("binaryFile").load([f"{path}/snapshot.json", f"{path}/READY"])
    found = {r["path"].rsplit("/", 1)[1]: bytes(r["content"]) for r in files.collect()}  # two small files
    line = found["snapshot.json"]
    descriptor = json.loads(line)
    codes = [
        code
        for code, fine in (
            ("ready", found["READY"] == f"sha256:{hashlib.sha256(line).hexdigest()}\n".encode()),
            ("not-canonical", line == descriptor_line(descriptor).encode()),
            ("identity", descriptor.get("id") == identity_digest(descriptor)),
        )
        if not fine
    ]
    return spark.createDataFrame([(c,) for c in codes], "error_code string")


def seal(spark, staging: str, final: str) -> None:
    """Move a finished folder into place; a folder that is there already is an error."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(staging), hadoop.Path(final)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise FileExistsError(final)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"cannot move {staging} to {final}")


def put_blobs(blobs: DataFrame, path: str, *, content: str) -> DataFrame:
    """Add contents to a store partitioned by the first two digits of their SHA-256; those already there
    are left out. Returns the digests that were new."""
    own = blobs.select(F.sha2(content, 256).alias("digest"), F.col(content).alias("content")).dropDuplicates(["digest"])
    own = own.withColumn("prefix", F.substring("digest", 1, 2))
    spark = blobs.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        own = own.join(spark.read.parquet(path).select("prefix", "digest"), ["prefix", "digest"], "left_anti")
    batch = f"{path}/../.incoming-{uuid.uuid4().hex}"
    own.write.partitionBy("prefix").parquet(batch)
    added = spark.read.parquet(batch)
    added.write.mode("append").partitionBy("prefix").parquet(path)
    digests = kept(added.select("digest"))
    incoming = spark._jvm.org.apache.hadoop.fs.Path(batch)
    incoming.getFileSystem(spark._jsc.hadoopConfiguration()).delete(incoming, True)
    return digests
