"""Stages that are computed once for each digest of their inputs and kept as tables."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def stage_digest(name: str, version: int, params: dict, upstream: list[str]) -> str:
    """Digest of what a stage's result depends on."""
    body = {"name": name, "params": params, "upstream": upstream, "version": version}
    return hashlib.sha256((json.dumps(body, sort_keys=True, separators=(",", ":"), allow_nan=False) + "\n").encode()).hexdigest()


def checkpointed(spark: SparkSession, root: str, digest: str, compute: Callable[[], DataFrame]) -> tuple[DataFrame, bool]:
    """The stage's table, and whether it was there already. A table counts once its commit mark is there."""
    path = f"{root}/{digest}"
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    reused = mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)
    if not reused:
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), reused


def kept(df: DataFrame) -> DataFrame:
    """The table, written beside the checkpoints and read back: rows and ids made by place stay as they are.

    It goes when the session's JVM ends, or by ``release``.
    """
    spark = df.sparkSession
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="stratalith-")
        spark.sparkContext.setCheckpointDir(where)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{where.rstrip('/')}/table-{uuid.uuid4().hex}")
    df.write.parquet(path.toString())
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    table = spark.read.schema(df.schema).parquet(path.toString())
    table._kept_at = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables of ``kept`` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_kept_at", None)
        if path is not None:
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
