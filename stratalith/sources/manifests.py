"""Manifests as JSON lines: rows by a fixed schema, and what is wrong with the lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canon import canonical_json


def read_manifest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a manifest; a line that does not fit the schema raises when it is read."""
    lines = spark.read.text(path)
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("row")).select("row.*")


def manifest_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(value, error_code) of lines that are no JSON, lack a field, have one too many, or are not canonical."""
    names = sorted(schema.fieldNames())
    lines = spark.read.text(path).select("value", F.from_json("value", schema).alias("row"), F.from_json("value", "map<string,string>").alias("all"))
    canonical = canonical_json({f.name: F.col(f"row.{f.name}") for f in schema})
    required = [f.name for f in schema if not f.nullable]
    lacks = F.lit(False)
    for name in required:
        lacks = lacks | F.col(f"row.{name}").isNull()
    extra = F.size(F.array_except(F.map_keys("all"), F.array(*map(F.lit, names)))) > 0
    code = (
        F.when(F.col("all").isNull(), "not-json")
        .when(F.coalesce(extra, F.lit(False)), "unknown-field")
        .when(F.coalesce(lacks, F.lit(True)), "missing-field")
        .when(F.concat("value", F.lit("\n")) != canonical, "not-canonical")
    )
    return lines.select("value", code.alias("error_code")).where("error_code IS NOT NULL")


def verify_manifest(spark: SparkSession, path: str, *, digest: str, records: int) -> DataFrame:
    """(error_code) for a count or digest that differs from the declared one, or a part whose last line is open."""
    from ..sinks.manifests import manifest_parts, manifest_reference

    parts = manifest_parts(spark, path)
    found = manifest_reference(parts).crossJoin(parts.agg(F.coalesce(F.bool_and("whole"), F.lit(True)).alias("whole")))  # a row each
    checks = F.array_compact(
        F.array(
            F.when(F.col("records") != records, F.lit("record-count")),
            F.when(F.col("digest") != digest, F.lit("digest")),
            F.when(~F.col("whole"), F.lit("open-line")),
        )
    )
    return found.select(F.explode(checks).alias("error_code"))
