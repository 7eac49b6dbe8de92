"""A corpus pipeline over the documents table: each stage is written and read again as the next one's input.

Stages: toxic documents go; of near-duplicates one stays; documents that hold test items go; personal
data is replaced; what is left is packed into sequences. A stage takes (spark, docs, sf_dir) and returns
documents with the columns it got, but for the last, which returns the placed pieces.

Documents are told apart by doc_id. Of rows that repeat one and hold the same runs of words, near-dedup keeps one;
if they hold different ones it keeps one for each text, as no group can name them. Rows without one are kept by
it. Null texts count as empty; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalith.llm.common import discard, materialize, small_side, table
from stratalith.llm.decontamination import find_contamination
from stratalith.llm.packing import pack_documents
from stratalith.llm.pii import redact, train_network
from stratalith.llm.simhash import similar_documents
from stratalith.llm.toxicity import drop_toxic, train_on

#: Near-duplicates share 0.8 or more of their different runs of five words. Candidates are found by SimHash fingerprints of
#: the runs and vantage-point trees: of ROUNDS fingerprints one has a quarter within PART_RADIUS bits and is within RADIUS
#: bits itself, and all differ in SKETCH_RADIUS bits together. Candidates are compared on the runs themselves.
SHINGLE, SIMILARITY, ROUNDS, RADIUS, BLOCKS, PART_RADIUS, SKETCH_RADIUS = 5, 0.8, 8, 20, 4, 1, 124


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose doc_id is not among the ids; those without one stay."""
    ids = small_side(ids.select("doc_id").where("doc_id IS NOT NULL").distinct())
    return docs.join(ids, "doc_id", "left_anti").select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return drop_toxic(docs, train_on(docs.select("doc_id", "text"), labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = similar_documents(
        docs.select("doc_id", "text"), id_col="doc_id", text_col="text", width=SHINGLE, least=SIMILARITY, rounds=ROUNDS,
        radius=RADIUS, blocks=BLOCKS, part_radius=PART_RADIUS, sketch_radius=SKETCH_RADIUS,
    )
    ids = groups.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("component_id").alias("component_id"), F.count("*").alias("n"), (F.min("runs_id") != F.max("runs_id")).alias("several")
    )
    ids = materialize(ids.where("doc_id <> component_id OR n > 1"), "groups")
    # most documents stay where they are; those whose id repeats come once, or once for each text
    repeated = small_side(ids.where("doc_id = component_id AND NOT several").select("doc_id"))
    once = docs.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)
    several = small_side(ids.where("several").select("doc_id"))
    each = docs.join(several, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns)
    return without(docs, ids).unionByName(once).unionByName(each)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return without(docs, find_contamination(docs.select("doc_id", "text"), items))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs, train_network(docs.select("doc_id", "text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

#: The stages train models and align texts, which SQL cannot express; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        last, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        discard(last)
    return docs
