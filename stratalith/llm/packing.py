"""Operator 2: packing of token sequences by shortest-pack-first over the length histogram.

Each document is tokenized once and cut into pieces: full sequences and one rest. Only the histogram of
piece lengths (one row for each length, so as many as a sequence has tokens at most) goes to the driver.
There, lengths are placed longest first: all pieces of a length go to the open packs with most space
left, in counts, so the work follows the number of different lengths and not of documents. What comes
back is a list of patterns with counts; each entry says which ranks of a length fill which place of
which sequences. Pieces get their rank within their length by counts over hashed buckets, so a length
that a third of all pieces share is ranked in many tasks, and join the entries by length and rank.

A sequence is padded to full length unless its tokens number a power of two.

Nulls, empties: a null text counts as empty and gives the end token alone. Repeated rows are packed
apart. A null id is packed like any other.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Callable
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_arrow, materialize, table

SEQUENCE, END_TOKEN = 2048, 1


@cache
def encoder(vocabulary: str) -> Callable[[str], np.ndarray]:
    """The ids of a text by a byte-level vocabulary of public_tokenizers.

    Read as ranks, which gives the ids of the tokenizers file of the same name at a third of its
    time; the tests hold one against the other. Strings of the file's added tokens get those tokens' ids.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as file:
        added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    path = public_tokenizers.path(vocabulary.replace(".json", ".tiktoken"))
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


def cut(ids: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of each piece of a document's ids."""
    data = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
    return [
        (at, min(size, len(ids) - at), zlib.crc32(data[4 * at : 4 * (at + size)])) for at in range(0, len(ids), size)
    ]


def token_pieces(docs: DataFrame, *, id_col: str, text_col: str, size: int, end_token: int, vocabulary: str) -> DataFrame:
    """One row for each piece: id, start, length, ids_crc32, doc_tokens; and turn, which tells repeated rows apart."""

    def work(ids: list, texts: list) -> list:
        encode = encoder(vocabulary)
        out: list[list] = [[], [], [], [], [], []]
        for turn, (key, text) in enumerate(zip(ids, texts, strict=True)):
            tokens = np.append(encode((text or b"").decode("utf-8", "replace")), np.uint32(end_token))
            for start, length, crc in cut(tokens, size):
                for column, value in zip(out, (key, start, length, crc, len(tokens), turn), strict=True):
                    column.append(value)
        return out

    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, start long, length long, ids_crc32 long, doc_tokens long, turn int"
    return map_arrow(docs.select(id_col, text_col), work, schema)


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """Patterns (count, lengths in order of placing), by shortest-pack-first.

    ``open_packs[space]`` lists [count, lengths] of packs with that space left. Pieces of a length
    fill the packs with most space; a pack group larger than needed is split.
    """
    open_packs: dict[int, list[list]] = {}

    def put(space: int, group: list) -> None:
        open_packs.setdefault(space, []).append(group)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        placed: list[tuple[int, list]] = []
        while left:
            space = max(open_packs, default=0)
            if space >= length:
                group = open_packs[space].pop()
                if not open_packs[space]:
                    del open_packs[space]
                used = min(left, group[0])
                if group[0] > used:
                    put(space, [group[0] - used, group[1]])
                placed.append((space - length, [used, [*group[1], length]]))
                left -= used
            elif any(space >= length for space, _ in placed):
                for group in placed:
                    put(*group)
                placed = []
            else:  # no pack has room: new ones, which take as many of this length as they hold
                each = size // length
                for count, n in ((left // each, each), (1, left % each)):
                    if count and n:
                        placed.append((size - n * length, [count, [length] * n]))
                left = 0
        for group in placed:
            put(*group)
    return [(count, lengths) for groups in open_packs.values() for count, lengths in groups]


def place_entries(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence, offset) of each place in each pattern."""
    next_rank: dict[int, int] = {}
    entries, sequence = [], 0
    for count, lengths in sorted(patterns, key=lambda p: (-sum(p[1]), p[1])):
        offset = 0
        for length in lengths:
            rank = next_rank.get(length, 0)
            entries.append((length, rank, count, sequence, offset))
            next_rank[length] = rank + count
            offset += length
        sequence += count
    return entries


def pack_pieces(pieces: DataFrame, *, size: int = SEQUENCE, order: tuple[str, ...]) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` of 1 to ``size``.

    ``order``: columns that tell pieces of one length apart. ``pieces`` is read twice: give a table.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    entries = place_entries(pack_histogram(histogram, size))
    places = spark.createDataFrame(
        entries or [(0, 0, 0, 0, 0)], "e_length long, first_rank long, n_ranks long, first_sequence long, offset long"
    )
    # the most common length in as many buckets as a bucket then has rows
    buckets = max(1, math.isqrt(max(histogram.values(), default=1)))
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranks_before"))
    within = Window.partitionBy("length", "bucket").orderBy(*order)
    ranked = (
        keyed.withColumn("rank", F.row_number().over(within) - 1)
        .join(counts, ["length", "bucket"])
        .withColumn("rank", F.col("rank") + F.col("ranks_before"))
    )
    # The entries number a few for each length, whatever the documents: they may be broadcast.
    fits = (F.col("length") == F.col("e_length")) & (F.col("rank") >= F.col("first_rank")) & (
        F.col("rank") < F.col("first_rank") + F.col("n_ranks")
    )
    return (
        ranked.join(F.broadcast(places), fits)
        .withColumn("sequence_id", F.col("first_sequence") + F.col("rank") - F.col("first_rank"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE,
    end_token: int = END_TOKEN,
    vocabulary: str = "byte_bpe_50k.json",
) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    pieces = token_pieces(docs, id_col=id_col, text_col=text_col, size=size, end_token=end_token, vocabulary=vocabulary)
    pieces = materialize(pieces, "pieces")
    return pack_pieces(pieces, size=size, order=(id_col, "start", "ids_crc32", "doc_tokens", "turn")).drop("turn")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op2_packing": op2_packing}
