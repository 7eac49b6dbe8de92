"""Operator 5: benchmark decontamination by n-gram seeds and Smith-Waterman alignment.

Test items are cut into runs of ``SEED_WORDS`` words (an item with fewer is one run). One pass over the
documents looks up every run of their words among the items' seeds and takes, for each document and item
that share a seed, the passages of the document around the diagonals of the shared seeds. However common its
seeds are, each passage is judged: it is aligned with its item by Smith-Waterman over words
(match 2, other word or gap -1), and the score as a share of the item's own decides. Only passages that hold
too few of the item's words for the least score in any order are not aligned, which loses none.
A copy that shares no run of ``SEED_WORDS`` words with its item is not seen.

An item of fewer than ``LEAST_WORDS`` words says little by itself: it is found only in documents of at most
twice as many words, such as one that is nothing but the item.

Documents are never shuffled: seeds and items go to the tasks. Items are taken in blocks of
``BLOCK_WORDS`` words at most, one pass for each block, so what is sent to tasks has a fixed bound however
large the benchmark is. No cap is set on documents, items or passages.

Nulls, empties: a null text counts as empty; an item without words, or with a null id, is left out.
Repeated documents give a row each for each item; the texts of items that repeat an id are items of their own, of which the best counts.
Returns one row for each document and item found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_type, in_batches, materialize, table
from .license_scan import WORD_BYTES

SEED_WORDS, LEAST_SCORE, LEAST_WORDS = 3, 0.5, 5
#: Words that a passage reaches beyond its item at least.
SLACK_WORDS = 4
BLOCK_WORDS = 2_000_000
#: Alignments that a task remembers.
MOST_KNOWN = 20_000
MATCH, MISMATCH, GAP = 2, -1, -1
_FACTORS = np.random.default_rng(5).integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits, in UTF-8."""
    return (text or "").lower().encode("utf-8", "replace").translate(WORD_BYTES).split()


class WordHashes(dict):
    """64-bit hash of each word, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, 11)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(hashes) - n + 1, n, np.uint64)
    for k in range(n):
        out = (out ^ (out >> np.uint64(29))) * _FACTORS[k] + hashes[k : len(hashes) - n + 1 + k]
    return out * _FACTORS[63]


class Seeds:
    """Items of a block with their seeds, as arrays: of each width the sorted seeds, and for each the items
    and places that hold it."""

    def __init__(self, items: list[tuple[int, list[bytes]]]) -> None:
        hashes = WordHashes()
        self.keys = [key for key, _ in items]
        self.sizes = np.array([len(words) for _, words in items], np.int64)
        self.words = [hashes.of(words) for _, words in items]
        self.widths: dict[int, tuple[np.ndarray, ...]] = {}
        for n in range(1, SEED_WORDS + 1):
            own = np.flatnonzero(np.minimum(self.sizes, SEED_WORDS) == n)
            if not len(own):
                continue
            parts = [runs(self.words[i], n) for i in own]
            seeds, item = np.concatenate(parts), np.repeat(own.astype(np.int32), [len(p) for p in parts])
            place = np.concatenate([np.arange(len(p), dtype=np.int32) for p in parts])
            order = np.argsort(seeds, kind="stable")
            known, starts, held = np.unique(seeds[order], return_index=True, return_counts=True)
            # a table of the top 20 bits lets nearly all runs go by
            seen = np.bincount((known >> np.uint64(44)).astype(np.int64), minlength=1 << 20) > 0
            self.widths[n] = (known, starts, held, item[order], place[order], seen)

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, diagonal, seed) of each place where a run of the document is one of an item."""
        found: list[tuple[np.ndarray, ...]] = []
        for n, (known, starts, held, item, place, seen) in self.widths.items():
            own = runs(hashes, n)
            at = np.flatnonzero(seen[(own >> np.uint64(44)).astype(np.int64)])
            near = np.minimum(np.searchsorted(known, own[at]), len(known) - 1)
            same = known[near] == own[at]
            at, near = at[same], near[same]
            if len(at):
                n_held = held[near]
                first = np.repeat(starts[near] - np.cumsum(n_held) + n_held, n_held)
                where = first + np.arange(len(first))
                found.append((item[where], np.repeat(at, n_held) - place[where], np.repeat(own[at], n_held)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(columns) for columns in zip(*found, strict=True))

    def passages(self, hashes: np.ndarray) -> list[tuple[int, list[tuple[int, int]], int]]:
        """(item, spans of words around its diagonals, count of its different seeds) for each item that shares one."""
        item, diagonal, seed = self.hits(hashes)
        fits = (self.sizes[item] >= LEAST_WORDS) | (len(hashes) <= 2 * self.sizes[item])
        item, diagonal, seed = item[fits], diagonal[fits], seed[fits]
        if not len(item):
            return []
        order = np.lexsort((seed, item))
        new = np.ones(len(item), bool)
        new[1:] = (np.diff(item[order]) != 0) | (np.diff(seed[order]) != 0)
        items, n_seeds = np.unique(item[order][new], return_counts=True)
        order = np.lexsort((diagonal, item))
        item, diagonal = item[order], diagonal[order]
        n = self.sizes[item]
        slack = np.maximum(SLACK_WORDS, n // 3)
        lo, hi = np.maximum(0, diagonal - slack), np.minimum(len(hashes), diagonal + n + slack)
        # of one item, ends grow with the diagonal: a span goes on while the next begins within it
        begins = np.ones(len(item), bool)
        begins[1:] = (item[1:] != item[:-1]) | (lo[1:] > hi[:-1])
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(item)) - 1
        spans: dict[int, list[tuple[int, int]]] = {}
        for i, a, b in zip(item[starts].tolist(), lo[starts].tolist(), hi[ends].tolist(), strict=True):
            spans.setdefault(i, []).append((a, b))
        return [(i, spans[i], k) for i, k in zip(items.tolist(), n_seeds.tolist(), strict=True)]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score of two word sequences, and how many words of each the best alignment ends at.

    Along a row, gaps are a running maximum of the score with its place taken off.
    """
    best, ends = 0, (0, 0)
    steps = -GAP * np.arange(1, len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    for i, word in enumerate(item):
        fresh = np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), row[1:] + GAP)
        fresh = np.maximum(np.maximum.accumulate(fresh + steps) - steps, 0)
        row[1:] = fresh
        j = int(fresh.argmax())
        if fresh[j] > best:
            best, ends = int(fresh[j]), (i + 1, j + 1)
    return best, *ends


def best_alignment(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Score as a share of the item's own, and the span of the passage's words."""
    score, i, j = align(item, passage)
    if not score:
        return 0.0, 0, 0
    _, _, back = align(item[:i][::-1], passage[:j][::-1])
    return score / (MATCH * len(item)), j - back, j


def may_reach(words: np.ndarray, n: np.ndarray, passage: np.ndarray, least: float) -> bool:
    """Whether a passage holds enough of an item's different words, which stand n times in it, in any order."""
    at = np.minimum(np.searchsorted(words, passage), len(words) - 1)
    held = np.bincount(at[words[at] == passage], minlength=len(words))
    return np.minimum(held, n).sum() >= least


def align_passages(docs: DataFrame, seeds, *, id_col: str, text_col: str, least_score: float) -> DataFrame:
    """The best passage of each document and item that share a seed, if it has the score."""
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, item_id long, score double, start_word long, end_word long, n_seeds long"
    arrow = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        known: dict = {}
        counted: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            out: list[list] = [[] for _ in arrow]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = hashes.of(words_of(text.as_py()))
                of_ids: dict[int, tuple] = {}  # an id's texts are items of their own; the best counts
                for i, spans, n_seeds in seeds.value.passages(own):
                    item = seeds.value.words[i]
                    if i not in counted:
                        counted[i] = np.unique(item, return_counts=True)
                    best = (0.0, 0, 0)
                    for start, end in spans:
                        passage = own[start:end]
                        if not may_reach(*counted[i], passage, least_score * len(item)):
                            continue
                        at = (i, passage.tobytes())
                        if at not in known:
                            if len(known) >= MOST_KNOWN:
                                known.clear()
                            known[at] = best_alignment(item, passage)
                        score, lo, hi = known[at]
                        best = max(best, (score, start + lo, start + hi))
                    if best[0] >= least_score:
                        item_id = seeds.value.keys[i]
                        of_ids[item_id] = max(of_ids.get(item_id, (0.0,)), (*best, n_seeds))
                for item_id, best in of_ids.items():
                    for column, value in zip(out, (key, item_id, *best), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, arrow, strict=True)], schema=arrow)

    return in_batches(docs.select(id_col, text_col)).mapInArrow(run, schema)


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """Rows (id, item_id, score, start_word, end_word, n_seeds) for each document that holds an item's
    words with a score of ``least_score`` or more; the best passage of each."""
    context = docs.sparkSession.sparkContext
    own = items.select(F.col(item_id_col).cast("long").alias("item"), F.col(item_text_col).alias("words")).where("item IS NOT NULL AND words IS NOT NULL")
    size = own.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = max(1, -(-size // (4 * BLOCK_WORDS)))
    found = None
    for block in range(blocks):
        rows = own.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).distinct().collect()
        texts = [(r["item"], words_of(r["words"])) for r in sorted(rows)]
        seeds = context.broadcast(Seeds([(k, w) for k, w in texts if w]))
        part = materialize(align_passages(docs, seeds, id_col=id_col, text_col=text_col, least_score=least_score), "contamination")
        found = part if found is None else found.unionByName(part)
    return found


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = find_contamination(docs, items)
    return found.select("doc_id", "item_id", F.round("score", 6).alias("score"), "start_word", "end_word", "n_seeds")


QUERIES = {"op5_decontamination": op5_decontamination}
