"""Operator 12: removal of repeated passages, found by fixed-block anchors and extended to maximal exact repeats.

A window is ``WINDOW`` words in a row; each word goes that is in a window whose words also start earlier. Blocks of
``BLOCK`` words that stand at multiples of ``BLOCK`` in a document are the anchors; as a window holds a whole one of them,
each later copy of it holds the same words at some place. So:

1. Documents are written in chunks, one for each Arrow batch, with texts packed.
2. Each chunk sends the hashes of all its rolling blocks, once each, to buckets by hash, marked where one stands at an
   anchor or twice in the chunk. A bucket answers for each hash if it is repeated anywhere, and if it is an anchor anywhere.
3. Hits are extended: a run of places whose blocks are all repeated, and that holds an anchor, is cut into
   windows. Each chunk sends the digest of each of these windows with its first place. A bucket answers which one is first of all.
4. In each chunk the windows that are not first are joined to maximal exact repeats, and their words go.

No pair of copies is ever made: a passage in m chunks costs m digests, and a bucket holds a digest once for each chunk,
so copies of one text or a line in a third of all rows spread evenly. Buckets are as many as their bytes ask for. What
repeats nowhere is sent in step 2 alone, as four bytes for each word.

Hashes of blocks only choose candidates: a false one costs work, no result. Windows are told apart by 64 bits beside the
bits that name their bucket; two different windows agree with a probability of 2^-64 over the number of buckets.

Defined results: words are runs of bytes other than space and the five controls from tab to return; a null text has none.
Documents stand in order of id, null ids last; rows that repeat an id are documents of their own, in order of a digest of
their texts, and equal ones by their place in the table, so that one of them stays. A text shorter than a window stays
whole. An empty table gives no rows. A task holds a chunk, of one Arrow batch, or one longer text; arrays take about
twenty times its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_type, discard, in_batches, materialize, table

WINDOW, BLOCK = 20, 10
#: Bytes of text for each bucket: its hashes take about as many.
BUCKET_BYTES = 8 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_MIX, _ODD = np.uint64(0xFF51AFD7ED558CCD), 0x9E3779B97F4A7C15
_CHUNK = "n_bytes long, ids binary, missing binary, sizes binary, texts binary"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX
    return h ^ (h >> np.uint64(29))


def word_hashes(texts: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word of the texts one after the other, number of words of each text).

    Words of 16 bytes or fewer are mixed from their own bytes, longer ones take XXH3.
    """
    data = np.frombuffer(texts, np.uint8)
    word = ~_SPACE[data]
    starts_text = np.concatenate([[0], np.cumsum(sizes)])
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edges = starts_text[:-1][sizes > 0]
    begins[edges] = word[edges]  # a text's first word is one of its own, whatever stands before it
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    last = starts_text[1:][sizes > 0] - 1
    ends[last] = word[last]
    starts, past = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    length = past - starts
    padded = np.frombuffer(texts + bytes(16), np.uint8)
    eight = np.ndarray((len(data) + 9,), "<u8", padded, strides=(1,))
    h = _mix((eight[starts] & _KEEP[np.minimum(length, 8)]) + length.astype(np.uint64) * np.uint64(_ODD))
    long = np.flatnonzero(length > 8)
    h[long] = _mix(h[long] + (eight[starts[long] + 8] & _KEEP[np.minimum(length[long] - 8, 8)]) * _MIX)
    for i in np.flatnonzero(length > 16):
        h[i] = xxhash.xxh3_64_intdigest(texts[starts[i] : past[i]])
    place = np.searchsorted(starts, starts_text)
    return h, np.diff(place)


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` words in a row, by doubling; the last places have none."""
    if len(words) < width:
        return words[:0]
    out, done, power, reach = None, 0, words, 1
    while reach <= width:
        if width & reach:
            part = power[done : len(words) - reach + 1]
            if out is None:
                out = part
            else:
                out = out[: len(part)] + part * np.uint64(pow(_ODD, done, 1 << 64))
            done += reach
        power = power[: len(power) - reach] + power[reach:] * np.uint64(pow(_ODD, reach, 1 << 64))
        reach *= 2
    return _mix(out[: len(words) - width + 1])


class Places:
    """Words of a chunk's texts with the places where windows and blocks may start."""

    def __init__(self, texts: bytes, sizes: np.ndarray, window: int, block: int) -> None:
        self.words, self.n_words = word_hashes(texts, sizes)
        self.past = np.cumsum(self.n_words)
        self.first = self.past - self.n_words
        self.text = np.repeat(np.arange(len(sizes)), self.n_words)
        self.left = self.past[self.text] - np.arange(len(self.words))  # words from here to the end of the text
        self.window, self.block = window, block

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, hashes, whether at an anchor) of rolling blocks."""
        h = rolling(self.words, self.block)
        at = np.flatnonzero(self.left[: len(h)] >= self.block)
        return at, h[at], (at - self.first[self.text[at]]) % self.block == 0

    def candidates(self, repeated: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, hashes, hashes of their own for buckets) of windows all of whose blocks are repeated, and one an
        anchor; given for each word."""
        h, blocks = rolling(self.words, self.window), rolling(self.words, self.block)
        at = np.flatnonzero(self.left[: len(h)] >= self.window)
        inner = self.window - self.block + 1
        for flags, least in ((repeated, inner), (anchor, 1)):
            n = np.concatenate([[0], np.cumsum(flags)])
            at = at[n[at + inner] - n[at] >= least]
        ends = _mix(blocks[at] ^ (blocks[at + self.window - self.block] * np.uint64(_ODD)))
        return at, h[at], ends


def buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket of each hash, by its upper 32 bits."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _pieces(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Ranges of equal values of a sorted array."""
    edges = np.flatnonzero(np.diff(bucket)) + 1
    for a, z in zip([0, *edges], [*edges, len(bucket)], strict=True):
        if z > a:
            yield int(bucket[a]), slice(a, z)


def write_chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A written table of chunks: an id, words, and the ids, sizes and packed texts of its documents."""
    arrow = arrow_type(_CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [t.as_py() for t in batch.column(1).cast(pa.large_binary())]
            sizes = np.array([len(t) for t in texts], np.int64)
            joined = b"".join(texts)
            ids, missing = np.asarray(batch.column(0).fill_null(0)), np.asarray(batch.column(0).is_null()).astype(np.uint8)
            row = [len(joined), ids.astype(np.int64).tobytes(), missing.tobytes(), sizes.tobytes(), pack.compress(joined)]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    chunks = in_batches(own).mapInArrow(run, _CHUNK)
    return materialize(chunks.select(F.monotonically_increasing_id().alias("chunk"), "*"), "chunks")


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    texts = zstandard.ZstdDecompressor().decompress(row["texts"]) if row["sizes"] else b""
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["missing"], np.uint8), np.frombuffer(row["sizes"], np.int64), texts


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _distinct_blocks(places: Places, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, each one's number among the keys, keys, whether twice, whether at an anchor): a key is the bucket and 32 bits."""
    at, h, anchored = places.blocks()
    keys = (buckets_of(h, buckets).astype(np.uint64) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
    keys, number, n = np.unique(keys, return_inverse=True, return_counts=True)
    anchor = np.zeros(len(keys), bool)
    anchor[number[anchored]] = True
    return at, number, keys, n > 1, anchor


def _send_blocks(chunks: DataFrame, buckets: int, window: int, block: int) -> DataFrame:
    schema = "bucket int, chunk long, hashes binary, twice binary, anchors binary"
    arrow = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, sizes, texts = _unpack(row)
                _, _, keys, twice, anchor = _distinct_blocks(Places(texts, sizes, window, block), buckets)
                sent = [
                    (b, row["chunk"], keys[s].astype(np.uint32).tobytes(), np.packbits(twice[s]).tobytes(), np.packbits(anchor[s]).tobytes())
                    for b, s in _pieces((keys >> np.uint64(32)).astype(np.int64))
                ]
                yield _emit(sent, arrow)

    return chunks.mapInArrow(run, schema)


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


def _answer_blocks(sent: DataFrame) -> DataFrame:
    schema = "chunk long, bucket int, repeated binary, anchors binary"
    arrow = arrow_type(schema)

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        parts = [np.frombuffer(r["hashes"], np.uint32) for r in rows]
        hashes, number, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        twice = np.concatenate([_bits(r["twice"], len(p)) for r, p in zip(rows, parts, strict=True)])
        at_anchor = np.concatenate([_bits(r["anchors"], len(p)) for r, p in zip(rows, parts, strict=True)])
        repeated, anchor = n > 1, np.zeros(len(hashes), bool)
        repeated[number[twice]] = True
        anchor[number[at_anchor]] = True
        out, a = [], 0
        for r, p in zip(rows, parts, strict=True):
            own = number[a : a + len(p)]
            a += len(p)
            out.append((r["chunk"], r["bucket"], np.packbits(repeated[own]).tobytes(), np.packbits(anchor[own]).tobytes()))
        return pa.Table.from_batches([_emit(out, arrow)])

    return sent.groupBy("bucket").applyInArrow(run, schema)


def _first_places(at: np.ndarray, hashes: np.ndarray, ends: np.ndarray, places: Places, order: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """Each different window of a chunk by its first place: (bucket, hash, place, number of each candidate), by bucket
    and then in the order of documents. ``order``: the rank of each document in the chunk."""
    by_place = np.lexsort((at, order[places.text[at]]))
    distinct, first, number = np.unique(hashes[by_place], return_index=True, return_inverse=True)
    bucket = buckets_of(ends[by_place][first], buckets)
    sent = np.lexsort((first, bucket))
    back = np.empty(len(sent), np.int64)
    back[sent] = np.arange(len(sent))
    of = np.empty(len(at), np.int64)
    of[by_place] = back[number]
    return bucket[sent], distinct[sent], at[by_place][first[sent]], of


def _ranks(ids: np.ndarray, missing: np.ndarray, sizes: np.ndarray, texts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(a digest of each text, each document's rank in the chunk)."""
    edges = np.concatenate([[0], np.cumsum(sizes)])
    view = memoryview(texts)
    ties = np.array([xxhash.xxh3_64_intdigest(view[a:z]) for a, z in zip(edges[:-1], edges[1:], strict=True)], np.uint64)
    order = np.empty(len(ids), np.int64)
    order[np.lexsort((ties, ids, missing))] = np.arange(len(ids))
    return ties, order


def _candidates(row: dict, answers: list[dict], buckets: int, window: int, block: int):
    ids, missing, sizes, texts = _unpack(row)
    places = Places(texts, sizes, window, block)
    at, number, keys, _, _ = _distinct_blocks(places, buckets)
    repeated, anchor = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    got = {r["bucket"]: r for r in answers}
    for b, s in _pieces((keys >> np.uint64(32)).astype(np.int64)):
        n = s.stop - s.start
        repeated[s], anchor[s] = _bits(got[b]["repeated"], n), _bits(got[b]["anchors"], n)
    flags = np.zeros((2, len(places.words)), bool)
    flags[0][at], flags[1][at] = repeated[number], anchor[number]
    return ids, missing, sizes, texts, places, *places.candidates(*flags)


def _send_windows(chunks: DataFrame, answers: DataFrame, buckets: int, window: int, block: int) -> DataFrame:
    schema = "bucket int, chunk long, hashes binary, docs binary, missing binary, ties binary, counts binary"
    arrow = arrow_type(schema)

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        sent = []
        for row in one.to_pylist():
            ids, missing, sizes, texts, places, at, hashes, ends = _candidates(row, other.to_pylist(), buckets, window, block)
            if not len(at):
                continue
            ties, order = _ranks(ids, missing, sizes, texts)
            bucket, hashes, first, _ = _first_places(at, hashes, ends, places, order, buckets)
            for b, s in _pieces(bucket):
                text = places.text[first[s]]
                runs = np.concatenate([[0], np.flatnonzero(np.diff(text)) + 1])
                of = text[runs]
                counts = np.diff(np.append(runs, len(text))).astype(np.uint32)
                sent.append((b, row["chunk"], hashes[s].tobytes(), ids[of].tobytes(), missing[of].tobytes(), ties[of].tobytes(), counts.tobytes()))
        return pa.Table.from_batches([_emit(sent, arrow)])

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def _answer_windows(sent: DataFrame) -> DataFrame:
    schema = "chunk long, bucket int, first binary"
    arrow = arrow_type(schema)

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        parts = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
        spread = lambda name, kind: np.concatenate(
            [np.repeat(np.frombuffer(r[name], kind), np.frombuffer(r["counts"], np.uint32)) for r in rows]
        )
        hashes = np.concatenate(parts)
        chunk = np.repeat(np.array([r["chunk"] for r in rows], np.int64), [len(p) for p in parts])
        # a chunk sends a window once, so no place within it is needed
        by = np.lexsort((chunk, spread("ties", np.uint64), spread("docs", np.int64), spread("missing", np.uint8), hashes))
        first = np.zeros(len(hashes), bool)
        ordered = hashes[by]
        first[by[np.concatenate([[True], ordered[1:] != ordered[:-1]])]] = True
        out, a = [], 0
        for r, p in zip(rows, parts, strict=True):
            out.append((r["chunk"], r["bucket"], np.packbits(first[a : a + len(p)]).tobytes()))
            a += len(p)
        return pa.Table.from_batches([_emit(out, arrow)])

    return sent.groupBy("bucket").applyInArrow(run, schema)


def _covered(starts: np.ndarray, n: int, width: int) -> np.ndarray:
    """Whether each of n words is within ``width`` words from a start."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps[:-1]) > 0


def _remove(chunks: DataFrame, answers: DataFrame, firsts: DataFrame, buckets: int, window: int, block: int) -> DataFrame:
    schema = "id long, n_words long, n_removed long, kept string, removed array<struct<first: long, past: long>>"
    arrow = arrow_type(schema)

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        batches = []
        both = other.to_pylist()
        for row in one.to_pylist():
            ids, missing, sizes, texts, places, at, hashes, ends = _candidates(row, [r for r in both if r["first"] is None], buckets, window, block)
            if len(at):
                _, order = _ranks(ids, missing, sizes, texts)
                bucket, distinct, first, of = _first_places(at, hashes, ends, places, order, buckets)
                is_first = np.zeros(len(distinct), bool)
                got = {r["bucket"]: r["first"] for r in both if r["first"] is not None}
                for b, s in _pieces(bucket):
                    is_first[s] = _bits(got[b], s.stop - s.start)
                at = at[~(is_first[of] & (first[of] == at))]
            gone = _covered(at, len(places.words), window)
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            # a repeat that ends where the next text's begins is two
            inner = places.first[(places.n_words > 0)]
            cut = inner[(inner > 0) & gone[np.minimum(inner, len(gone) - 1)] & gone[np.maximum(inner - 1, 0)]] if len(gone) else inner
            edges = np.sort(np.concatenate([edges, cut, cut])).reshape(-1, 2)
            owner = places.text[edges[:, 0]] if len(edges) else np.zeros(0, np.int64)
            bounds = np.searchsorted(owner, np.arange(len(ids) + 1))
            rows, a = [], 0
            for i, size in enumerate(sizes):
                words = texts[a : a + size].split()
                a += size
                spans = edges[bounds[i] : bounds[i + 1]] - places.first[i]
                if len(spans):
                    keep = ~gone[places.first[i] : places.past[i]]
                    words = compress(words, keep)
                kept = b" ".join(words)
                rows.append((None if missing[i] else int(ids[i]), int(places.n_words[i]), int((spans[:, 1] - spans[:, 0]).sum()), kept, [{"first": int(x), "past": int(y)} for x, y in spans]))
            batches.append(_emit(rows, arrow))
        return pa.Table.from_batches(batches, schema=arrow)

    marks = answers.withColumn("first", F.lit(None).cast("binary"))
    marks = marks.unionByName(firsts.select("chunk", "bucket", F.lit(None).cast("binary").alias("repeated"), F.lit(None).cast("binary").alias("anchors"), "first"))
    return chunks.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(run, schema)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(id, n_words, n_removed, kept, removed) of each document: the text of its kept words, and the maximal repeats that
    went, as ranges of words. ``block`` is at most (window + 1) / 2, so each window holds an anchor."""
    if 2 * block > window + 1:
        raise ValueError("a window must hold a whole block at a multiple of its width")
    spark = docs.sparkSession
    chunks = write_chunks(docs, id_col, text_col)
    n_bytes = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // BUCKET_BYTES))
    answers = materialize(_answer_blocks(_send_blocks(chunks, buckets, window, block)), "blocks")
    firsts = materialize(_answer_windows(_send_windows(chunks, answers, buckets, window, block)), "windows")
    found = materialize(_remove(chunks, answers, firsts, buckets, window, block), "repeats")
    discard(chunks, answers, firsts)
    return found


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op12_substrings": op12_substrings}

SQL = {
    "op12_substrings": f"""WITH d AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, md5(text)) AS r, doc_id,
  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT r, unnest(range(1, len(w) - {WINDOW} + 2)) AS s, w FROM d),
x AS (SELECT r, s, md5(array_to_string(w[s:s + {WINDOW - 1}], ' ')) AS h FROM p),
y AS (SELECT r, s, row_number() OVER (PARTITION BY h ORDER BY r, s) AS k FROM x),
word AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
gone AS (SELECT DISTINCT r, unnest(range(s, s + {WINDOW})) AS i FROM y WHERE k > 1),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""
}
