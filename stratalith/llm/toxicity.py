"""Operator 8: toxicity by a support vector machine on a subsequence string kernel.

The kernel of two words is the gap-weighted subsequence kernel: all common subsequences of three
letters, each weighted by ``DECAY`` to the power of the length that it spans, normalised. So a word with
letters left out or put in stays close to itself. Letters are lower-cased; digits and marks that stand
for letters are read as them; all other marks have no features of their own and only widen gaps. Runs
of single characters with spaces between are read as one word.

The machine is linear in Nyström features: kernels with landmark words, whitened by the landmarks' own
kernel matrix. It is trained on labelled sentences by rounds in the manner of multiple instances: a
sentence is as toxic as its most toxic word, and each toxic document puts forward the words that the
last round ranked highest, against all words of clean documents. A logistic curve over a document's three
highest sentence margins and its count of toxic sentences gives the score; it is fitted on documents
that the machine has not seen. Training takes ``TRAIN_ROWS`` labelled documents of ``TRAIN_BYTES`` together at
most, drawn by a hash of the id; all else covers every row.

As the kernel is a product of explicit features, the trained machine is one weight for each triple of
letters. Words are scored in numpy, each different word of a batch once. No rows are shuffled but to
join labels for training; whole texts are read.

Nulls, empties: a null or empty text has no sentences and gets the score of that, below every text with
a toxic word. Without labels of both kinds all scores are 0. Repeated rows get equal scores.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_type, discard, in_batches, materialize, table

ORDER, DECAY, WORD = 3, 0.6, 24
LETTERS = 40
START, END = "^", "$"
TRAIN_ROWS, LANDMARKS, NEGATIVES, ROUNDS, WITNESSES = 6_000, 240, 50_000, 3, 3
#: Bytes of text that training takes to the driver.
TRAIN_BYTES = 48_000_000
#: Least log ratio of a word's shares of toxic and of clean documents to be put forward.
LEAST_ODDS = 2.0
THRESHOLD = 0.7
#: Words that a task keeps scores of.
KEPT_WORDS = 250_000

_SENTENCE = re.compile(r"(?<=[.!?])\s+|[\r\n]+")
_SPACED = re.compile(r"(?<!\S)\S(?: \S){3,}(?!\S)")
_LOOKS_LIKE = str.maketrans("013457@$", "oieastas", "^")
_ENDS = ".,;:!?()[]{}<>\"'`*_~|#%&-+=^$/\\"


@cache
def letter_codes() -> np.ndarray:
    """Code of each code point: a-z 0 to 25, other letters 26 to 37 by remainder, word ends 38 and 39, else -1."""
    codes = np.full(0x3000, -1, np.int16)
    for c in range(0x3000):
        letter = chr(c)
        if "a" <= letter <= "z":
            codes[c] = c - 97
        elif letter.isalpha():
            codes[c] = 26 + c % (LETTERS - 28)
    codes[ord(START)], codes[ord(END)] = LETTERS - 2, LETTERS - 1
    return codes


@cache
def triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all subsequences of a word of this length, and their weights."""
    places = np.array(list(combinations(range(length), ORDER)), np.int32).reshape(-1, ORDER)
    return places, (DECAY ** (places[:, -1] - places[:, 0] + 1)).astype(np.float32)


def coded(words: list[str], length: int) -> np.ndarray:
    points = np.array(words, f"U{length}").view(np.uint32).reshape(len(words), length)
    return np.where(points < 0x3000, letter_codes()[np.minimum(points, 0x2FFF)], 26 + points % (LETTERS - 28)).astype(np.int32)


def self_kernel(codes: np.ndarray) -> np.ndarray:
    """Kernel of each coded word with itself, by the usual recursion over both positions."""
    n, length = codes.shape
    same = (codes[:, :, None] == codes[:, None, :]) & (codes[:, :, None] >= 0)
    before = np.ones((n, length + 1, length + 1), np.float32)
    for _ in range(ORDER - 1):
        now = np.zeros_like(before)
        for i in range(1, length + 1):
            row = np.zeros(n, np.float32)
            for j in range(1, length + 1):
                row = DECAY * row + DECAY**2 * same[:, i - 1, j - 1] * before[:, i - 1, j - 1]
                now[:, i, j] = DECAY * now[:, i - 1, j] + row
        before = now
    return (DECAY**2 * same * before[:, :-1, :-1]).sum(axis=(1, 2))


def kernel_sums(words: list[str], weights: np.ndarray) -> np.ndarray:
    """For each word the normalised sum of ``weights`` (triples, columns) over its subsequences."""
    out = np.zeros((len(words), weights.shape[1]), np.float32)
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    for length, at in by_length.items():
        if length < ORDER:
            continue
        places, decay = triples(length)
        step = max(1, 1_500_000 // (len(places) * weights.shape[1]))
        for lo in range(0, len(at), step):
            own = at[lo : lo + step]
            codes = coded([words[i] for i in own], length)
            parts = [codes[:, places[:, k]] for k in range(ORDER)]
            whole = (parts[0] >= 0) & (parts[1] >= 0) & (parts[2] >= 0)
            key = np.where(whole, (parts[0] * LETTERS + parts[1]) * LETTERS + parts[2], 0)
            found = np.einsum("nc,ncm->nm", whole * decay, weights[key])
            norm = self_kernel(codes)
            out[own] = found / np.sqrt(np.maximum(norm, 1e-9))[:, None]
    return out


def triple_table(words: list[str]) -> np.ndarray:
    """Normalised features of each word as a column over all triples of letters."""
    out = np.zeros((LETTERS**ORDER, len(words)), np.float32)
    for m, word in enumerate(words):
        if len(word) < ORDER:
            continue
        places, decay = triples(len(word))
        codes = coded([word], len(word))
        parts = [codes[0, places[:, k]] for k in range(ORDER)]
        whole = (parts[0] >= 0) & (parts[1] >= 0) & (parts[2] >= 0)
        np.add.at(out[:, m], ((parts[0] * LETTERS + parts[1]) * LETTERS + parts[2])[whole], decay[whole])
        out[:, m] /= max(1e-9, float(np.sqrt(self_kernel(codes)[0])))
    return out


def sentences(text: str | None) -> list[list[str]]:
    """Words of each sentence, of WORD letters at most: longer ones as overlapping windows."""
    if not text:
        return []
    text = text.lower()
    if " " in text:
        text = _SPACED.sub(lambda m: m[0].replace(" ", ""), text)
    out = []
    for sentence in _SENTENCE.split(text):
        words = sentence.split()
        if not words:
            continue
        if max(map(len, words)) > WORD:
            words = [w[i : i + WORD] for w in words for i in range(0, max(1, len(w) - WORD // 2), WORD // 2)]
        out.append(words)
    return out


def read_as_letters(word: str) -> str:
    """Digits and marks within a word of letters as the letters they look like, ends marked."""
    if not word.isalpha():
        word = word.strip(_ENDS)
        if any(map(str.isalpha, word)):
            word = word.translate(_LOOKS_LIKE)
    return f"{START}{word}{END}"


@dataclass(frozen=True)
class Model:
    """Weight of each triple of letters, bias, and the curve over document features."""

    weights: np.ndarray
    bias: float
    curve: np.ndarray

    def margins(self, words: list[str]) -> np.ndarray:
        places: dict[str, int] = {}  # words that differ in closing marks alone are read alike
        at = [places.setdefault(read_as_letters(w), len(places)) for w in words]
        return (kernel_sums(list(places), self.weights)[:, 0] + self.bias)[at] if at else np.zeros(0)


def document_features(found: list[float]) -> list[float]:
    """Three highest sentence margins, clipped, and the log count of sentences above 0."""
    best = sorted(found, reverse=True)
    top = [min(max(m, -1.5), 2.0) for m in (*best[:3], -1.5, -1.5, -1.5)][:3]
    return [*top, float(np.log1p(sum(m > 0 for m in best)))]


def fit_machine(blocks: list[tuple[np.ndarray, float, np.ndarray]], penalty: float = 0.2) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps over blocks of (features, sign, weights); the
    last weight is the bias."""
    m = blocks[0][0].shape[1] + 1
    w, ridge = np.zeros(m), penalty * np.eye(m)
    ridge[-1, -1] = 1e-3
    for _ in range(25):
        left, right = ridge.copy(), np.zeros(m)
        for features, sign, weight in blocks:
            for lo in range(0, len(features), 4096):
                part = features[lo : lo + 4096]
                x = np.hstack([part, np.ones((len(part), 1))]).astype(np.float64)
                inside = sign * (x @ w) < 1
                x, c = x[inside], weight[lo : lo + 4096][inside]
                left += (x * c[:, None]).T @ x
                right += sign * (x * c[:, None]).sum(axis=0)
        new = np.linalg.solve(left, right)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps; last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(texts: list[str], labels: list[int]) -> Model | None:
    """A model from labelled documents; None without both labels."""
    y = np.array(labels)
    if len(texts) < 2 or y.min() == y.max():
        return None
    once: dict[str, str] = {}  # each different word is held once
    parts = [[[once.setdefault(w, w) for w in s] for s in sentences(t)] for t in texts]
    read = {w: read_as_letters(w) for w in once if len(w) >= ORDER}
    own = [sorted({read[w] for s in p for w in s if w in read}) for p in parts]
    del once, read
    # two thirds teach the machine, the rest the curve
    teach = np.array([zlib.crc32(t.encode()) % 3 != 0 for t in texts])
    if len(set(y[teach].tolist())) < 2 or len(set(y[~teach].tolist())) < 2:
        teach[:] = True
    toxic = Counter(w for o, k in zip(own, np.where(teach, y, -1), strict=True) if k == 1 for w in o)
    clean = Counter(w for o, k in zip(own, np.where(teach, y, -1), strict=True) if k == 0 for w in o)
    n_toxic, n_clean = int(y[teach].sum()), int((1 - y[teach]).sum())
    odds = {
        w: float(np.log((n + 0.5) / (n_toxic + 1)) - np.log((clean[w] + 0.5) / (n_clean + 1))) for w, n in toxic.items()
    }
    rank = lambda score: [
        sorted((w for w in o if odds[w] >= LEAST_ODDS), key=lambda w: (-score(w), w))[:WITNESSES]
        for o, k, t in zip(own, y, teach, strict=True)
        if k and t
    ]
    put_forward = Counter(w for best in rank(lambda w: odds[w]) for w in best)
    marked = [w for w, _ in sorted(put_forward.items(), key=lambda x: (-x[1], x[0]))[: LANDMARKS // 2]]
    common = [w for w, _ in sorted(clean.items(), key=lambda x: (-x[1], x[0])) if w not in put_forward]
    step = max(1, len(common) // (2 * LANDMARKS))
    landmarks = sorted({*marked, *common[: LANDMARKS // 4], *common[::step][: LANDMARKS // 4]})
    columns = triple_table(landmarks)
    values, vectors = np.linalg.eigh((columns.T @ columns).astype(np.float64))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-3))
    features, whiten = columns, whiten.astype(np.float32)
    for lo in range(0, len(features), 4096):  # in place
        features[lo : lo + 4096] = features[lo : lo + 4096] @ whiten
    # different clean words are many: the most common ones, and as many drawn by hash
    drawn = heapq.nsmallest(NEGATIVES // 2, common[NEGATIVES // 2 :], key=lambda w: (zlib.crc32(w.encode()), w))
    negatives = [w for w in clean if w in put_forward] + common[: NEGATIVES // 2] + drawn
    x_clean = kernel_sums(negatives, features)
    c_clean = np.array([clean[w] for w in negatives], float) ** 0.75
    w = None
    for _ in range(ROUNDS):
        positives = sorted(put_forward)
        c_toxic = np.array([put_forward[p] for p in positives], float)
        share = c_clean.sum() / max(1.0, c_toxic.sum())
        w = fit_machine([(kernel_sums(positives, features), 1.0, c_toxic * min(share, 5.0)), (x_clean, -1.0, c_clean)])
        known = sorted(toxic)
        line = (features @ w[:-1].astype(np.float32))[:, None]
        margin = dict(zip(known, kernel_sums(known, line)[:, 0].tolist(), strict=True))
        put_forward = Counter(o for best in rank(lambda t: margin[t] + 0.1 * odds[t]) for o in best)
    model = Model((features @ w[:-1].astype(np.float32))[:, None], float(w[-1]), np.zeros(5))
    rest = ~teach if not teach.all() else teach
    held = [document_features(f) for f in sentence_margins(model, [p for p, r in zip(parts, rest, strict=True) if r], {})]
    return Model(model.weights, model.bias, fit_curve(np.array(held), y[rest]))


def sentence_margins(model: Model, parts: list[list[list[str]]], known: dict[str, float]) -> Iterator[list[float]]:
    """Margin of each sentence of each document: that of its most toxic word; ``known`` keeps scores of words."""
    if len(known) > KEPT_WORDS:
        known.clear()
    new = list(set(chain.from_iterable(chain.from_iterable(parts))).difference(known))
    known.update(zip(new, model.margins(new).tolist(), strict=True))
    margin = known.__getitem__
    for p in parts:
        yield [max(map(margin, s)) for s in p]


def scores(model: Model | None, texts: pa.Array, known: dict[str, float]) -> list[float]:
    """Score of each text of a batch, some megabytes of text at a time."""
    if model is None:
        return [0.0] * len(texts)
    out: list[float] = []
    at = 0
    while at < len(texts):
        part, size = [], 0
        while at < len(texts) and size < 1 << 22:
            text = texts[at].as_py()
            part.append(sentences(text))
            size += len(text or "")
            at += 1
        x = np.array([document_features(f) for f in sentence_margins(model, part, known)])
        out += (1 / (1 + np.exp(-np.clip(x @ model.curve[:-1] + model.curve[-1], -30, 30)))).tolist()
    return out


def score_toxicity(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of each document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, score double"
    arrow = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            found = scores(sent.value, batch.column(1), known)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], schema=arrow)

    return in_batches(docs.select(id_col, text_col)).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: Model | None, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score below the threshold, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            found = scores(sent.value, batch.column(at), known)
            yield batch.filter(pa.array([s < threshold for s in found], pa.bool_()))

    return in_batches(docs).mapInArrow(run, docs.schema)


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_on(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Model | None:
    """A model from the labelled documents outside the held-out fold, ``rows`` labels and TRAIN_BYTES of their texts at most.

    Rows that repeat a label's text count once. In the order of the sample a text that would pass the bytes is left out,
    and those behind it are not."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("labelled")).agg(F.max(label_col).alias("label"))
    # sorted by hash: a sample of the labels that does not depend on how they are stored
    known = known.orderBy(F.xxhash64("labelled"), "labelled").limit(rows)
    own = docs.select(F.col(id_col).alias("labelled"), F.col(text_col).alias("words")).where("words IS NOT NULL")
    found = own.join(F.broadcast(known), "labelled").select("labelled", "words", "label", F.xxhash64("labelled", "words").alias("at")).distinct()
    found = materialize(found, "labelled-texts")
    sizes = found.groupBy("at").agg(F.sum(F.octet_length("words")).alias("n")).orderBy("at").collect()  # at most a row for each label
    total, fit = 0, []
    for r in sizes:
        if total + r["n"] <= TRAIN_BYTES:
            total += r["n"]
            fit.append((r["at"],))
    chosen = docs.sparkSession.createDataFrame(fit, "at long")
    taken = found.join(F.broadcast(chosen), "at", "left_semi").select("words", "label").collect()
    discard(found)
    taken.sort()
    texts, own_labels = [r["words"] for r in taken], [r["label"] for r in taken]
    del taken, sizes
    return train(texts, own_labels)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_on(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score_toxicity(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


QUERIES = {"op8_toxicity": op8_toxicity}
