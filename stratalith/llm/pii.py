"""Operator 10: personal data by a character BiLSTM with CRF transitions, on top of fixed patterns.

The patterns (mail address, internet address, card, phone) run over every whole text. The network runs
over every place of a text that can hold such data: a region around each digit, ``@``, and ``at`` or ``dot``
in brackets or ``dot`` as a word, since each kind has one. Regions are cut into overlapping windows of
characters, each window is tagged by Viterbi decoding, and tags of overlapping windows are reconciled over the
whole document: each character takes its tag from the window in which it stands farthest from an edge. Runs of
tags that overlap no pattern's span are added if they hold what their kind cannot do without (``complete``):
mail addresses and internet addresses with marks spelled out or spaced, cards whatever their separators if their
check digit holds, phone numbers without a country's code.

The network is trained in numpy from labelled spans: regions of a bounded sample of documents (``TRAIN_DOCS``),
in which what the patterns find is labelled as it stands and written anew in other ways, and spans made up in
many ways within words of the sample, beside numbers that are no personal data (versions, dates, times, prices,
keys). A tenth of the windows is held out; training ends when their loss does. Tasks get the weights by
broadcast. No rows are shuffled.

Nulls, empties: a null text counts as empty; a document without a find has counts 0, the SHA-256 of the
empty string and empty spans. Equal texts give equal results.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_type, in_batches, table

KINDS = ("email", "ip", "card", "phone")
#: Window and step of its start; characters of context around a trigger; documents to train on, regions drawn
#: from each, and characters of a region.
WIDTH, STEP, CONTEXT, TRAIN_DOCS, DRAWN, REGION = 64, 40, 24, 12_000, 2, 240
#: Spans made up for training, besides those of the sample.
MADE_UP = 6_000
HIDDEN, EPOCHS, BATCH, RATE = 16, 12, 128, 0.03
#: Windows that are tagged at once.
TAGGED = 1024

_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# Possessive, and begun where a run of digits begins: the same matches, without going back over a run.
_IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9@]+")
_SPELLED = re.compile(r"[(\[{<]\s?(?:at|dot)\s?[)\]}>]|\bdot\b", re.IGNORECASE)
_SPELLED_HAS = ("dot", "Dot", "DOT", "at)", "at]", "at}", "at>", "at )", "at ]", "AT)", "AT]", "AT}", "AT>")


def luhn(digits: bytes) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = (d - 48) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: bytes) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the address pattern. Each begins where the run before an @ begins, as only the
    whole run meets the @; a run is looked for from the last match's end on."""
    last, at = 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > last and (c := text[start - 1]) < 128 and (chr(c).isalnum() or c in b"._%+-"):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        else:
            last = max(last, at)
        at = text.find(b"@", max(last, at + 1))


def pattern_spans(text: bytes, *, check: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes, by start, then kind. Without ``check``, cards need no check digit."""
    found = [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip(b"0")) <= 3 and int(p or b"0") <= 255 for part in m[0].split(b".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].translate(None, b" -")
        if 12 <= len(digits) <= 19 and (not check or luhn(digits)):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(48 <= c <= 57 for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or text.isascii():
        return spans
    before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(before[a]), k, int(before[b])) for a, k, b in spans]


# --- the network -----------------------------------------------------------------------------------

#: Classes of characters: padding, letters, digits as one, each mark of its own, space, all else.
_MARKS = "@.-+() _%:/,;[]{}<>=#*\"'|\n"
CLASSES = 1 + 26 + 1 + len(_MARKS) + 1
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table_ = np.full(129, CLASSES - 1, np.int16)
    for k in range(26):
        table_[97 + k] = table_[65 + k] = 1 + k
    table_[48:58] = 27
    for k, mark in enumerate(_MARKS):
        table_[ord(mark)] = 28 + k
    return table_[np.minimum(points, 128)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Weights by name: for each direction input table, recurrent and bias; emissions; transitions."""

    w: dict[str, np.ndarray]

    @staticmethod
    def fresh(rng: np.random.Generator) -> Network:
        w = {}
        for d in ("f", "b"):
            w[f"x{d}"] = rng.standard_normal((CLASSES, 4 * HIDDEN)) * 0.2
            w[f"x{d}"][:, HIDDEN : 2 * HIDDEN] += 1  # at first, keep
            w[f"h{d}"] = rng.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.2
            w[f"o{d}"] = rng.standard_normal((HIDDEN, TAGS)) * 0.2
        w["bias"] = np.zeros(TAGS)
        w["next"] = np.zeros((TAGS, TAGS))
        return Network({k: v.astype(np.float32) for k, v in w.items()})

    def run(self, x: np.ndarray, d: str, keep: bool = False) -> tuple[np.ndarray, list]:
        """Hidden states (time, n, HIDDEN) in one direction, and what the way back needs."""
        n, time = x.shape
        h = c = np.zeros((n, HIDDEN), np.float32)
        states, kept = np.empty((time, n, HIDDEN), np.float32), []
        own, back = self.w[f"x{d}"][x.T], self.w[f"h{d}"]
        for t in range(time) if d == "f" else range(time - 1, -1, -1):
            gates = own[t] + h @ back
            open_ = sigmoid(gates[:, : 3 * HIDDEN])
            i, f, o = (open_[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            before = c
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            states[t] = h
            if keep:
                kept.append((t, open_, g, before, squashed))
        return states, kept

    def emissions(self, x: np.ndarray) -> np.ndarray:
        e = self.run(x, "f")[0] @ self.w["of"] + self.run(x, "b")[0] @ self.w["ob"] + self.w["bias"]
        return e.transpose(1, 0, 2)

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags of each window by Viterbi."""
        e = self.emissions(x)
        n, time, _ = e.shape
        score, back = e[:, 0], np.zeros((n, time, TAGS), np.int8)
        for t in range(1, time):
            paths = score[:, :, None] + self.w["next"]
            back[:, t] = paths.argmax(axis=1)
            score = paths.max(axis=1) + e[:, t]
        tags = np.empty((n, time), np.int8)
        tags[:, -1] = score.argmax(axis=1)
        for t in range(time - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
        return tags

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss of a batch (negative log likelihood of the tags) and its gradients.

        Sums over paths are kept as shares at each place, so that none leaves the range of numbers."""
        n, time = x.shape
        states, kept = {}, {}
        for d in ("f", "b"):
            states[d], kept[d] = self.run(x, d, keep=True)
        e = states["f"] @ self.w["of"] + states["b"] @ self.w["ob"] + self.w["bias"]
        g = {}
        most, y = self.w["next"].max(), y.T.astype(np.int64)
        a, top = np.exp(self.w["next"] - most), e.max(axis=2, keepdims=True)
        own = np.exp(e - top)
        ahead, behind, share = np.empty_like(e), np.ones_like(e), np.empty((time, n, 1), np.float32)
        for t in range(time):
            now = (ahead[t - 1] @ a) * own[t] if t else own[0]
            share[t] = now.sum(axis=1, keepdims=True)
            ahead[t] = now / share[t]
        own /= share
        for t in range(time - 2, -1, -1):
            behind[t] = (own[t + 1] * behind[t + 1]) @ a.T
        total = np.log(share).sum(axis=0)[:, 0] + top.sum(axis=0)[:, 0] + (time - 1) * most
        at = np.arange(time)[:, None], np.arange(n), y
        gold = e[at].sum(axis=0) + self.w["next"][y[:-1], y[1:]].sum(axis=0)
        de = ahead * behind
        g["next"] = a * np.tensordot(ahead[:-1], own[1:] * behind[1:], ([0, 1], [0, 1]))
        g["next"] -= np.bincount((y[:-1] * TAGS + y[1:]).ravel(), minlength=TAGS * TAGS).reshape(TAGS, TAGS)
        de[at] -= 1
        g["bias"] = de.sum(axis=(0, 1))
        one_hot = np.zeros((time * n, CLASSES), np.float32)
        one_hot[np.arange(time * n), x.T.ravel()] = 1
        for d in ("f", "b"):
            g[f"o{d}"] = np.tensordot(states[d], de, ([0, 1], [0, 1]))
            dh_all, back = de @ self.w[f"o{d}"].T, np.ascontiguousarray(self.w[f"h{d}"].T)
            gates = np.empty((time, n, 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((n, HIDDEN), np.float32)
            for t, open_, c_in, before, squashed in reversed(kept[d]):
                i, f, o = (open_[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(3))
                dh = dh + dh_all[t]
                dc = dc + dh * o * (1 - squashed * squashed)
                dg = gates[t]
                dg[:, :HIDDEN], dg[:, HIDDEN : 2 * HIDDEN], dg[:, 2 * HIDDEN : 3 * HIDDEN] = dc * c_in, dc * before, dh * squashed
                dg[:, : 3 * HIDDEN] *= open_ * (1 - open_)
                dg[:, 3 * HIDDEN :] = dc * i * (1 - c_in * c_in)
                dh, dc = dg @ back, dc * f
            h_before, after = (states[d][:-1], gates[1:]) if d == "f" else (states[d][1:], gates[:-1])
            g[f"h{d}"] = np.tensordot(h_before, after, ([0, 1], [0, 1]))
            g[f"x{d}"] = one_hot.T @ gates.reshape(time * n, -1)
        return float((total - gold).mean()), {k: v / n for k, v in g.items()}


def fit(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Network:
    """A network by Adam with clipped gradients; a tenth of the windows decides when to stop."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    order = rng.permutation(len(x))
    held, own = order[: len(x) // 10], order[len(x) // 10 :]
    step, steps, losses = 0, EPOCHS * -(-len(own) // BATCH), []
    for _ in range(EPOCHS):
        own = rng.permutation(own)
        for lo in range(0, len(own), BATCH):
            at = own[lo : lo + BATCH]
            _, g = net.gradients(x[at], y[at])
            norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
            step += 1
            rate = RATE * (1 - 0.9 * step / steps)
            for k, v in g.items():
                v = v * min(1.0, 5 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                net.w[k] = (net.w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        if len(held):
            losses.append(net.gradients(x[held], y[held])[0])
            if len(losses) > 3 and min(losses[-2:]) > min(losses[:-2]):
                break
    return net


# --- training windows ------------------------------------------------------------------------------


def with_check_digit(digits: str) -> str:
    """The digits with the last one changed so that their Luhn sum holds."""
    return next(number for d in "0123456789" if luhn((number := digits[:-1] + d).encode()))


def spelled(kind: int, rng: np.random.Generator) -> str:
    """A span of a kind with random letters and digits, written in one of many ways."""
    pick = lambda *ways: ways[rng.integers(len(ways))]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    letters = lambda: "".join(chr(c) for c in rng.integers(97, 123, rng.integers(2, 10)))
    if kind == 0:
        name = letters() + pick(".", "_", "", "-") + pick(letters(), digits(2), "")
        at = pick("@", " @ ", " (at) ", "(at)", " [at] ", "[at]", "{at}", " AT ", " at ", "(@)")
        # a plain word between words is no address: then its dots are spelled too
        dot = pick(".", ".", " . ", " dot ", "(dot)", "[dot]", " [dot] ", " DOT ") if at.strip().lower() != "at" else pick(" dot ", "(dot)", " [dot] ", " DOT ")
        address = name + at + dot.join([letters() for _ in range(rng.integers(1, 4))] + [pick("com", "org", "net", "de", letters()[:3])])
        return address.upper() if rng.integers(8) == 0 else address
    if kind == 1:
        return pick(".", " . ", "[.]", "(.)", " dot ", "[dot]").join(map(str, rng.integers(0, 256, 4)))
    if kind == 2:
        mark = pick("", "", " ", "-", ".", "/", "  ", "_", ":")
        short = rng.integers(5) == 0
        card = with_check_digit(digits(15 if short else 16))
        return mark.join([card[:4], card[4:10], card[10:]] if short else [card[k : k + 4] for k in range(0, 16, 4)])
    mark, area, line = pick(" ", "-", "", "/", "."), digits(3), [digits(3), digits(4)]
    code = pick("+", "00") + digits(rng.integers(1, 4))
    return pick(
        mark.join([code, area, *line]), f"{code} ({area}) {line[0]}{pick('-', ' ')}{line[1]}", f"({area}) {line[0]}{pick('-', ' ')}{line[1]}",
        f"{code} (0){area}{mark or ' '}{line[0] + line[1]}", (mark or "-").join([area, *line]), f"0{area}{mark or '/'}{line[0] + line[1]}",
    )


def lookalike(rng: np.random.Generator) -> str:
    """Numbers, marks and words that stand like personal data but are none."""
    pick = lambda *ways: ways[rng.integers(len(ways))]
    n = lambda top: int(rng.integers(top))
    digits = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    letters = lambda: "".join(chr(c) for c in rng.integers(97, 123, rng.integers(2, 10)))
    return pick(
        f"{n(20)}.{n(20)}", f"v{n(9)}.{n(30)}.{n(99)}", f"{n(9)}.{n(30)}.{n(99)}", f"{n(9)}.0.", f"{1950 + n(80)}", f"{1950 + n(80)}-{10 + n(3)}-{10 + n(20)}",
        f"{1 + n(28)}/{1 + n(12)}/{1950 + n(80)}", f"{1 + n(28)}.{1 + n(12)}.{1950 + n(80)}", f"{10 + n(14)}:{10 + n(50)}:{10 + n(50)}", f"{n(900)},{100 + n(900)}.{10 + n(90)}",
        digits(1 + n(8)), f"{n(100)}%", f"{n(50)}-{n(90)}", f"@{letters()}", f"{letters()} at {letters()}", f"{letters()} @ {letters()}", f"the dot {letters()}",
        f'{letters()} = "{bytes(rng.integers(0, 256, 20, np.uint8)).hex()}"', f"{letters()}{digits(3)}", f"({n(99)})", f"{n(9)}, {n(99)}, {n(99)}", f"a polka dot {letters()}",
    )


def training_windows(texts: list[str], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Windows of classes and tags from texts, from copies of them with other spans, and from made-up spans."""
    xs, ys = [], []

    def add(text: str, spans: list[tuple[int, int, int]]) -> None:
        tags = np.zeros(len(text), np.int8)
        for a, k, b in spans:
            tags[a:b] = 2 + 2 * k
            tags[a] = 1 + 2 * k
        classes = classes_of(text)
        for lo, hi in window_places(text):
            x, y = np.zeros(WIDTH, np.int16), np.zeros(WIDTH, np.int8)
            x[: hi - lo], y[: hi - lo] = classes[lo:hi], tags[lo:hi]
            if y[0] and y[0] % 2 == 0:
                y[0] -= 1
            xs.append(x)
            ys.append(y)

    def other(kind: int) -> tuple[str, bool]:
        return (lookalike(rng), False) if rng.random() < 0.4 else (spelled(kind, rng), True)

    for _ in range(MADE_UP if texts else 0):
        kind, host = (0, 0, 1, 2, 3)[rng.integers(5)], texts[rng.integers(len(texts))]
        lo = int(rng.integers(max(1, len(host) - WIDTH)))
        before, after = re.sub(r"[0-9@+]", "", host[lo : lo + 30]), re.sub(r"[0-9@+]", "", host[lo + 30 : lo + 60])
        new, still = other(kind)
        add(f"{before} {new}{['', '', '.', ',', '!!', ' |'][rng.integers(6)]} {after}", [(len(before) + 1, kind, len(before) + 1 + len(new))] if still else [])
    for text in texts:
        data = text.encode()
        # a check digit is beyond the network: it learns what looks like a card
        spans = code_points(data, pattern_spans(data, check=False))
        spans = [s for k, s in enumerate(spans) if k == 0 or s[0] >= max(b for _, _, b in spans[:k])]
        add(text, spans)
        if spans:
            out, kept, last = "", [], 0
            for a, kind, b in spans:
                new, still = other(kind)
                out += text[last:a]
                if still:
                    kept.append((len(out), kind, len(out) + len(new)))
                out += new
                last = b
            add(out + text[last:], kept)
    if not xs:
        return np.zeros((0, WIDTH), np.int16), np.zeros((0, WIDTH), np.int8)
    return np.stack(xs), np.stack(ys)


def regions_of(text: str) -> list[list[int]]:
    """Start and end of each region around triggers."""
    marks = [m.span() for m in _DIGITS.finditer(text)]
    if any(map(text.__contains__, _SPELLED_HAS)):
        marks = sorted(marks + [m.span() for m in _SPELLED.finditer(text)])
    regions: list[list[int]] = []
    for a, b in marks:
        lo, hi = max(0, a - CONTEXT), min(len(text), b + CONTEXT)
        if regions and lo <= regions[-1][1]:
            regions[-1][1] = max(hi, regions[-1][1])
        else:
            regions.append([lo, hi])
    return regions


def drawn_regions(text: str) -> list[str]:
    """DRAWN of a text's regions, of REGION characters at most, drawn by a hash of the text."""
    found, seed = regions_of(text), zlib.crc32(text.encode("utf-8", "surrogatepass"))
    drawn = sorted({(seed + 7919 * k) % len(found) for k in range(DRAWN)}) if found else []
    cut = []
    for k in drawn:
        lo, hi = found[k]
        lo += seed // 7 % max(1, hi - lo - REGION + 1)  # any part of a longer region
        cut.append(text[lo : min(hi, lo + REGION)])
    return cut


def window_places(text: str) -> list[tuple[int, int]]:
    """Overlapping windows over the regions around all triggers."""
    places = []
    for lo, hi in regions_of(text):
        while True:
            places.append((lo, min(lo + WIDTH, hi)))
            if lo + WIDTH >= hi:
                break
            lo += STEP
    return places


# --- finding ---------------------------------------------------------------------------------------


def complete(kind: int, span: str) -> bool:
    """Whether a tagged span holds what its kind cannot do without; a card's check digit is one of these."""
    if kind == 0:
        parts = re.split(r"@|\bat\b", span, maxsplit=1, flags=re.IGNORECASE)
        return len(parts) == 2 and all(any(map(str.isalpha, p)) for p in parts) and ("." in parts[1] or "dot" in parts[1].lower())
    numbers = re.findall(r"[0-9]+", span)
    if kind == 1:
        return len(numbers) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in numbers)
    if kind == 2 and not luhn("".join(numbers).encode()):
        return False
    return (12 if kind == 2 else 7) <= sum(map(len, numbers)) <= (19 if kind == 2 else 16) and not any(map(str.isalpha, span))


def tagged_spans(texts: list[str], net: Network) -> list[list[tuple[int, int, int]]]:
    """Spans of each text by the network, reconciled over all its windows, however many are tagged at once.

    A character's tag is that of the window in which it stands farthest from an edge, the first of equals."""
    places = [(i, lo, hi) for i, text in enumerate(texts) for lo, hi in window_places(text)]
    classes = {i: classes_of(texts[i]) for i in {i for i, _, _ in places}}
    tags = np.zeros((len(places), WIDTH), np.int8)
    for at in range(0, len(places), TAGGED):
        part = places[at : at + TAGGED]
        x = np.zeros((len(part), WIDTH), np.int16)
        for row, (i, lo, hi) in enumerate(part):
            x[row, : hi - lo] = classes[i][lo:hi]
        tags[at : at + len(part)] = net.decode(x)
    # a window overlaps the one before and the one after alone; those without tags speak for their characters too
    spoken = tags.any(axis=1)
    spoken[:-1] |= spoken[1:].copy()
    spoken[1:] |= spoken[:-1].copy()
    # of each text the tag of each character in such a window, and how far it stood from the edge
    best: dict[int, dict[int, tuple[int, int]]] = {i: {} for i in classes}
    for row in np.flatnonzero(spoken).tolist():
        i, lo, hi = places[row]
        own = best[i]
        for k, tag in enumerate(tags[row, : hi - lo].tolist()):
            depth = min(k if lo else WIDTH, hi - lo - 1 - k if hi < len(texts[i]) else WIDTH)
            seen = own.get(lo + k)
            if seen is None or depth > seen[0]:
                own[lo + k] = (depth, tag)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for i, found in best.items():
        start = kind = last = None
        for place in [*sorted(found), None]:
            tag = found[place][1] if place is not None else 0
            goes_on = start is not None and place == last + 1 and tag == 2 + 2 * kind
            if start is not None and not goes_on:
                out[i].append((start, kind, last + 1))
                start = None
            if tag and not goes_on:
                start, kind = place, (tag - 1) // 2
            last = place
    return out


def find_all(texts: list[bytes], net: Network | None) -> list[list[tuple[int, int, int, bool]]]:
    """(start, kind, end, base) of each text in code points, by start, then kind."""
    base = [pattern_spans(t) for t in texts]
    base = [code_points(t, s) for t, s in zip(texts, base, strict=True)]
    words = [t.decode("utf-8", "replace") for t in texts]
    added = tagged_spans(words, net) if net is not None else [[] for _ in texts]
    out = []
    for text, own, more in zip(words, base, added, strict=True):
        spans = [(a, k, b, True) for a, k, b in own]
        for a, k, b in more:
            while a < b and text[a].isspace():
                a += 1
            while b > a and (text[b - 1].isspace() or text[b - 1] in ".,;"):
                b -= 1
            if all(b <= c or d <= a for c, _, d in own) and complete(k, text[a:b]):
                spans.append((a, k, b, False))
        out.append(sorted(spans))
    return out


def train_network(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_DOCS) -> Network | None:
    """A network from a sample of ``rows`` documents or so, drawn by a hash of id and text.

    Of each, DRAWN regions around triggers, drawn by a hash from the whole text, come to the driver, of REGION
    characters at most. None if there are none.
    """

    arrow = arrow_type("region string")

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [region for text in batch.column(0).to_pylist() for region in drawn_regions(text or "")]
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.string())], schema=arrow)

    share = min(1.0, rows / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 40)) < int(share * (1 << 40))
    own = docs.where(drawn).select(F.col(text_col).alias("words")).where(F.col("words").rlike("[0-9@]"))
    texts = sorted(r["region"] for r in in_batches(own).mapInArrow(regions, "region string").collect())
    x, y = training_windows(texts, np.random.default_rng(9))
    return fit(x, y) if len(x) else None


def find_pii(docs: DataFrame, net: Network | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and its finds as array of (kind, start, end, base)."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, found array<struct<kind: string, start: long, end: long, base: boolean>>"
    arrow = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found, at = batch.column(1).cast(pa.binary()), [], 0
            while at < len(texts):
                part: list[bytes] = []
                size = 0
                while at < len(texts) and size < 1 << 21:
                    part.append(texts[at].as_py() or b"")
                    size += len(part[-1])
                    at += 1
                found += [[{"kind": KINDS[k], "start": a, "end": b, "base": own} for a, k, b, own in s] for s in find_all(part, sent.value)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, arrow.field(1).type)], schema=arrow)

    return in_batches(docs.select(id_col, text_col)).mapInArrow(run, schema)


def redact(docs: DataFrame, net: Network | None, *, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with every find replaced by its kind in angle brackets, and ``length_col`` (if there is
    one) set to the new length of texts that changed. Finds that overlap are replaced as one."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            lengths = batch.column(length_at).to_pylist() if length_at is not None else None
            found = find_all([(t or "").encode() for t in texts], sent.value)
            for i, spans in enumerate(found):
                if spans:
                    texts[i] = redacted(texts[i], spans)
                    if lengths is not None:
                        lengths[i] = len(texts[i])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, columns[at].type)
            if lengths is not None:
                columns[length_at] = pa.array(lengths, columns[length_at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return in_batches(docs).mapInArrow(run, docs.schema)


def redacted(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    out, last = "", 0
    for a, k, b, _ in spans:
        if a >= last:
            out += f"{text[last:a]}<{KINDS[k].upper()}>"
        last = max(last, b)
    return out + text[last:]


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, train_network(docs))
    joined = "array_join(transform({}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    counts = [f"CAST(size(filter(found, x -> x.base AND x.kind = '{k}')) AS BIGINT) AS n_{k}" for k in KINDS]
    return found.selectExpr(
        "doc_id",
        *counts,
        f"sha2({joined.format('filter(found, x -> x.base)')}, 256) AS base_sha256",
        f"{joined.format('found')} AS spans",
    )


QUERIES = {"op10_pii": op10_pii}
