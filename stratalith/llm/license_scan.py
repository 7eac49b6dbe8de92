"""Operator 3: licence scan by Aho-Corasick, with a shunting-yard parser for licence expressions.

One automaton finds notice phrases on word boundaries and the tag that opens a machine-readable
identifier. The text behind a tag is read as an expression of identifiers with ``and``, ``or`` and
``with``, turned into postfix order by the shunting-yard method and evaluated to the labels that it
names and to a score. Every text is read whole, in Arrow batches; no rows are shuffled.

Nulls, empties: a null text counts as empty; a document without a find has empty label strings, null
first and last word and score 0. Equal rows give equal results. A malformed expression (an operator
without operand, an open bracket) gives no label.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from .common import LOWER_ASCII, map_arrow, table

#: Base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notice phrases of the method, and labels.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "creative commons": "cc",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
    "isc license": "isc",
    "unlicense": "public-domain",
}
#: Identifier tags, lower-cased; the expression follows.
TAGS = ("spdx-license-identifier:", "license-expression:")
#: Beginnings of identifiers, and the label each stands for.
IDENTIFIERS = {
    "apache": "apache", "mit": "mit", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "bsd": "bsd", "mpl": "mpl",
    "cc0": "public-domain", "cc": "cc", "isc": "isc", "unlicense": "public-domain",
}
BASE_SCORE, NOTICE_SCORE, TAG_SCORE = 0.9, 0.6, 1.0
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: Everything but 0-9, a-z and bytes over 127 parts words.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in LOWER_ASCII)
_TOKEN = re.compile(r"[()]|[a-z0-9.+-]+")
_TAG = re.compile(b"|".join(re.escape(tag.encode()) for tag in TAGS))


def postfix(expression: str) -> list[str] | None:
    """Postfix order of a lower-cased licence expression by shunting-yard; None if malformed."""
    out: list[str] = []
    stack: list[str] = []
    wants_operand = True
    for token in _TOKEN.findall(expression):
        if token == "(":
            if not wants_operand:
                return None
            stack.append(token)
        elif token == ")":
            if wants_operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif token in _PRECEDENCE:
            if wants_operand:
                return None
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
            wants_operand = True
        else:
            if not wants_operand:
                return None
            out.append(token)
            wants_operand = False
    while stack:
        if stack[-1] == "(":
            return None
        out.append(stack.pop())
    return None if wants_operand else out


def evaluate(expression: str) -> tuple[frozenset[str], float]:
    """Labels of an expression and the share of its alternatives that are known.

    ``and`` joins both sides and keeps the lower share, ``or`` joins both and keeps the higher,
    ``with`` adds an exception to its left side and changes nothing.
    """
    steps = postfix(expression)
    if steps is None:
        return frozenset(), 0.0
    stack: list[tuple[frozenset[str], float]] = []
    for token in steps:
        if token in _PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            if token == "with":
                stack.append(left)
            else:
                stack.append((left[0] | right[0], (min if token == "and" else max)(left[1], right[1])))
        else:
            label = identifier_label(token)
            stack.append((frozenset([label]), 1.0) if label else (frozenset(), 0.0))
    return stack[0]


def identifier_label(token: str) -> str | None:
    head = re.split(r"[-+.]", token)[0]
    return IDENTIFIERS.get(re.sub(r"[0-9]+$", "", head)) or IDENTIFIERS.get(head)


def expression_after(text: bytes) -> str:
    """The expression at the start of a lower-cased text: to the line's end, while words and
    operators alternate."""
    line = re.split(rb"[\r\n]|\*/|-->", text, maxsplit=1)[0].decode("utf-8", "ignore")
    kept, wants_operand, depth = [], True, 0
    for m in re.finditer(r"\s*(?:([()])|([a-z0-9.+-]+)|(\S))", line):
        bracket, word, other = m.groups()
        if other:
            break
        if bracket:
            depth += 1 if bracket == "(" else -1
            if depth < 0 or (bracket == "(") != wants_operand:
                break
        elif (word in _PRECEDENCE) == wants_operand:
            break
        else:
            wants_operand = not wants_operand
            word = word.rstrip(".") if word not in _PRECEDENCE else word
        kept.append(bracket or word)
    return " ".join(kept)


def tagged_expressions(lower: bytes) -> list[tuple[int, str]]:
    """Place and expression of each tag of a lower-cased text; an expression ends before the next tag."""
    places = [m.span() for m in _TAG.finditer(lower)]
    ends = [start for start, _ in places[1:]] + [len(lower)]
    return [(start, expression_after(lower[after:end])) for (start, after), end in zip(places, ends, strict=True)]


@cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in {**BASE_PHRASES, **NOTICE_PHRASES}:
        label, base = BASE_PHRASES.get(phrase) or NOTICE_PHRASES[phrase], phrase in BASE_PHRASES
        found.add_word(f" {phrase} ", (label, base, len(phrase.split())))
    for tag in TAGS:
        words = tag.encode().translate(WORD_BYTES).decode().split()
        found.add_word(f" {' '.join(words)} ", (None, False, len(words)))
    found.make_automaton()
    return found


def scan_text(text: bytes | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text in UTF-8."""
    words = (text or b"").translate(WORD_BYTES).split()
    line = f" {b' '.join(words).decode('utf-8', 'surrogateescape')} "
    starts: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    score, tagged, at, position = 0.0, False, 0, 0
    for end, (label, is_base, n) in automaton().iter(line):
        if label is None:
            tagged = True
        elif is_base:
            # words that end at or before this match: the separators up to its last character
            at, position = at + line.count(" ", position, end), end
            starts.append(at - n)
            base.add(label)
            score = max(score, BASE_SCORE)
        else:
            labels.add(label)
            score = max(score, NOTICE_SCORE)
    if tagged:
        lower = text.translate(LOWER_ASCII)
        for _, expression in tagged_expressions(lower):
            named, known = evaluate(expression)
            labels |= named
            score = max(score, TAG_SCORE * known)
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | labels)),
        score,
    )


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its id and what ``scan_text`` finds."""
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return map_arrow(
        docs.select(id_col, text_col),
        lambda ids, texts: [ids, *map(list, zip(*map(scan_text, texts), strict=True))],
        schema,
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op3_license_scan": op3_license_scan}
