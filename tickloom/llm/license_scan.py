"""Licence scans.

One Aho-Corasick automaton over normalised words finds notice phrases and identifier tags. After a
tag stands an expression of licence identifiers with AND, OR, WITH and brackets; a shunting-yard
parser turns it into postfix order and evaluates it.

Each label has a degree of permission between 0 and 1. OR takes the larger, AND the smaller, and an
exception (WITH) lifts its licence half-way to 1. A document's score is the smallest degree of its
notices and expressions, since all of them apply; a document that states nothing scores 0.

A narrow map over whole texts: no exchange; time and memory follow a text's length, whatever it holds. A tag inside the
expression of another is a name in it.

Defined cases: null and empty texts have no words and no labels; a malformed expression keeps the
labels read so far and counts its last complete part; repeated rows are scanned one by one; an empty
table gives an empty result; input columns named like a result give way.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.arrays import append_columns

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notices.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "mozilla public license": "mpl-2",
    "eclipse public license": "epl-2",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}

# Degree of permission of a label; others count as UNKNOWN.
PERMISSION = {
    "public-domain": 1.0, "cc0": 1.0, "mit": 1.0, "bsd": 1.0, "isc": 1.0, "apache-2": 1.0, "cc-by": 0.9,
    "mpl-2": 0.6, "epl-2": 0.6, "cc-by-sa": 0.6, "lgpl": 0.5, "gpl": 0.3, "gpl-2": 0.3, "gpl-3": 0.3,
    "cc-by-nd": 0.2, "cc-by-nc": 0.2, "agpl-3": 0.1, "reserved": 0.0,
}
UNKNOWN = 0.5

# Identifiers that belong to a label, by the start of the lower-cased identifier.
IDENTIFIERS = {
    "mit": "mit", "apache-2": "apache-2", "bsd": "bsd", "0bsd": "bsd", "isc": "isc", "mpl-2": "mpl-2", "epl-2": "epl-2",
    "gpl-2": "gpl-2", "gpl-3": "gpl-3", "lgpl": "lgpl", "agpl": "agpl-3", "cc0": "cc0", "unlicense": "public-domain",
    "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by-sa": "cc-by-sa", "cc-by": "cc-by",
}

# Operators of an expression, loosest first, and the words of the identifier tag.
BINDS = {"or": 1, "and": 2, "with": 3}
TAG = "spdx license identifier"

#: A-Z to a-z; every other ASCII byte that is no letter or digit becomes a space.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_IN_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_TOKEN = re.compile(rb"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+\-]*)")
_BEFORE = re.compile(rb"[ \t:]*")


def label_of(identifier: str) -> str:
    name = identifier.lower()
    starts = [k for k in IDENTIFIERS if name.startswith(k)]
    return IDENTIFIERS[max(starts, key=len)] if starts else name


@dataclass
class Expression:
    postfix: list[str]
    labels: list[str]
    permission: float | None


def parse(text: str) -> Expression:
    """Reads the expression at the start of `text`, as far as it goes."""
    return parse_at(text.encode())[0]


def parse_at(raw: bytes, at: int = 0, end: int | None = None) -> tuple[Expression, int]:
    """The expression that starts at `at` and ends before `end`, and where it ends.

    Shunting-yard: identifiers go to the output, operators wait on a stack until one that binds less
    tightly, or a closing bracket, comes. The expression ends at a token that cannot follow.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand, opened = True, 0  # operand: an identifier or an opening bracket comes next
    end = len(raw) if end is None else end
    while m := _TOKEN.match(raw, at, end):
        token = m[1].decode()
        low = token.lower()
        if operand and token == "(":
            waiting.append("(")
            opened += 1
        elif operand and token != ")" and low not in BINDS:
            out.append(token.rstrip("."))
            operand = False
        elif not operand and token == ")" and opened:
            while (top := waiting.pop()) != "(":
                out.append(top)
            opened -= 1
        elif not operand and low in BINDS:
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand = True
        else:
            break
        at = m.end()
    if operand and waiting and waiting[-1] != "(":
        waiting.pop()  # an operator without its right side
    out.extend(x for x in reversed(waiting) if x != "(")
    return Expression(out, *_evaluate(out)), at


def _evaluate(postfix: list[str]) -> tuple[list[str], float | None]:
    stack: list[tuple[int | None, float]] = []
    labels: list[str | None] = []
    for token in postfix:
        if token not in BINDS:
            label = label_of(token)
            stack.append((len(labels), PERMISSION.get(label, UNKNOWN)))
            labels.append(label)
            continue
        (exception, right), (_, left) = stack.pop(), stack.pop()
        if token == "with":
            if exception is not None:
                labels[exception] = None  # names an exception, not a licence
            stack.append((None, (left + 1) / 2))
        else:
            stack.append((None, max(left, right) if token == "or" else min(left, right)))
    return [x for x in labels if x is not None], stack[-1][1] if stack else None


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in {*BASE_PHRASES, *NOTICES, TAG}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


class _Places:
    """Where words and lines of a text end. Worked out once a text, and only if a tag is found."""

    def __init__(self, raw: bytes):
        data = np.frombuffer(raw, np.uint8)
        word = _IN_WORD[data]
        self.size, self.lines = len(raw), np.flatnonzero(data == 10)
        self.words = np.flatnonzero(word & ~np.append(word[1:], False)) + 1

    def after(self, word: int) -> tuple[int, int]:
        """The end of a word, and that of its line."""
        at = int(self.words[word])
        line = int(np.searchsorted(self.lines, at))
        return at, int(self.lines[line]) if line < len(self.lines) else self.size


def scan(raw: bytes) -> dict:
    """The notices and expressions of one text (UTF-8), in time linear in its length, however many there are."""
    words = raw.translate(_WORDS).split()
    line = b" %s " % b" ".join(words)
    found = list(_automaton().iter(line.decode("latin-1")))
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32) if found else []
    base, labels, degrees, starts, expressions = [], set(), [], [], []
    places, read = None, 0
    for end, phrase in found:
        at = int(np.searchsorted(spaces, end - len(phrase) - 1))  # words before the match
        if phrase in BASE_PHRASES:
            base.append(BASE_PHRASES[phrase])
            starts.append(at)
        if phrase == TAG:
            places = places or _Places(raw)
            begin, stop = places.after(at + 2)
            if begin < read:
                continue  # a name in the expression before
            said, read = parse_at(raw, _BEFORE.match(raw, begin, stop).end(), stop)
            if said.postfix:
                expressions.append(" ".join(said.postfix))
                labels.update(said.labels)
                degrees.append(said.permission)
        else:
            label = BASE_PHRASES.get(phrase) or NOTICES[phrase]
            labels.add(label)
            degrees.append(PERMISSION.get(label, UNKNOWN))
    # "gpl" beside "gpl-3" is the same notice, read in part: what extends a label stands next to where `label-` would
    ordered = sorted(labels)
    longer = lambda x: (k := bisect_left(ordered, x + "-")) < len(ordered) and ordered[k].startswith(x + "-")
    kept = set(base)
    labels = {x for x in labels if x in kept or not longer(x)}
    return {
        "n_words": len(words), "n_base": len(base),
        "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(set(base))), "labels": ",".join(sorted(labels | set(base))),
        "score": min(degrees, default=0.0), "expressions": expressions,
    }


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, expressions array<string>"
)


def _scan_rows(data: np.ndarray, offsets: np.ndarray, _: pa.RecordBatch) -> dict:
    raw = data.tobytes()
    rows = [scan(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    kinds = {"first_word": pa.int64(), "last_word": pa.int64(), "expressions": pa.list_(pa.string())}
    return {k: pa.array([r[k] for r in rows], kinds.get(k)) for k in rows[0]}


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the findings of each text."""
    return append_columns(docs, text, SCHEMA, _scan_rows)
