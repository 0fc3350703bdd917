"""Licence notices and identifier tags in texts.

An Aho-Corasick automaton over the words of a text (A-Z as a-z, one blank between words) finds notice phrases and the tag
``SPDX-License-Identifier``. What follows a tag on its line is read as a licence expression: a shunting-yard parser turns it
into postfix order (``with`` before ``and`` before ``or``, round brackets), which is evaluated to its licences and to whether
its terms can be met with permissive licences alone: ``or`` needs one side, ``and`` both, ``with`` the licence itself.

Defined cases: null and empty texts have no words and no labels. Places count one by one, also where they overlap. An
expression ends before the first token that cannot follow; a tag without an expression gives no label, and
permissive is null where no tag has one. Of several tags all must be permissive. The score is 1 - 2^-(places of any
phrase + 2 * tags with an expression). Rows may repeat; other columns are kept, but for those of the outputs' names.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm import textops
from millrace.llm.bpe import with_columns

_B = np.arange(256)
WORD = ((_B >= 48) & (_B <= 57)) | ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)

#: The phrases whose places are counted.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Phrases with labels of this method's own.
OTHER = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creative commons zero": "cc0",
    "public domain dedication": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
#: Licences whose terms ask for little more than notice, by the first part of their identifier.
PERMISSIVE = ("mit", "apache", "bsd", "isc", "zlib", "bsl", "cc0", "cc-by-1", "cc-by-2", "cc-by-3", "cc-by-4", "unlicense", "0bsd", "wtfpl", "python", "psf", "x11", "artistic")

_BINDS = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")


def postfix(text: str, at: int = 0, end: int | None = None) -> list[str]:
    """The longest expression that begins at a place of the text and stays on its line, in postfix order; empty if there is none."""
    out, stack, tokens, operand = [], [], [], True
    depth, whole = 0, 0
    end = len(text) if end is None else end
    while m := _TOKEN.match(text, at, end):
        token, low = m[1], m[1].lower()
        if operand != (token == "(" or token not in "()" and low not in _BINDS) or token == ")" and not depth:
            break
        depth += (token == "(") - (token == ")")
        operand = token == "(" or low in _BINDS
        tokens.append(low)
        at = m.end()
        if not operand and not depth:
            whole = len(tokens)
    for token in tokens[:whole]:
        if token == "(":
            stack.append(token)
        elif token == ")":
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif token in _BINDS:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
        else:
            out.append(token)
    return out + stack[::-1]


def evaluated(tokens: list[str]) -> tuple[frozenset[str], bool]:
    """(licences, permissive) of a postfix expression."""
    stack: list[tuple[frozenset[str], bool]] = []
    for token in tokens:
        if token not in _BINDS:
            stack.append((frozenset([token]), token.startswith(PERMISSIVE)))
            continue
        (right, r), (left, le) = stack.pop(), stack.pop()
        stack.append((left, le) if token == "with" else (left | right, le and r if token == "and" else le or r))
    return stack[0]


@lru_cache(1)
def _automaton():
    found = ahocorasick.Automaton()
    for phrase in {**BASE, **OTHER, TAG: None}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def _spaced(w: textops.Words) -> tuple[str, np.ndarray]:
    """All words of a slice with one blank after each, one character a byte, and where each word begins."""
    sizes = w.ends - w.starts
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    inside = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.full(int((sizes + 1).sum()), 32, np.uint8)
    out[begins[inside] + within] = w.data[w.starts[inside] + within]
    return out.tobytes().decode("latin-1"), np.append(begins, len(out))


def scanned(texts: pa.Array) -> list[tuple]:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, n_tags, permissive) of each text."""
    rows, automaton = [], _automaton()
    for w in textops.words(texts, WORD):
        text, begins = _spaced(w)
        raw = w.raw.tobytes().decode("latin-1")  # one character a byte; expressions are ASCII
        for r in range(len(w.first) - 1):
            lo, hi = int(w.first[r]), int(w.first[r + 1])
            base, labels, places, tags, free = [], set(), 0, 0, None
            own = begins[lo:hi] - begins[lo]
            for end, phrase in automaton.iter(" " + text[begins[lo] : begins[hi]]) if hi > lo else ():
                at = int(np.searchsorted(own, end - len(phrase) - 1))
                if phrase == TAG:
                    last = lo + at + len(TAG.split()) - 1
                    after = int(w.ends[last])
                    if raw.startswith(":", after) and (tokens := postfix(raw, after + 1, int(w.offsets[r + 1]))):
                        names, ok = evaluated(tokens)
                        labels |= names
                        tags, free = tags + 1, ok and free is not False
                    continue
                places += 1
                if phrase in BASE:
                    base.append((at, BASE[phrase]))
                labels.add(BASE.get(phrase) or OTHER[phrase])
            starts, own_labels = [x[0] for x in base], {x[1] for x in base}
            rows.append((hi - lo, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(own_labels)), ",".join(sorted(labels)), 1 - 0.5 ** (places + 2 * tags), tags, free))
    return rows


KINDS = {
    "n_words": T.LongType(), "n_base": T.LongType(), "first_word": T.LongType(), "last_word": T.LongType(), "base_labels": T.StringType(),
    "labels": T.StringType(), "score": T.DoubleType(), "n_tags": T.LongType(), "permissive": T.BooleanType(),
}
_ARROW = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int64(), pa.bool_()]


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with what was found in every whole text; see ``KINDS``."""

    def made(column):
        rows = scanned(column)
        return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(_ARROW)]

    return with_columns(docs, text, KINDS, made)
