"""Patterns against regular expressions over texts of one letter a row."""

import random
import re

import pytest

from millrace.operators import load
from millrace.operators.patterns import Pattern

WORDS = {"a": "ant", "b": "bee", "c": "cat"}
CASES = ["ab", "a|b", "(a|b)+c", "a?b*c+", "a{2}", "a{1,3}b", "(ab){2,}c?", "(a|bc)*b", "(a?b?)c{0,2}a", "((a|b){2}|c)+a", "a*"]


def spelled(case):
    return re.sub("[abc]", lambda m: f" {WORDS[m[0]]} ", case)


def longest(text, case):
    """(first, last) of the longest match that ends at each place."""
    out = []
    for end in range(1, len(text) + 1):
        start = next((s for s in range(end) if re.fullmatch(case, text[s:end])), None)
        if start is not None:
            out.append((start, end - 1))
    return out


@pytest.mark.parametrize("case", CASES)
def test_states_equal_regular_expressions(case):
    pick, pattern = random.Random(case), Pattern(spelled(case))
    for _ in range(60):
        text = "".join(pick.choices("abcx", weights=[4, 4, 3, 1], k=pick.randint(0, 14)))
        state, found = {}, []
        for i, letter in enumerate(text):
            symbol = pattern.alphabet.index(WORDS[letter]) if WORDS.get(letter) in pattern.alphabet else -1
            state = pattern.step(state, symbol, (0, i))
            if start := pattern.found(state):
                found.append((start[1], i))
        assert found == longest(text, case), text


@pytest.mark.parametrize("text", ["", "a |", "(a", "a)", "a{2,1}", "a{0}", "* a", "a & b"])
def test_what_is_no_pattern(text):
    with pytest.raises(ValueError):
        Pattern(text)


@pytest.mark.parametrize("case", ["(a|b)+c", "a{1,3}b", "((a|b){2}|c)+a"])
def test_split_keys_match_alike(spark, case):
    pick = random.Random(1)
    rows = []
    for key in ("k", None, "m"):
        for i in range({"k": 400}.get(key, 30)):
            rows.append((key, i // 2, i, pick.choice(["ant", "ant", "bee", "bee", "cat", "dog", None])))
    df = spark.createDataFrame(rows, "k string, o int, t int, v string")
    want = []
    for key in ("k", None, "m"):
        own = [r for r in rows if r[0] == key]
        text = "".join((r[3] or "x")[0] for r in own)
        want += [(key, own[a][1], own[a][2], own[z][1], own[z][2]) for a, z in longest(text, case)]
    for options in ({}, {"hot_rows": 0}, {"hot_rows": 100}):
        found = load.sequence_match(df, ["k"], "o", "t", "v", spelled(case), **options)
        assert found.columns == ["k", "match_start", "first_row", "match_end", "last_row"]
        assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str), options
    assert load.sequence_match(df.limit(0), ["k"], "o", "t", "v", spelled(case), hot_rows=0).count() == 0
