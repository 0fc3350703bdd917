import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import textops
from millrace.llm.components import components
from millrace.sources.scratch import Scratch
from tests.llm.helpers import ODD, spaced

TEXTS = ["Ab cD\n\nab", None, "", "  x\x0by z ", "É é E e", "a" * 3_000_000 + " b", "ab"] + [r[1] for r in ODD]


def test_words_are_those_of_the_pattern_whatever_the_slices():
    found, seen = [], {}
    for w in textops.words(pa.array(TEXTS)):
        hashes = w.hashes()
        for r in range(len(w.first) - 1):
            own = range(w.first[r], w.first[r + 1])
            found.append([w.data[w.starts[i] : w.ends[i]].tobytes().decode() for i in own])
            for i, word in zip(own, found[-1], strict=True):
                assert seen.setdefault(word, hashes[i]) == hashes[i]
    assert found == [spaced(t) for t in TEXTS]
    assert len(set(seen.values())) == len(seen)


def test_words_of_a_sliced_array():
    whole = pa.array(["zero", "one two", None, "three"])
    parts = [len(w.first) - 1 for w in textops.words(whole.slice(1, 2))]
    assert sum(parts) == 2
    assert list(textops.words(whole.slice(0, 0))) == []


def test_grams_tell_order_and_place():
    h = textops.mixed(np.arange(6, dtype=np.uint64))
    assert len(set(textops.grams(h, 3).tolist())) == 4
    assert textops.grams(h[[0, 1]], 2) != textops.grams(h[[1, 0]], 2)
    assert len(textops.grams(h[:2], 3)) == 0
    assert textops.folded(h[:2]) == textops.folded(h[:2].copy()) != textops.folded(h[:3])


@pytest.mark.parametrize(
    "links",
    [[], [(1, 1)], [(k, k + 1) for k in range(30)], [(0, k) for k in range(1, 40)] + [(100, 101)], [(5, 3), (3, 5), (9, 4), (4, 3), (20, 21)]],
)
def test_components_of_chains_stars_and_pairs(spark, links):
    root: dict[int, int] = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for pair in links for x in pair if find(x) != x}
    found = components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t"))
    assert {r["id"]: r["component"] for r in found.collect()} == want
