import random
from collections import defaultdict

import pytest

from millrace.llm import jaccard
from millrace.llm.queries import QUERIES
from tests.llm.helpers import FOLDER, ODD, documents, spaced, with_clashes


def brute(rows, percent=80):
    """{doc_id: (set size, component)} by an index of all shingles."""
    sets = {}
    for i, text in rows:
        w = spaced(text)
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders, shared = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for ids in holders.values():
        for x in range(len(ids)):
            for y in range(x):
                shared[ids[y], ids[x]] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def edited(pick, words, share):
    return [pick.choice(words) if pick.random() < share else w for w in words]


def test_query_on_all_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert result(QUERIES["op2_jaccard_join"](spark, FOLDER)) == brute(rows)


@pytest.mark.parametrize("tile,leaf", [(1024, 32), (7, 3)])
def test_groups_of_near_copies_around_the_threshold(spark, monkeypatch, tile, leaf):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    pick = random.Random(2)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, line = [], [pick.choice(vocabulary) for _ in range(30)]
    for g in range(6):
        base = [pick.choice(vocabulary) for _ in range(pick.choice([4, 5, 30, 90, 700]))]
        for k in range(12):
            rows.append(" ".join(edited(pick, base, 0.004 * k) + (line if g % 2 else [])))
            if k > 6:  # copies of copies link in chains
                base = edited(pick, base, 0.02)
    rows = [(i, t) for i, t in enumerate(rows)]
    found = result(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == brute(rows)


def test_many_documents_that_are_nearly_similar(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 16)
    pick = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = [(i, " ".join(edited(pick, base, 0.02 + 0.0005 * i))) for i in range(60)]
    assert result(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_odd_rows_clashing_names_and_empty_tables(spark):
    docs = with_clashes(documents(spark, [*ODD, (907, "ONE two three four five six seven", "en", "s", 1)]))
    found = [tuple(r) for r in jaccard.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == sorted(
        [(901, 0, 901), (902, 0, 902), (903, 0, 903), (904, 1, 904), (904, 1, 904), (None, 3, None), (905, 1, 905), (906, 1, 906), (907, 3, 907)], key=str
    )
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_points_bound_the_overlap():
    import numpy as np

    pick = np.random.default_rng(1)
    for n in (3, 200, 900, 5000):
        a = np.unique(pick.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], pick.integers(0, 1 << 62, 2 * n).astype(np.uint64)]))
        bound = jaccard.shared_at_most(jaccard.point(a), jaccard.point(b))
        assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))
