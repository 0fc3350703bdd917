import numpy as np
import pytest

from millrace.llm import multiindex
from tests.llm.helpers import FOLDER

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.98):
    x = {i: np.array(v, float) for i, v, lab in rows if v and lab is not None and all(c is not None for c in v) and np.isfinite(np.array(v, float)).all() and any(v)}
    label = {i: lab for i, _, lab in rows}
    links, root = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(x)
    for p, a in enumerate(ids):
        for b in ids[:p]:
            if label[a] == label[b] and len(x[a]) == len(x[b]) and x[a] @ x[b] / np.sqrt(x[a] @ x[a]) / np.sqrt(x[b] @ x[b]) >= least:
                links[a], links[b] = links[a] + 1, links[b] + 1
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
    return {i: (links[i], find(i), find(i) == i) for i in links}


def near_groups(seed, n=240, size=16):
    pick = np.random.default_rng(seed)
    rows, base = [], pick.normal(size=(12, size))
    for i in range(n):
        v = base[pick.integers(0, 12)] + pick.normal(size=size) * pick.choice([0.02, 0.1, 0.2])
        rows.append((i, [float(c) for c in np.float32(v * pick.choice([1, 7]))], int(pick.integers(0, 2))))
    return rows + [(n + k, rows[k % 5][1], rows[k % 5][2]) for k in range(40)]


def result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.mark.parametrize("block", [2048, 9])
def test_exact_where_recall_is_one(spark, monkeypatch, block):
    monkeypatch.setattr(multiindex, "BLOCK", block)
    rows = near_groups(block)
    assert result(multiindex.near_duplicates(spark.createDataFrame(rows, SCHEMA), codewords=5, recall=1.0)) == brute(rows)


def test_recall_of_the_query_s_parameters(spark):
    rows = near_groups(3, 400, 32)
    found, want = result(multiindex.near_duplicates(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    assert all(found[i][0] <= want[i][0] for i in want)
    assert sum(v[0] for v in found.values()) >= 0.99 * sum(v[0] for v in want.values()) > 0


def test_query_s_table_with_planted_pairs(spark):
    """The given vectors hold hardly a pair, so that copies turned by just under and just over the limit are added."""
    given = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    pick, rows = np.random.default_rng(7), [(r["vec_id"], r["embedding"], r["label"]) for r in given]
    planted = 100_000
    for k, (_, v, label) in enumerate(rows[:600]):
        x = np.array(v, float)
        away = pick.normal(size=len(x))
        away -= (away @ x) / (x @ x) * x
        cos = (0.9995, 0.985, 0.9801, 0.9799, 0.97)[k % 5]
        turned = cos * x / np.sqrt(x @ x) + np.sqrt(1 - cos**2) * away / np.sqrt(away @ away)
        rows.append((planted + k, [float(c) for c in np.float32(turned * 3)], label))
    found, want = result(multiindex.near_duplicates(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    total = sum(v[0] for v in want.values())
    assert total >= 2 * 300 and all(found[i][0] <= want[i][0] for i in want)
    assert sum(v[0] for v in found.values()) >= 0.98 * total


def test_cells_stay_as_full_as_the_vectors_grow():
    assert [multiindex.codewords_for(n) for n in (0, 100, 64 * 40**2, 64 * 160**2, 10**12)] == [16, 16, 40, 160, 512]


def test_traversal_visits_cells_in_ascending_order():
    pick = np.random.default_rng(5)
    one, two = pick.random(7), pick.random(9)
    cells = list(multiindex.traversal(one, two, 0.8))
    sums = [one[i] + two[j] for i, j in cells]
    assert sums == sorted(sums) and len(set(cells)) == len(cells)
    assert set(cells) == {(i, j) for i in range(7) for j in range(9) if one[i] + two[j] <= 0.8}


def test_odd_vectors_clashing_names_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, [1.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1.0], 1), (13, [3.0], 1),
        (14, [1e30, 0.0], 1), (15, [1e-30, 0.0], 1), (16, [-1.0, 0.0], 1),
    ]
    vectors = spark.createDataFrame([*rows, (None, [1.0, 0.0], 1)], SCHEMA).selectExpr("*", "1 AS n_links", "2 AS rep", "3 AS weight", "4 AS cell")
    found = multiindex.near_duplicates(vectors, recall=1.0)
    own = result(found)
    assert own.pop(None) == (0, None, None)
    assert own == brute(rows)
    assert own[1] == (3, 1, True) and own[13] == (1, 12, False)
    assert multiindex.near_duplicates(vectors.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)], SCHEMA)
    assert [tuple(r) for r in multiindex.near_duplicates(twice).collect()] == [(1, 1, 1, True)] * 2
