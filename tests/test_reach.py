"""Graphs searched in files give what rounds of joins give, and make no pair that is shuffled."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import graph, reach

EDGES = "src struct<w:int,n:string>, dst struct<w:int,n:string>"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def tangle(spark):
    """Cycles, loops, repeated edges, nulls within vertices and in their place, and a hub."""
    rng = random.Random(5)
    vertex = lambda: rng.choice([(i % 3, f"n{i}") for i in range(40)] + [(None, "x"), (1, None)])
    pairs = [(vertex(), vertex()) for _ in range(70)] + [((0, "n0"), None), (None, (0, "n0")), ((2, "n2"), None)] + [((0, "n3"), (i % 3, f"n{i}")) for i in range(20)]
    edges = spark.createDataFrame(pairs + pairs[:9], EDGES)
    starts = [(r, vertex()) for r in [1, 2, 3, 3, 3, 4, None]] + [(5, (9, "unknown")), (6, None), (7, (0, "n0")), (7, (0, "n0"))]
    return edges, spark.createDataFrame(starts, "root int, node struct<w:int,n:string>")


@pytest.mark.parametrize("reverse, depth", [(False, None), (True, None), (False, 2), (False, 0)])
def test_files_and_rounds_agree(tangle, monkeypatch, reverse, depth):
    edges, starts = tangle
    in_files = graph.traverse(edges, starts, depth, reverse)
    monkeypatch.setattr(reach, "MOST_EDGES", -1)
    in_rounds = graph.traverse(edges, starts, depth, reverse)
    assert in_files.schema.simpleString() == in_rounds.schema.simpleString()
    assert rows(in_files) == rows(in_rounds) and bool(depth == 0) != bool(rows(in_files))


def test_no_round_joins_a_graph_that_fits(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "src long, dst long")
    spark.sparkContext.setJobGroup("chain", "chain")
    found = graph.downstream(chain, spark.range(3).withColumnRenamed("id", "root"))
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert n < 60 and plan(found).count("Join") <= 1  # of the starts with their roots' numbers
    assert found.agg(F.count("*"), F.max("depth")).first()[:] == (60 + 59 + 58, 60)


def test_columns_are_known_before_pairs_are_made(spark, monkeypatch):
    refs = spark.createDataFrame([("a", 1, "b", 1), ("b", 1, "ghost", 9), ("ghost", 9, "d", 1), ("a", 2, "d", 2), ("d", 1, None, None)], "src_node string, src_column int, dst_node string, dst_column int")
    columns = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("d", 1, "x"), ("d", 1, "again"), ("d", 2, "y"), (None, None, "z")], "node_id string, column_id int, name string")
    roots = spark.createDataFrame([("a",), ("b",), ("none",)], "root string")
    found = graph.impact_columns(graph.column_edges(refs), columns, roots)
    deal, result = plan(found).count("Join"), rows(found)
    assert deal <= 1  # of the starts with their roots' numbers, none of the columns
    assert found.columns == ["node_id", "column_id", "root", "depth", "name"]
    assert sorted((r["root"], r["node_id"], r["column_id"], r["depth"], r["name"]) for r in found.collect()) == [
        ("a", "b", 1, 1, "x"), ("a", "d", 1, 3, "again"), ("a", "d", 1, 3, "x"), ("a", "d", 2, 1, "y"), ("b", "d", 1, 2, "again"), ("b", "d", 1, 2, "x"),
    ]
    monkeypatch.setattr(reach, "MOST_EDGES", -1)
    assert rows(graph.impact_columns(graph.column_edges(refs), columns, roots)) == result


def test_summary_and_depths_count_pairs_without_a_join_of_them(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (3, 1), (4, 4)], "src long, dst long")
    refs = spark.createDataFrame([(1, 10, 2, 20), (2, 20, 3, 30), (3, 30, 1, 11)], "src_node long, src_column long, dst_node long, dst_column long")
    columns = spark.createDataFrame([(1, 10, "x"), (1, 11, "y"), (2, 20, "x"), (3, 30, "x")], "node_id long, column_id long, name string")
    roots = spark.createDataFrame([(1,), (3,), (4,), (9,)], "root long")
    hit = graph.impact_nodes(edges, roots)
    depths = graph.impact_by_depth(hit)
    assert plan(depths).count("Join") <= 1
    assert sorted(map(tuple, depths.collect())) == [(1, 1, 2), (3, 1, 1), (3, 2, 1)]
    whole = graph.impact_summary(hit, graph.impact_columns(graph.column_edges(refs), columns, roots))
    assert plan(whole).count("Join") <= 3
    assert sorted((r["root"], r["impacted_nodes"], r["deepest"], r["impacted_columns"]) for r in whole.collect()) == [(1, 2, 1, 2), (3, 2, 2, 1)]


def test_pieces_of_a_front():
    assert [*reach.cuts(np.array([0, 2, 0, 3, 9, 1, 0]), 5)] == [(0, 4), (4, 5), (5, 7)]
    assert [*reach.cuts(np.array([0, 0]), 5)] == [*reach.cuts(np.array([], int), 5)] == []
    assert reach.spans(np.array([5, 1, 7]), np.array([2, 0, 3])).tolist() == [5, 6, 7, 8, 9]
