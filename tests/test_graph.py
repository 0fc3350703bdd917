"""Graph shapes: chain, diamond, cycle, unknown ids, ties, depth limits."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import graph, load
from millrace.sources import catalog


def edge_frame(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def roots(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "root string")


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


DIAMOND = [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e")]


def test_diamond_depth_is_fewest_hops(spark):
    found = graph.downstream(edge_frame(spark, DIAMOND + [("a", "e")]), roots(spark, "a"))
    assert rows(found, "node", "depth") == [("b", 1), ("c", 1), ("d", 2), ("e", 1)]


def test_upstream_and_several_roots(spark):
    found = graph.upstream(edge_frame(spark, DIAMOND), roots(spark, "d", "b", "zzz"))
    assert rows(found, "root", "node", "depth") == [("b", "a", 1), ("d", "a", 2), ("d", "b", 1), ("d", "c", 1)]


def test_cycle_ends_and_start_is_left_out(spark):
    found = graph.downstream(edge_frame(spark, [("a", "b"), ("b", "c"), ("c", "a")]), roots(spark, "a"))
    assert rows(found, "node", "depth") == [("b", 1), ("c", 2)]


def test_depth_limit_and_long_chain(spark):
    chain = edge_frame(spark, [(f"n{i:02}", f"n{i + 1:02}") for i in range(25)])
    assert graph.downstream(chain, roots(spark, "n00"), max_depth=3).count() == 3
    assert graph.downstream(chain, roots(spark, "n00")).agg(F.max("depth")).first()[0] == 25


def test_vertices_can_be_structs(spark):
    packed = graph.pack(
        spark.createDataFrame([(1, "a", "b"), (2, "a", "c")], "ws int, s string, d string"), src=["ws", "s"], dst=["ws", "d"]
    )
    start = packed.select(F.col("src").alias("root"))
    assert rows(graph.downstream(packed, start).select("root.p0", "node.p1"), "p0", "p1") == [(1, "b"), (2, "c")]


def test_critical_path_takes_the_longest(spark):
    path = graph.critical_path(edge_frame(spark, DIAMOND + [("a", "e"), ("c", "b")]), roots(spark, "a", "d"))
    assert rows(path, "root", "position", "node") == [
        ("a", 0, "a"), ("a", 1, "c"), ("a", 2, "b"), ("a", 3, "d"), ("a", 4, "e"), ("d", 0, "d"), ("d", 1, "e"),
    ]


def test_longest_paths_stop_at_cycles(spark):
    # b and c form a cycle: b receives a distance but passes nothing on; d is behind it.
    paths = graph.longest_paths(
        edge_frame(spark, [("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"), ("a", "x")]),
        roots(spark, "a").withColumn("node", F.col("root")),
    )
    assert rows(paths, "node", "dist") == [("a", 0), ("b", 1), ("x", 1)]
    alone = graph.critical_path(edge_frame(spark, [("b", "c"), ("c", "b")]), roots(spark, "b"))
    assert rows(alone, "position", "node") == [(0, "b")]


def test_chain_depth_of_long_chains_cycles_and_missing_predecessors(spark):
    pairs = [(f"n{i:02}", f"n{i + 1:02}") for i in range(30)] + [("p", "q"), ("q", "p"), ("q", "r"), ("gone", "s")]
    nodes = spark.createDataFrame([(f"n{i:02}",) for i in range(31)] + [("p",), ("q",), ("r",), ("s",)], "node_id string")
    depth = {r[0]: r[1] for r in graph.chain_depth(nodes, edge_frame(spark, pairs)).collect()}
    assert [depth["n00"], depth["n07"], depth["n30"]] == [0, 7, 30]
    assert [depth["p"], depth["q"], depth["r"], depth["s"]] == [2, 2, 3, 1]


def test_chain_depth_follows_first_position(spark):
    edges = spark.createDataFrame([("a", "c", 1), ("b", "c", 0), ("z", "a", 0)], "src string, dst string, pos int")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("z",)], "node_id string")
    assert {r[0]: r[1] for r in graph.chain_depth(nodes, edges).collect()} == {"a": 1, "b": 0, "c": 1, "z": 0}


def test_impact_of_one_column_and_unknown_columns(spark):
    refs = spark.createDataFrame(
        [("a", "1", "b", "1"), ("a", "2", "b", "2"), ("b", "1", "ghost", "9"), ("ghost", "9", "d", "1")],
        "src_node string, src_column string, dst_node string, dst_column string",
    )
    columns = spark.createDataFrame(
        [("a", "1", "x"), ("a", "2", "y"), ("b", "1", "x"), ("b", "2", "y"), ("d", "1", "x")],
        "node_id string, column_id string, name string",
    )
    edges = graph.column_edges(refs)
    one = graph.impact_columns(edges, columns, spark.createDataFrame([("a", "1")], "root string, column_id string"))
    assert rows(one, "node_id", "column_id", "depth") == [("b", "1", 1), ("d", "1", 3)]
    everything = graph.impact_columns(edges, columns, roots(spark, "a"))
    assert everything.count() == 3
    both = graph.column_lineage(edges, columns.filter("node_id = 'b' AND column_id = '1'"), columns)
    assert rows(both, "direction", "node_id") == [("downstream", "d"), ("upstream", "a")]


def test_predecessor_rules(spark):
    docs = [
        '{"workspaceID":"w","id":"a","name":"A","nodeType":"Stage"}',
        '{"workspaceID":"w","id":"b","name":"B","nodeType":"Stage","predecessorNodeIDs":["a","out"],"metadata":{"sourceMapping":[]}}',
        '{"workspaceID":"w","id":"c","name":"C","nodeType":"Stage","metadata":{"sourceMapping":[{"aliases":{"A":"a","X":"out"},"dependencies":["b",{"nodeID":"a"},{"nodeName":"n"}]}]}}',
        '{"id":"bad","nodeType":"Stage"}',
        "not json",
    ]
    nodes = catalog.parse_nodes(spark.createDataFrame([(d,) for d in docs], "raw string"), "raw")
    assert rows(nodes, "id") == [("a",), ("b",), ("c",)]
    assert rows(graph.extract_edges(nodes, "lineage"), "src", "dst") == [("a", "c"), ("b", "c")]
    assert rows(graph.extract_edges(nodes, "health"), "src", "dst") == [("a", "b"), ("a", "c"), ("b", "c")]
    assert rows(graph.extract_edges(nodes, "review"), "src", "dst") == [("a", "b"), ("out", "b")]
    assert rows(graph.extract_edges(nodes, "join"), "src", "dst") == [("a", "c"), ("out", "c")]
    with pytest.raises(ValueError):
        graph.extract_edges(nodes, "other")


def test_references_in_expressions(spark):
    texts = {
        '"SRC"."EAAN8"': ["SRC.EAAN8"],
        "CAST(SRC.EAAN8 AS INT)": ["SRC.EAAN8"],
        "COALESCE(A.X, B.Y, A.X)": ["A.X", "B.Y"],
        "'ABC.DEF' || t.col": ["T.COL"],
        '"MY.SCHEMA"."COL"': [],
        "42": [],
        "TRIM.X": [],
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r[0]: r[1] for r in df.select("t", graph.qualified_refs(F.col("t"))).collect()}
    assert {t: list(v) for t, v in found.items() if t != '"MY.SCHEMA"."COL"'} == {
        t: v for t, v in texts.items() if t != '"MY.SCHEMA"."COL"'
    }
    assert "MY.SCHEMA" not in found['"MY.SCHEMA"."COL"']


def test_two_part_names_only_after_from_or_join(spark):
    sql = """SELECT "A"."ID" FROM "L"."T" "A" JOIN "DB"."L2"."U" "B" ON "A"."ID" = "B"."ID" WHERE x IN (SELECT 1 FROM {{ ref('R', 'N') }})"""
    found = graph.refs_from_sql(spark.createDataFrame([(1, sql)], "node_id int, sql string"))
    assert rows(found, "location", "name") == [("L", "T"), ("L2", "U"), ("R", "N")]


def test_recursive_expand_counts_paths(spark):
    seed = spark.createDataFrame([("a", "a")], "root string, node string")
    found = load.recursive_expand(seed, edge_frame(spark, DIAMOND))
    assert rows(found, "node", "depth", "paths") == [("a", 0, 1), ("b", 1, 1), ("c", 1, 1), ("d", 2, 2), ("e", 3, 2)]
    with pytest.raises(ValueError):
        load.recursive_expand(seed, edge_frame(spark, [("a", "b"), ("b", "a")]))
    cyclic = load.recursive_expand(seed, edge_frame(spark, [("a", "b"), ("b", "a")]), max_depth=3)
    assert rows(cyclic, "node", "depth") == [("a", 0), ("a", 2), ("b", 1), ("b", 3)]


def test_propagation_takes_the_nearest_change(spark):
    refs = spark.createDataFrame(
        [("a", 1, "b", 1), ("b", 1, "c", 1)], "src_node string, src_column int, dst_node string, dst_column int"
    )
    columns = spark.createDataFrame([(n, 1, "x", "INT") for n in "abc"], "node_id string, column_id int, name string, data_type string")
    changes = spark.createDataFrame([("a", 1, "far", None), ("b", 1, "near", "TEXT")], "node_id string, column_id int, new_name string, new_type string")
    after, before = graph.propagate_column_change(columns, graph.column_edges(refs), changes)
    assert rows(after, "node_id", "name", "data_type", "changed") == [("a", "x", "INT", False), ("b", "far", "INT", True), ("c", "near", "TEXT", True)]
    assert rows(before, "node_id", "name") == [("b", "x"), ("c", "x")]


def test_lineage_kept_by_name(spark):
    new = spark.createDataFrame([(1, " Id ", None), (1, "own", ["n"]), (1, "none", [])], "node_id int, name string, refs array<string>")
    old = spark.createDataFrame([(1, "ID", ["o"]), (1, "OWN", ["o"]), (1, "none", [])], "node_id int, name string, refs array<string>")
    kept = {r["name"]: r["refs"] for r in graph.preserve_lineage(new, old).collect()}
    assert kept == {" Id ": ["o"], "own": ["n"], "none": []}
