"""Frames that grow with the catalogue are joined by shuffles, not sent whole through the driver."""

from millrace.operators import classify, joins, review


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def columns(spark, transform=None):
    rows = [(n, 10 * n + i, i, name, transform) for n in range(1, 4) for i, name in enumerate(["ID", "CODE", "AMOUNT"])]
    return spark.createDataFrame(rows, "node_id long, column_id long, ordinal int, name string, transform string")


def test_column_roles_do_not_broadcast_marks(spark):
    found = classify.infer_column_roles(columns(spark).selectExpr("*", "ordinal = 1 AS is_business_key", "false AS is_change_tracking"))
    assert "BroadcastHashJoin" not in plan(found)
    assert sorted(r["column_id"] for r in found.where("business_key").collect()) == [11, 21, 31]


def test_suggested_joins_do_not_broadcast_holders(spark):
    held = spark.createDataFrame([(1, 1, 7, 0, "ID"), (1, 2, 8, 0, "id"), (1, 2, 8, 1, "X"), (1, 3, 9, 0, "x")], "node_id long, pos int, pred_id long, ordinal int, name string")
    found = joins.suggest_joins(held)
    assert "BroadcastHashJoin" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [(1, 1, 2, 7, 8, "ID", "ID", "id"), (1, 2, 3, 8, 9, "X", "X", "x")]


def test_review_facts_do_not_broadcast_what_grows_with_the_nodes(spark):
    nodes = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "node_id long, name string")
    edges = spark.createDataFrame([(1, 2), (1, 3)], "src long, dst long")
    blank = spark.createDataFrame([(2, "ON 1 = 1"), (3, " ")], "node_id long, join_condition string")
    refs = spark.createDataFrame([(1, 10, 2, 20)], "src_node long, src_column long, dst_node long, dst_column long")
    found = review.facts(nodes, edges, columns(spark), blank, refs)
    assert "BroadcastHashJoin" not in plan(found)
    assert sorted((r["node_id"], r["succs"], r["preds"], r["joined"], r["unused"]) for r in found.collect()) == [(1, 2, 0, None, 2), (2, 0, 1, True, 3), (3, 0, 1, None, 3)]


def test_sources_filtered_by_verdict_make_each_mask_once(spark):
    from millrace.operators import diff

    corpus = spark.createDataFrame([(1, "SELECT 1 FROM A", "WITH c AS (SELECT 1) SELECT 1 FROM c"), (2, "SELECT 1 FROM A", "SELECT 1 FROM A")], "node_id long, before_sql string, after_sql string")
    found = diff.diff_sources(corpus).filter("verdict = 'unsupported'").select("node_id")
    assert plan(found).count("regexp_extract_all(before_sql") + plan(found).count("regexp_extract_all(__before") <= 4
    assert [r[0] for r in found.collect()] == [1]


def test_terms_are_resolved_without_a_row_for_every_job_and_node(spark):
    from millrace.operators import resolve

    terms = [(j, side, 0, "t", "subgraph", None, name, None) for j, side, name in [(1, "include", "G"), (1, "exclude", "H"), (2, "include", "G"), (None, "include", "G"), (None, "exclude", "H"), (3, "include", "NONE")]]
    terms = spark.createDataFrame(terms, "job_id long, side string, term_no int, term string, kind string, location string, name string, warning string")
    graphs = spark.createDataFrame([(7, "G", 1), (7, "G", 2), (8, "H", 2), (8, "H", 9)], "subgraph_id int, subgraph_name string, node_id long")
    nodes = spark.createDataFrame([(1, None, "A"), (2, None, "B")], "node_id long, location string, name string")
    kept, lost = resolve.resolve_job_nodes(terms, graphs, nodes)
    assert sorted((r["job_id"] or 0, r["node_id"], r["subgraph_id"]) for r in kept.collect()) == [(0, 1, 7), (0, 2, 7), (1, 1, 7), (2, 1, 7), (2, 2, 7)]
    assert sorted((r["job_id"] or 0, r["side"]) for r in lost.collect()) == [(0, "exclude"), (0, "include"), (3, "include")]
    assert "anti" in plan(lost).lower() and "node_id" not in plan(lost).split("LeftAnti")[0]


def test_frames_to_the_end_run_backwards(spark):
    from pyspark.sql import functions as F

    from millrace.functions.ordered import Frame, framed

    rows = spark.range(20).select((F.col("id") % 2).alias("k"), "id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    frames = {f"{f}_{hot}": Frame(f, "v", ("k",), "id", None, 2, None) for f in ("sum", "count", "min", "max", "first", "last") for hot in ("at",)}
    whole = framed(rows, frames)
    assert "specifiedwindowframe(RowFrame, -2, unboundedfollowing" not in plan(whole)
    want = rows.select("k", "id", *[F.expr(f"{f}(v) OVER (PARTITION BY k ORDER BY id ROWS BETWEEN 2 PRECEDING AND UNBOUNDED FOLLOWING)").alias(f"{f}_at") for f in ("sum", "count", "min", "max", "first", "last")])
    for found in (whole, framed(rows, frames, hot_rows=0, block_rows=4)):
        assert sorted(map(str, found.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_schema_versions_are_joined_by_shuffles(spark):
    from millrace.operators import diff

    before = spark.createDataFrame([(1, 0, "A", "INT", "x"), (1, 1, "B", "INT", "y")], "node_id long, ordinal int, name string, data_type string, expression string")
    after = spark.createDataFrame([(1, 0, "A", "INT", "x"), (1, 1, "C", "INT", "y")], "node_id long, ordinal int, name string, data_type string, expression string")
    found = diff.diff_columns(before, after)
    assert "BroadcastHashJoin" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [(1, "A", "A", "unchanged"), (1, "B", "C", "renamed")]


def test_edges_parse_the_documents_once(spark):
    from millrace.operators import graph
    from millrace.sources import catalog

    raw = spark.createDataFrame([('{"workspaceID":"w","id":"%s","name":"n","nodeType":"t","predecessorNodeIDs":["a"],"metadata":{"sourceMapping":[{"aliases":{"x":"a"},"dependencies":["b"]}]}}' % i,) for i in "abc"], "raw string")
    found = graph.extract_edges(catalog.parse_nodes(raw, "raw"), "health")
    assert "from_json" not in plan(found)
    assert sorted((r["src"], r["dst"]) for r in found.collect()) == [(s, d) for s in "ab" for d in "abc"]


def test_job_nodes_come_in_blocks_job_after_job(spark, tmp_path, monkeypatch):
    import itertools
    import os

    from millrace.operators import resolve

    terms = [(j, "include", 0, "t", "subgraph", None, "G", None) for j in range(200)] + [(999, "include", 0, "t", "subgraph", None, "H", None)]
    terms = spark.createDataFrame(terms, "job_id long, side string, term_no int, term string, kind string, location string, name string, warning string")
    graphs = spark.range(1000).selectExpr("CAST(id % 3 AS int) AS subgraph_id", "CASE WHEN id % 3 = 0 THEN 'H' ELSE 'G' END AS subgraph_name", "id * 7919 AS node_id")
    nodes = graphs.selectExpr("node_id", "CAST(null AS string) AS location", "'n' AS name")
    monkeypatch.setattr(resolve, "PARTS", 2)
    kept, _ = resolve.resolve_job_nodes(terms, graphs.unionByName(graphs), nodes)
    kept.write.parquet(str(tmp_path / "kept"))
    found = [r["job_id"] for r in kept.collect()]
    assert len(found) == 200 * 666 + 334 and kept.distinct().count() == len(found)
    assert len([*itertools.groupby(found)]) <= len(found) / 100
    assert sum(f.stat().st_size for f in os.scandir(tmp_path / "kept") if f.name.endswith(".parquet")) < len(found) / 2
