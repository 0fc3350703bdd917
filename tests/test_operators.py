"""Edge cases of the operators on small literal frames."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import dialect, rules
from millrace.functions.names import norm_expression, norm_identifier
from millrace.operators import aggregate, classify, diff, joins, load, project, profile, resolve, review, runs, search, sorting, textindex, windows
from millrace.plans.steps import run_steps, step_kind, step_order
from millrace.sources.scratch import Scratch


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expression.alias("x")).first()["x"]


# ---- rules -------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, kind",
    [
        ("DATEDIFF(day, MIN(A_TS), MAX(B_TS))", "NUMBER"),
        ("DATEADD(day, 1, x)", "DATE"),
        ("count (x)", None),
        ("count(distinct x)", "NUMBER"),
        ("SUM(x)", "NUMBER(38,4)"),
        ("max(ORDER_TS)", "TIMESTAMP_NTZ(9)"),
        ("min(order_date)", "DATE"),
        ("min(x)", None),
        ("Upper(x)", "VARCHAR"),
        ("case when 1 then 2 end", "VARCHAR"),
        ("ROW_NUMBER() OVER (ORDER BY x)", "NUMBER"),
        ("x + 1", None),
    ],
)
def test_infer_type(spark, text, kind):
    assert one(spark, rules.infer_type(F.lit(text))) == kind


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, True),
        ("  ", True),
        ("Amount", True),
        ('"amount"', True),
        ('"SRC" . "AMOUNT"', True),
        ("{{ ref('L', 'N') }}.\"AMOUNT\"", True),
        ('"SRC"."OTHER"', False),
        ("SRC.AMOUNT", False),
        ("amount + 0", False),
    ],
)
def test_passthrough(spark, text, expected):
    assert one(spark, rules.is_passthrough(F.lit(text).cast("string"), F.lit("AMOUNT"))) is expected


@pytest.mark.parametrize(
    "signal, family",
    [
        ("Persistent Stage", "persistent-stage"),
        ("persistentStage", "persistent-stage"),
        ("work stage", "stage"),
        ("stg orders", "stage"),
        ("data-view", "view"),
        ("cwrk", "work"),
        ("dim", "dimension"),
        ("FCT sales", "fact"),
        ("hub", "hub"),
        ("sat", "satellite"),
        ("link", "link"),
        ("stages", "unknown"),
        ("base-nodes:::Stage", "unknown"),
    ],
)
def test_family(spark, signal, family):
    assert one(spark, rules.family(F.lit(signal))) == family


def test_layer_name_beats_type(spark):
    cases = [("stg_x", "Dimension", "staging"), ("x", "pkg:::Fact", "mart"), ("LANDING_x", "View", "bronze"), ("tmp_x", "a", "intermediate"), ("x", "y", "unknown")]
    for name, kind, expected in cases:
        assert one(spark, rules.layer(F.lit(name), F.lit(kind))) == expected


def test_aggregate_detection_strict_and_loose(spark):
    for text, strict, loose in [("SUM(x) OVER (PARTITION BY y)", False, True), ("ADMIN(x)", False, True), ("max (x)", True, False)]:
        assert one(spark, rules.is_aggregate(F.lit(text))) is strict
        assert one(spark, rules.is_aggregate(F.lit(text), strict=False)) is loose


def test_identifiers_and_expressions(spark):
    assert one(spark, norm_identifier(F.lit(' "My Col" '))) == "MY COL"
    assert one(spark, norm_expression(F.lit("COUNT( X . A ,\n  b )  AND  c"))) == "COUNT(X.A,b)AND c"


def test_dialect(spark):
    assert one(spark, dialect.trunc_number(F.lit(-2.79), 1)) == -2.7
    assert one(spark, dialect.decode(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("null"), F.lit("d"))) == "null"
    assert one(spark, dialect.to_double(F.lit("x"))) is None
    assert [dialect.spark_type(t) for t in ("NUMBER", "number(10,2)", "VARCHAR(5)", "TIMESTAMP_NTZ(9)", "bigint")] == [
        "decimal(38,0)", "decimal(10,2)", "string", "timestamp_ntz", "bigint",
    ]


# ---- projection ----------------------------------------------------------------------------------


def test_where_and_wildcards(spark):
    df = spark.range(5)
    assert project.add_where(df, '  WHERE  id > 1 AND "x" <> \\"y\\" ').count() == 3
    assert project.add_where(df, None).count() == 5
    with pytest.raises(ValueError):
        project.expand_wildcard({"a": df, "b": df}, df)
    with pytest.raises(ValueError):
        project.drop_column(df, "nope")


def test_conform_reports(spark):
    df = spark.createDataFrame([(1, "7x", "gone")], " ID int, amount string, Extra string")
    out, report = project.conform_to_schema(
        df, [project.Target("amount", "NUMBER(9,2)"), project.Target(" id", "NUMBER"), project.Target("new", "DATE"), project.Target("made", "VARCHAR", "upper(Extra)")]
    )
    assert [tuple(r) for r in out.collect()] == [(None, 1, None, "GONE")]
    assert rows(report, "name", "state", "type_changed", "needs_transform") == sorted(
        [("amount", "matched", True, False), (" id", "matched", True, False), ("new", "added", False, True), ("made", "added", False, False), ("Extra", "dropped", False, False)],
        key=str,
    )


def test_search_returns_every_match(spark):
    nodes = spark.createDataFrame([(1, "hit", "View", None, "x" * 100 + "HIT" + "y" * 100, None), (2, "no", "View", None, None, None)], "node_id int, name string, node_type string, sql string, description string, config string")
    columns = spark.createDataFrame([(1, i, f"hit{i}", "INT") for i in range(80)] + [(3, 0, "hit", "INT")], "node_id int, ordinal int, name string, data_type string")
    found = search.search_content(nodes, columns, "hit").collect()
    assert len(found) == 82
    assert {r["node_id"] for r in search.search_content(nodes, columns, "i", limit=1).collect()} == {1}
    assert [r["snippet"] for r in found if r["field"] == "description"] == ["…" + "x" * 60 + "HIT" + "y" * 60 + "…"]
    assert search.search_content(nodes, columns, "hit", ["name"], "view").count() == 1
    assert search.search_content(nodes, columns, "hit", ["name"], "table").count() == 0
    with pytest.raises(ValueError):
        search.search_content(nodes, columns, "")


def test_config_status(spark):
    nodes = spark.sql(
        """SELECT 1 AS node_id, 'Dimension' AS node_type, map('a', '1') AS config, map('b', 's', 'z', 's') AS suggestions, false AS has_key_names, false AS has_key_marks
           UNION ALL SELECT 2, 'View', null, map(), true, false"""
    )
    items = spark.createDataFrame(
        [(t, i, k, r, d) for t in ("Dimension", "View") for i, k, r, d in (("a", "textBox", True, "9"), ("b", "textBox", False, "8"), ("isBusinessKey", "columnSelector", False, None))],
        "node_type string, item string, kind string, required boolean, default_value string",
    )
    done = {r["node_id"]: r for r in classify.complete_config(nodes, items).collect()}
    assert done[1]["applied"] == {"a": "1", "b": "s"} and done[1]["status"] == "needs_attention"
    assert done[2]["applied"] == {"a": "9", "b": "8"} and done[2]["status"] == "complete"


# ---- joins and names -----------------------------------------------------------------------------


def test_join_chain_retries_later_pairs(spark):
    frames = {
        "a": spark.createDataFrame([(1, 2)], "x int, y int"),
        "b": spark.createDataFrame([(7, 8)], "z int, w int"),
        "c": spark.createDataFrame([(1, 7)], " X int, Z int"),
    }
    assert rows(joins.join_on_common(frames)) == [(1, 2, 7, 8)]
    with pytest.raises(ValueError, match="b"):
        joins.join_on_common({"a": frames["a"], "b": frames["b"]})
    assert joins.join_on_common({"a": frames["a"], "b": frames["b"]}, "left", {("a", "b"): [("x", "z")]}).columns == ["x", "y", "z", "w"]
    with pytest.raises(ValueError):
        joins.join_on_common(frames, "sideways")


def test_full_join_merges_keys(spark):
    left = spark.createDataFrame([(1, "l"), (2, "l")], "k int, v string")
    right = spark.createDataFrame([(2, "r"), (3, "r")], "k int, w string")
    assert rows(joins.join_bare({"l": left, "r": right}, "full")) == [(1, "l", None), (2, "l", "r"), (3, None, "r")]


def test_join_guards(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        joins.natural_join(df, spark.createDataFrame([(1,)], "b int"))
    with pytest.raises(ValueError):
        joins.comma_join({"a": df, "b": df}, [])


def test_suggested_pairs_use_the_earliest_holder(spark):
    cols = [(9, 0, "p0", 0, "Id"), (9, 0, "p0", 1, "id "), (9, 1, "p1", 0, "CODE"), (9, 2, "p2", 0, "code"), (9, 2, "p2", 1, "ID")]
    df = spark.createDataFrame(cols, "node_id int, pos int, pred_id string, ordinal int, name string")
    assert rows(joins.suggest_joins(df), "left_pos", "right_pos", "key", "left_name", "right_name") == [(0, 2, "ID", "Id", "ID")]
    pairs = spark.createDataFrame([(9, 1, 2), (9, 0, 1)], "node_id int, left_pos int, right_pos int")
    assert rows(joins.common_columns(joins.key_holders(df), pairs), "left_pos", "right_pos", "key") == [(1, 2, "CODE")]


def test_cardinality_of_empty_and_null_keys(spark):
    left = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (2,)], "k int")
    assert joins.join_cardinality(left, right, [("k", "k")]).first().asDict() == {
        "left_unique": False, "right_unique": True, "predicted_rows": 2, "left_rows": 2, "right_rows": 2,
    }
    assert joins.join_cardinality(left.limit(0), right, [("k", "k")]).first()["predicted_rows"] == 0


@pytest.mark.parametrize(
    "query, candidate, score",
    [("CUSTOMERS", "CUSTOMERS", 100), ("CUSTOMERS", "STG_CUSTOMERS", 90), ("CUSTOMERS", "CUSTOMERS_V", 80), ("TOME", "CUSTOMERS", 70), ("CUSTOMER", "CUSTOMERS", 70), ("CUSTOMERS", "DIM-CUSTOMER", 82), ("ORDERS", "X_ORDER", 78), ("ABC", "XYZ", 0)],
)
def test_entity_scores(spark, query, candidate, score):
    assert one(spark, resolve.entity_score(F.lit(query), F.lit(candidate))) == score
    queries = spark.createDataFrame([(1, query)], "query_id int, name string")
    nodes = spark.createDataFrame([(5, candidate.lower())], "node_id int, name string")
    assert [r["score"] for r in resolve.fuzzy_matches(queries, nodes).collect()] == ([score] if score else [])


def test_selector_grammar(spark):
    jobs = spark.createDataFrame(
        [(1, "{ subgraph: 'My Graph' } OR { location: \"My Loc\" name: N }", None), (2, "  ", ""), (3, "{ location: A }", "{subgraph:}"), (4, "{ subgraph: A OR B }", None)],
        "job_id int, include_selector string, exclude_selector string",
    )
    parsed = rows(resolve.parse_selectors(jobs), "job_id", "side", "kind", "location", "name", "warning")
    assert parsed == [
        (1, "include", "location_name", "My Loc", "N", None),
        (1, "include", "subgraph", None, "My Graph", None),
        (3, "exclude", None, None, None, "unrecognised_clause"),
        (3, "include", None, None, None, "unrecognised_clause"),
        (4, "include", "subgraph", None, "A OR B", None),
    ]


def test_location_terms_and_first_subgraph(spark):
    terms = resolve.parse_selectors(
        spark.createDataFrame([(1, "{ location: L name: N } OR { subgraph: G } OR { subgraph: NONE }", "{ location: L name: M }")], "job_id int, include_selector string, exclude_selector string")
    )
    nodes = spark.createDataFrame([(1, "N", "L"), (2, "N", "L"), (3, "M", "L"), (4, "Z", None)], "node_id int, name string, location string")
    graphs = spark.createDataFrame([(8, "G", 3), (8, "G", 4), (7, "F", 4), (8, "G", 99)], "subgraph_id int, subgraph_name string, node_id int")
    kept, lost = resolve.resolve_job_nodes(terms, graphs, nodes)
    assert rows(kept, "node_id", "subgraph_name") == [(1, None), (4, "F")]
    assert rows(lost, "term") == [("{ subgraph: NONE }",)]


# ---- aggregates and windows -------------------------------------------------------------------------


def test_window_functions_are_refused_in_groups(spark):
    with pytest.raises(ValueError, match="rn"):
        aggregate.join_to_aggregation({"a": spark.range(3)}, ["id"], {"rn": "row_number() OVER (ORDER BY id)"})


@pytest.mark.parametrize("hot_rows", [0, 10**6])
def test_median_and_mode(spark, hot_rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 9.0), ("a", 9.0), ("a", 2.0), ("b", 3.0), ("b", None), (None, 4.0), (None, 5.0)], "k string, v double")
    assert rows(aggregate.exact_median(df, ["k"], "v", "m", hot_rows=hot_rows)) == sorted([("a", 5.5), ("b", 3.0), (None, 4.5)], key=str)
    assert rows(aggregate.exact_mode(df, ["k"], "v", "m")) == sorted([("a", 9.0), ("b", 3.0), (None, 4.0)], key=str)


def test_latest_and_first_with_ties(spark):
    df = spark.createDataFrame([(1, 5, 2, "b"), (1, 5, 1, "a"), (1, 4, 0, "c"), (2, None, 7, "d")], "k int, t int, i int, v string")
    assert rows(windows.latest_per_key(df, ["k"], "t", "i"), "k", "v") == [(1, "a"), (2, "d")]
    assert rows(windows.latest_per_key(df, ["k"], "t", "v"), "k", "v") == [(1, "a"), (2, "d")]
    assert rows(windows.latest_per_key(df, ["k"], "t"), "k") == [(1,), (2,)]
    assert rows(windows.first_per_key(df, ["k"], "t", "i"), "k", "v") == [(1, "c"), (2, "d")]


def test_sorting_guards(spark):
    df = spark.createDataFrame([("warning", "x", 1), ("critical", "y", 2), ("suggestion", "z", 3)], "severity string, category string, node_id int")
    assert [r["severity"] for r in sorting.severity_sort(df).collect()] == ["critical", "warning", "suggestion"]
    with pytest.raises(ValueError):
        sorting.order_by(df, [("abs(node_id)", "asc")])


def test_profile_of_empty_and_vault_workspaces(spark):
    nodes = spark.createDataFrame(
        [(1, "HUB_A", "Hub", None), (1, "sat_b", "Sat", " "), (1, "DIM_X", "Dimension", "d"), (1, "FACT_X", "Fact", "d")],
        "workspace_id int, name string, node_type string, description string",
    )
    assert rows(profile.detect_methodology(nodes)) == [(1, "data-vault")]
    audited = nodes.withColumn("meta_description", F.lit(None).cast("string"))
    empty = spark.createDataFrame([], "workspace_id int, description string")
    row = profile.documentation_audit(audited, empty).first()
    assert (row["documented_nodes"], row["node_percent"], row["column_percent"]) == (2, 50.0, 0.0)


# ---- review and runs ----------------------------------------------------------------------------------


def test_mixed_case_names(spark):
    nodes = spark.createDataFrame([(1, 1, "MixedCase", "View"), (1, 2, "Mixed_Case", "View"), (1, 3, "PLAIN", "View")], "workspace_id int, node_id int, name string, node_type string")
    assert rows(review.naming_inconsistency(nodes), "node_id") == [(2 - 1,)]


def test_error_classes(spark):
    texts = {
        "Syntax Error near unexpected end of input": ("sql_error", 2),
        "Object 'A.B' does not exist": ("reference_error", 1),
        "function f does not exist": ("missing_object", 1),
        "invalid data type": ("data_type_error", 1),
        "Warehouse 'W' is suspended": ("permission_error", 1),
        "???": ("unknown", 1),
        "": ("unknown", 0),
    }
    df = spark.createDataFrame([(t, "ERROR") for t in texts], "error string, status string")
    found = {r["error"]: (r["category"], len(r["fixes"])) for r in runs.classify_errors(df).collect()}
    assert found == texts


def test_run_results_shapes(spark):
    texts = [
        (1, '[{"nodeID":"a","runStatus":"done","error":{"detail":"d"}}, 5, "x"]'),
        (2, '{"results":[{"status":7,"nodeStatus":"failed","errorMessage":"","message":"m"}]}'),
        (3, '{"data":[],"results":[{"nodeID":"ignored"}]}'),
        (4, "not json"),
        (5, None),
    ]
    found = runs.normalise_run_results(spark.createDataFrame(texts, "run_id int, results string"))
    assert rows(found, "run_id", "node_id", "status", "error") == [(1, "a", "done", "d"), (2, "unknown", "failed", "m")]


def test_health_thresholds(spark):
    at = datetime(2024, 1, 10)
    envs = spark.createDataFrame([(1,), (2,), (3,)], "environment_id int")
    nodes = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "d")], "environment_id int, node_id string")
    shape = "run_id int, environment_id int, status string, start_time timestamp_ntz, end_time timestamp_ntz, job_id string, nodes_in_run int"
    rs = spark.createDataFrame(
        [
            (1, 1, "completed", datetime(2024, 1, 9), None, None, 2),
            (2, 1, "canceled", datetime(2024, 1, 9, 12), None, None, 2),
            (3, 1, "running", datetime(2024, 1, 9, 13), None, None, 2),
            (4, 2, "failed", datetime(2024, 1, 9, 5), None, None, 2),
            (5, 2, "failed", datetime(2024, 1, 9, 5), None, "job", 2),
        ],
        shape,
    )
    results = spark.createDataFrame([], "run_id int, node_id string")
    edges = spark.createDataFrame([("a", "b"), ("c", "d")], "src string, dst string")
    found = {r["environment_id"]: (r["score"], list(r["reasons"])) for r in runs.environment_health(envs, nodes, rs, results, edges, str(at)).collect()}
    assert found == {1: ("healthy", ["healthy"]), 2: ("critical", ["failed_runs", "failed_nodes"]), 3: ("warning", ["no_nodes"])}


# ---- schema comparison ----------------------------------------------------------------------------------


def versions(spark, before, after):
    shape = "node_id int, ordinal int, name string, data_type string, expression string, column_id string, description string"
    b = spark.createDataFrame([(1, i, n, t, e, f"id{i}", f"about {n}") for i, (n, t, e) in enumerate(before)], shape)
    a = spark.createDataFrame([(1, i, n, t, e, None, None) for i, (n, t, e) in enumerate(after)], shape)
    return b, a.drop("column_id", "description")


def test_column_changes(spark):
    b, a = versions(
        spark,
        [("ID", "INT", ""), ("A", "INT", "f( x )"), ("OLD", "INT", "g(y)"), ("TWIN1", "INT", "t"), ("TWIN2", "INT", "t"), ("DROP", "INT", "")],
        [("id", "int", "NULL"), ("A", "TEXT", "f(x)"), ("NEW", "TEXT", "g( y )"), ("TWIN3", "TEXT", "t"), ("TWIN4", "INT", "t"), ("ADDED", "DATE", "z")],
    )
    changes = diff.diff_columns(b, a)
    assert rows(changes, "before_key", "after_key", "change") == sorted(
        [
            ("ID", "ID", "unchanged"),
            ("A", "A", "type_changed"),
            ("OLD", "NEW", "renamed"),
            ("OLD", "NEW", "type_changed"),
            ("TWIN2", "TWIN4", "renamed"),
            ("TWIN1", None, "removed"),
            ("DROP", None, "removed"),
            (None, "TWIN3", "added"),
            (None, "ADDED", "added"),
        ],
        key=str,
    )
    merged = {r["name"]: r for r in diff.merge_schema_versions(b, a, changes).collect()}
    assert merged["NEW"]["column_id"] == "id2" and merged["NEW"]["description"] == "about OLD" and merged["NEW"]["data_type"] == "TEXT"
    assert merged["ADDED"]["column_id"].startswith("new-") and merged["ADDED"]["origin"] == "added"
    assert merged["id"]["column_id"] == "id0"
    assert [merged[n]["ordinal"] for n in ("id", "A", "NEW", "TWIN3", "TWIN4", "ADDED")] == list(range(6))


def test_definitions_without_expressions(spark):
    b, a = versions(spark, [("ADDRESS", "TEXT", "x"), ("C", "INT", "y")], [("STREET", "text", None), ("C", "", None)])
    assert rows(diff.diff_columns(b, a), "before_key", "after_key", "change") == [("ADDRESS", "STREET", "renamed"), ("C", "C", "unchanged")]


def test_lost_rename_source_fails(spark):
    b, a = versions(spark, [("A", "INT", "x")], [("B", "INT", "x")])
    changes = diff.diff_columns(b, a)
    with pytest.raises(Exception, match="no row in the old version"):
        diff.merge_schema_versions(b.filter("name <> 'A'"), a, changes).collect()


def test_sources_with_cosmetic_edits(spark):
    before = "FROM {{ ref('L', 'T') }} \"T\" JOIN {{ ref('L', 'U') }} \"U\" ON \"T\".\"ID\" = \"U\".\"ID\""
    cases = {
        1: ('select 1 from "DB"."L"."T" "T" join "L"."U" "U"\n  on "T"."ID"="U"."ID" -- note\n', "identical"),
        2: ('select 1 from "DB"."L"."T" "T" join "L"."U" "U" on "T"."id" = "U"."ID"', "where_or_join_edit"),
        3: ('select 1 from "DB"."L"."T" "T"', "removed_source"),
        4: ('select 1 from "DB"."L"."T" "T" join "L"."V" "V" on 1 = 1', "new_source"),
        5: ("with x as (select 1) select * from x", "unsupported"),
        6: ("create table t (a int)", "identical"),
    }
    corpus = spark.createDataFrame([(k, before, sql) for k, (sql, _) in cases.items()], "node_id int, before_sql string, after_sql string")
    assert {r["node_id"]: r["verdict"] for r in diff.diff_sources(corpus).collect()} == {k: v for k, (_, v) in cases.items()}


def test_order_and_limit_clauses(spark):
    sql = "SELECT x FROM (SELECT * FROM t ORDER BY q LIMIT 3) ORDER BY \"T\".\"My.Col\" DESC NULLS LAST, b, lower(c) desc LIMIT 5 ;"
    assert [tuple(i) for i in one(spark, diff.order_items(F.lit(sql)))] == [("MY.COL", "desc"), ("B", "asc")]
    for text, value in [(sql, 5), ("select 1 limit 5, 6", -1), ("select 1 LIMIT 4 OFFSET 2", -1), ("select 'limit 3'", None), ("select 1 -- limit 3", None)]:
        assert one(spark, diff.limit_value(F.lit(text))) == value


# ---- loads and steps --------------------------------------------------------------------------------------


def test_merges_with_null_keys_and_missing_columns(spark):
    target = spark.createDataFrame([(None, "a", 1), (1, "b", 2), (2, "c", 3)], "k int, v string, extra int")
    source = spark.createDataFrame([(None, "A"), (2, None), (9, "n")], "k int, v string")
    assert rows(load.dimension_scd1(target, source, ["k"])) == sorted([(None, "A", 1), (1, "b", 2), (2, None, 3), (9, "n", None)], key=str)


def test_scd2_is_idempotent_and_can_close_missing(spark):
    none = "cast(null as timestamp_ntz)"
    target = spark.sql(f"SELECT k, v, TIMESTAMP_NTZ '2020-01-01' AS valid_from, {none} AS valid_to, true AS is_current FROM VALUES (1, 'a'), (2, cast(null as string)), (3, 'c') AS t(k, v)")
    source = spark.createDataFrame([(1, "x"), (2, None), (4, "n")], "k int, v string")
    at = F.expr("TIMESTAMP_NTZ '2024-01-01'")
    once = load.dimension_scd2(target, source, ["k"], ["v"], at)
    assert rows(once, "k", "v", "is_current") == [(1, "a", False), (1, "x", True), (2, None, True), (3, "c", True), (4, "n", True)]
    assert rows(load.dimension_scd2(once, source, ["k"], ["v"], at)) == rows(once)
    closed = load.dimension_scd2(target, source, ["k"], ["v"], at, close_missing=True)
    assert rows(closed.filter("k = 3"), "is_current") == [(False,)]


def test_history_with_nulls(spark):
    log = spark.createDataFrame([(1, None, 1, 1), (1, None, 2, 2), (1, "a", 3, 3), (1, "a", 4, 4), (1, None, 5, 5)], "k int, v string, t int, i int")
    found = load.scd2_from_history(log, ["k"], ["v"], "t", "i")
    assert rows(found, "valid_from", "valid_to", "v", "is_current") == [(1, 3, None, False), (3, 5, "a", False), (5, None, None, True)]


def test_incremental_starts_from_the_default(spark):
    source = spark.createDataFrame([(1, datetime(2020, 1, 1)), (2, datetime(1800, 1, 1))], "k int, t timestamp_ntz")
    assert rows(load.incremental_load(source, source.limit(0), "t"), "k") == [(1,)]


def test_patterns(spark):
    seq = "v c c e v c e c v".split()
    df = spark.createDataFrame([(1, i, i, s) for i, s in enumerate(seq, 1)], "k int, t int, i int, s string")
    assert rows(load.sequence_match(df, ["k"], "t", "i", "s", ["v", "c", "e"]), "first_row") == [(5,)]
    assert rows(load.sequence_match(df, ["k"], "t", "i", "s", ["v", "c+", "e"]), "first_row", "last_row") == [(1, 4), (5, 7)]
    assert rows(load.sequence_match(df, ["k"], "t", "i", "s", ["c+", "e"]), "first_row", "last_row") == [(2, 4), (6, 7)]
    assert rows(load.sequence_match(df, ["k"], "t", "i", "s", ["c", "c"]), "first_row") == [(2,)]
    with pytest.raises(ValueError):
        load.sequence_match(df, ["k"], "t", "i", "s", ["c+", "c"])


def test_unknown_outcomes_fail_checks(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    passed, failed = load.split_tested(df, {"positive": "v > 0", "present": "v IS NOT NULL"})
    assert rows(passed) == [(1,)]
    assert sorted(map(str, (r["failed_checks"] for r in failed.collect()))) == ["['positive', 'present']", "['positive']"]


def test_vault_guards_and_grain(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int")
    with pytest.raises(ValueError):
        load.link(df, {"h": ["a"]}, F.lit(1), "s")
    assert rows(load.grain_violations(df, ["a", "b"])) == [(1, 2, 2)]


def test_a_link_is_grouped_by_what_is_hashed(spark):
    df = spark.createDataFrame([(1, " x", 5), (1, "x ", 3), (1, None, 9), (1, "", 8), (None, "x", 7), (None, "x", 6)], "a long, b string, t int")
    found = load.link(df, {"one": ["a"], "both": ["a", "b"]}, F.col("t"), "s")
    assert "hashpartitioning(__key0" in found._jdf.queryExecution().executedPlan().toString()
    was = df.withColumns({"one": load.hash_of(["a"]), "both": load.hash_of(["a", "b"])}).groupBy("one", "both").agg(F.min("t").alias("load_ts"))
    was = was.withColumns({"hash_key": load.hash_of(["one", "both"]), "record_source": F.lit("s")})
    assert found.columns == was.columns and rows(found) == rows(was) and found.count() == 3


def test_step_order_kinds_and_cycles(spark):
    steps = {"last": "SELECT * FROM {mid}", "mid": "SELECT a, count(*) n FROM {first} GROUP BY a", "first": "SELECT id % 2 AS a FROM {src}"}
    assert step_order(steps) == ["first", "mid", "last"]
    assert [step_kind(steps[s]) for s in ("first", "mid")] == ["staging", "aggregation"]
    assert rows(run_steps(spark, steps, {"src": spark.range(4)})["last"]) == [(0, 2), (1, 2)]
    with pytest.raises(Exception, match="cycle|CycleError"):
        step_order({"a": "SELECT * FROM b", "b": "SELECT * FROM a"})


def test_review_of_a_part(spark):
    nodes = spark.createDataFrame([(1, i, f"N{i}", "View") for i in range(4)], "workspace_id int, node_id int, name string, node_type string")
    edges = spark.createDataFrame([(0, 2), (1, 2)], "src int, dst int")
    columns = spark.createDataFrame([(2, 20, "A", None)], "node_id int, column_id int, name string, transform string")
    none = spark.createDataFrame([], "node_id int, join_condition string")
    refs = spark.createDataFrame([], "src_node int, src_column int, dst_node int, dst_column int")
    whole = review.review(nodes, edges, columns, none, refs)
    assert rows(whole, "category", "node_id") == [("missing_join_condition", 2), ("orphan_node", 3), ("type_mismatch", 2)]
    part = review.review(nodes, edges, columns, none, refs, scope=spark.createDataFrame([(3,), (0,)], "node_id int"))
    assert rows(part, "category", "node_id") == [("orphan_node", 0), ("orphan_node", 3)]
    assert rows(review.severity_counts(whole), "severity", "n") == [("critical", 1), ("warning", 1), ("warning", 1)]


def test_one_key_with_most_rows(spark):
    """A third of the rows, and more, share a key: results stay whole."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"), (F.col("id") % 7).alias("v"))
    assert windows.latest_per_key(df, ["k"], "t", "v").filter("k = 0").first()["t"] == 29_998
    changes = load.scd2_from_history(df, ["k"], ["v"], "t", "t", hot_rows=1000)
    plain = load.scd2_from_history(df, ["k"], ["v"], "t", "t")
    assert rows(changes.groupBy("k").count().filter("k = 0")) == rows(plain.groupBy("k").count().filter("k = 0"))
    assert changes.exceptAll(plain).count() == 0 and changes.count() == plain.count()
    details = df.withColumnRenamed("k", "run_id")
    from millrace.sources.catalog import run_details

    heads = spark.createDataFrame([(0, "hot"), (-1, "alone")], "run_id long, name string")
    found = run_details(heads, details)
    assert found.count() == 20_001 and found.filter("run_id = -1 AND t IS NULL").count() == 1


def test_lists_are_whole(spark):
    columns = spark.range(300).selectExpr("id AS node_id", "0 AS ordinal", "cast(null as string) AS description")
    assert profile.undocumented_columns(columns).count() == 300
    variants = spark.range(250).selectExpr("cast(id as string) AS variant_key", "'f' || (id % 30) AS family", "array('p') AS packages", "array('q') AS primitives", "'supported' AS support_status")
    assert search.search_variants(variants, package="P").count() == 250
    assert search.search_variants(variants, limit=3).count() == 3
    assert profile.top_families(variants).count() == 30 and profile.top_families(variants, 2).count() == 2
    with pytest.raises(ValueError):
        search.search_variants(variants, limit=0)


def test_hash_keys_do_not_collide(spark):
    df = spark.createDataFrame([("a||b", "c", 3), ("a", "b||c", 2), ("a ", "b||c", 1), (None, "x", 5), ("", "x", 4), ("1:x", "", 6), ("1", "x", 7)], "x string, y string, t int")
    found = load.hub(df, ["x", "y"], F.col("t"), "src").collect()
    assert len(found) == len({r["hash_key"] for r in found}) == 5
    assert sorted((r["y"], r["load_ts"]) for r in found) == [("", 6), ("b||c", 1), ("c", 3), ("x", 4), ("x", 7)]


DEEP = "f(g(h(i(j(k(1))))))"


@pytest.mark.parametrize(
    "before,after,verdict,added",
    [
        ("FROM {{ ref('A', 'B') }}", "SELECT 1 FROM (SELECT x FROM t GROUP BY x) q JOIN {{ ref('C', 'D') }} ON 1 = 1 JOIN {{ ref('A', 'B') }}", "new_source", ["C::D"]),
        ("SELECT 1 FROM {{ ref('A', 'B') }} WHERE s = 'in order' AND n = 1", "SELECT 1 FROM {{ ref('A', 'B') }} WHERE s = 'in order' AND n = 2", "where_or_join_edit", []),
        ("SELECT 1 FROM {{ ref('A', 'B') }} WHERE s = 'in order' AND n = 1", "SELECT 1 FROM {{ ref('A', 'B') }} WHERE s = 'in order' AND N = 1 ORDER BY 1", "identical", []),
        (f"SELECT 1 FROM {{{{ ref('A', 'B') }}}} WHERE {DEEP} = 1", f"SELECT 1 FROM {{{{ ref('A', 'B') }}}} WHERE {DEEP} = 2 GROUP BY 1", "where_or_join_edit", []),
        ("SELECT 1 FROM {{ ref('A', 'B') }} WHERE \"group, (by\" = 1", "SELECT 2 FROM {{ ref('A', 'B') }} WHERE \"group, (by\" = 1 -- LIMIT (", "identical", []),
        ("SELECT 1 FROM {{ ref('A', 'B') }} WHERE (a = 1", "SELECT 1 FROM {{ ref('A', 'B') }} WHERE a = 1", "unsupported", []),
        ("SELECT 1 FROM {{ ref('A', 'B') }} WHERE s = '--x' AND n = 1", "SELECT 1 FROM {{ ref('A', 'B') }} WHERE s = '--x' AND n = 2", "where_or_join_edit", []),
    ],
)
def test_sources_are_compared_at_any_depth(spark, before, after, verdict, added):
    row = diff.diff_sources(spark.createDataFrame([(1, before, after)], "node_id int, before_sql string, after_sql string")).first()
    assert (row["verdict"], row["added"]) == (verdict, added)


def test_profiles_at_any_depth(spark):
    inner = f"SELECT a FROM t WHERE {DEEP} = ')' GROUP BY a"
    texts = [(1, f"SELECT x FROM ({inner}) q"), (2, f"SELECT {DEEP} FROM t GROUP BY 1"), (3, f"WITH p AS ({inner}), q AS (SELECT * FROM p JOIN r ON {DEEP} = p.a) SELECT * FROM q")]
    df = spark.createDataFrame(texts, "node_id int, sql string")
    found = {r["node_id"]: (r["has_group_by"], r["kind"], r["ctes"]) for r in diff.sql_profile(df).collect()}
    assert found == {1: (False, "staging", 0), 2: (True, "aggregation", 0), 3: (False, "staging", 2)}
    ctes = [(r["cte"], r["kind"], r["depends_on"]) for r in diff.cte_profile(df).orderBy("position").collect()]
    assert ctes == [("P", "aggregation", []), ("Q", "multiSource", ["P"])]


def test_a_merge_needs_one_source_row_for_each_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(ValueError):
        load.merge_upsert(target, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"])
    found = load.merge_upsert(target, spark.createDataFrame([(1, "x"), (3, "z")], "k int, v string"), ["k"])
    assert sorted(map(tuple, found.collect())) == [(1, "x"), (2, "b"), (3, "z")]


@pytest.mark.parametrize("tie", ["int", "double", "string"])
def test_a_null_tie_comes_first_for_every_type(spark, tie):
    df = spark.createDataFrame([(1, 5, None), (1, 5, 2), (1, 4, 1)], "k int, ts int, t int").withColumn("t", F.col("t").cast(tie))
    assert windows.latest_per_key(df, ["k"], "ts", "t").first()["t"] is None


def test_ordered_lists_keep_repeats(spark):
    df = spark.createDataFrame([(1, 2, 1, "b"), (1, 1, 2, "a"), (1, 1, 1, "b"), (1, 3, 1, None), (2, 1, 1, None)], "k int, o int, t int, v string")
    found = {r["k"]: r["l"] for r in aggregate.ordered_list(df, ["k"], "v", "o", "t", "l").collect()}
    assert found == {1: ["b", "a", "b"], 2: []}


def test_fuzzy_matches_keep_all_candidates_unless_told(spark):
    nodes = spark.createDataFrame([(0, "ORDERS")] + [(k, f"ORDERS_{k}") for k in range(1, 9)], "node_id long, name string")
    queries = spark.createDataFrame([(1, "ORDERS")], "query_id long, name string")
    assert resolve.fuzzy_match_entities(queries, nodes)[1].count() == 9
    assert resolve.fuzzy_match_entities(queries, nodes, keep=5)[1].count() == 5


def test_fuzzy_matches_equal_trying_all_pairs(spark):
    pick = random.Random(5)
    words = ["ORDERS", "ORDER", "CUSTOMER", "STG", "DIM", "X", "ÄÖ", "S", "LINE ITEM", "😀"]
    made = lambda: "_".join(pick.choices(words, k=pick.randint(1, 4)))[pick.randint(0, 2) :]
    nodes = spark.createDataFrame([(k, made()) for k in range(120)] + [(500, ""), (501, None)], "node_id long, name string")
    queries = spark.createDataFrame([(k, made()) for k in range(80)] + [(500, ""), (501, None)], "query_id long, name string")
    q = queries.select("query_id", norm_identifier("name").alias("q")).where("q <> ''")
    n = nodes.select("node_id", norm_identifier("name").alias("c")).where("c <> ''")
    want = q.crossJoin(n).withColumn("score", resolve.entity_score(F.col("q"), F.col("c"))).where("score > 0").select("query_id", "node_id", "score")
    assert sorted(resolve.fuzzy_matches(queries, nodes).collect()) == sorted(want.collect())


def test_equal_texts_and_names_are_scored_once(spark):
    nodes = spark.range(1000).selectExpr("id AS node_id", "concat('ORDERS_', id) AS name")
    queries = spark.range(300).selectExpr("id AS query_id", "'ORDERS' AS name")
    q, n = resolve._normalised(queries, nodes)
    assert resolve._scored_texts(q, n, Scratch(spark, "test")).count() == 1000
    verdict, candidates = resolve.fuzzy_match_entities(queries.limit(2), nodes)
    assert {r["confidence"] for r in verdict.collect()} == {"unresolved"} and candidates.count() == 2000


def test_candidates_of_a_common_text_are_dealt_over_cells(spark, monkeypatch):
    monkeypatch.setattr(resolve, "CELL", 7)
    queries = spark.createDataFrame([(k, "large") for k in range(50)] + [(None, "large"), (0, "Large"), (0, "arge"), (1, "other")], "query_id int, name string")
    nodes = spark.createDataFrame([(k, f"SO_LARGE_{k}") for k in range(40)] + [(0, "TOO_LARGE"), (None, "LARGER"), (3, "SO_LARGE_3")], "node_id int, name string")
    found = resolve.fuzzy_match_entities(queries, nodes)[1]
    assert re.search(r"hashpartitioning\(q#\d+, row#\d+, column#\d+", found._jdf.queryExecution().executedPlan().toString())
    q, n = queries.selectExpr("query_id", "upper(name) AS q"), nodes.selectExpr("node_id", "name AS c")
    every = q.crossJoin(n).select("query_id", "q", "node_id", resolve.entity_score(F.col("q"), F.col("c")).alias("score")).where("score > 0").distinct()
    best = every.groupBy("q").agg(F.max("score").alias("best"))
    one = every.join(best, "q").where("score = best").groupBy("q", "best").agg((F.count_distinct("node_id") == 1).alias("one"))
    want = every.join(one, "q").where("one OR score = best").select("query_id", "node_id", "score").distinct()
    assert rows(found) == rows(want)
    assert rows(resolve.fuzzy_matches(queries, nodes)) == rows(every.select("query_id", "node_id", "score").distinct())


def test_an_index_cuts_every_text_once(spark, tmp_path, monkeypatch):
    cut = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def pieces(text):
        cut.add(1)
        return sorted({text[i : i + 3] for i in range(len(text) - 2)})

    cells = spark.createDataFrame([(f"text {i}", i) for i in range(30)] + [(None, 30), ("", 31), ("text 1", 32)], "text string, cell int")
    with monkeypatch.context() as m:
        m.setattr(textindex, "_pieces", pieces)
        textindex.build(cells, str(tmp_path / "i"))
    assert cut.value == 30
    found = textindex.search(spark, str(tmp_path / "i"), spark.createDataFrame([(1, "EXT 1"), (2, "9")], "query_id int, query string"))
    assert rows(found, "query_id", "cell") == sorted([(1, c) for c in (1, *range(10, 20), 32)] + [(2, c) for c in (9, 19, 29)], key=str)
