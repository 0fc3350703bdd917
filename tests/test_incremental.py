"""Signed changes of aggregates, stored profiles of parts, and the text index, each against doing it all again."""

import random

from pyspark.sql import functions as F

from millrace.operators import load, search, textindex

ROW = "k string, id int, v int, w double"


def aggregate_of(rows, key):
    own = [r for r in rows if r[0] == key]
    v, w = [r[2] for r in own if r[2] is not None], [r[3] for r in own if r[3] is not None]
    return (len(v), sum(w) if w else None, min(v, default=None), max(w, default=None))


def test_signed_changes_equal_the_aggregate_of_what_is_left(spark):
    pick = random.Random(8)
    measures = {"n": load.Measure("count", "v"), "total": load.Measure("sum", "w"), "least": load.Measure("min", "v"), "most": load.Measure("max", "w")}
    make = lambda i: (pick.choice(["a", "b", "c", None]), i, pick.choice([None, 1, 2, 3]), pick.choice([None, 0.5, 1.5, 8.0]))
    rows = [make(i) for i in range(40)] + [("gone", 900, 1, 1.0), ("nulls", 901, 5, 5.0)]
    state = load.signed_aggregate(spark.createDataFrame(rows, ROW), ["k"], measures)
    for step in range(4):
        dropped = pick.sample(rows, min(len(rows) - 1, 12)) + [r for r in rows if r[1] == 900 and step == 1]
        dropped = list(dict.fromkeys(dropped))
        new = [make(100 * (step + 1) + i) for i in range(9)] + ([("nulls", 902, None, None)] if step == 0 else [])
        if step == 0:
            dropped += [r for r in rows if r[1] == 901 and r not in dropped]
        flicker = ("a", 5000 + step, -9, -9.0 if step % 2 else 99.0)  # comes and goes in one step
        rows = [r for r in rows if r not in dropped] + new
        changes = [(*r, -1) for r in dropped] + [(*r, 1) for r in new] + [(*flicker, 1), (*flicker, -1)]
        now = spark.createDataFrame(rows, ROW)
        state = load.apply_signed(state, spark.createDataFrame(changes, ROW + ", sign int"), ["k"], measures, now)
        found = {r["k"]: (r["n"], r["total"], r["least"], r["most"]) for r in state.collect()}
        assert found == {k: aggregate_of(rows, k) for k in {r[0] for r in rows}}, step


def test_stored_profiles_of_parts_make_the_profile_of_all(spark):
    df = spark.range(5000).selectExpr("id % 7 AS part", "CASE WHEN id % 10 > 0 THEN id END AS n", "concat('v', id % 3) AS t", "cast(null as double) AS none")
    parts = load.profile_parts(df.where("part < 6"), "part", ["n", "t", "none"]).unionByName(load.profile_parts(df.where("part = 6"), "part", ["n", "t", "none"]))
    assert parts.count() == 7
    found = {r["column_name"]: r for r in load.profile_of_parts(parts, ["n", "t", "none"]).collect()}
    whole = {r["column_name"]: r for r in load.profile(df, ["n", "t", "none"], exact=True).collect()}
    for c, r in found.items():
        assert [r[x] for x in ("rows", "nulls", "least", "greatest", "mean")] == [whole[c][x] for x in ("rows", "nulls", "least", "greatest", "mean")]
        assert abs(r["distinct_values"] - whole[c]["distinct_values"]) <= 0.05 * whole[c]["distinct_values"]
    assert all(abs(q - x) <= 150 for q, x in zip(found["n"]["quantiles"], (1250, 2500, 3750), strict=True))
    assert {(f["value"], f["n"]) for f in found["t"]["frequent"]} == {("v0", 1667), ("v1", 1667), ("v2", 1666)}
    assert found["t"]["quantiles"] is None and found["none"]["mean"] is None


def test_index_finds_what_a_scan_finds(spark, tmp_path):
    pick = random.Random(6)
    word = lambda: "".join(pick.choices("abÄ %_", k=pick.randint(0, 9)))
    nodes = spark.createDataFrame([(k, word(), pick.choice(["Stage", "View"]), pick.choice([None, word() * 20]), word(), "") for k in range(60)], "node_id long, name string, node_type string, sql string, description string, config string")
    columns = spark.createDataFrame([(k % 70, k, word(), pick.choice(["VARCHAR", "NUMBER", None])) for k in range(150)], "node_id long, ordinal int, name string, data_type string")
    search.index_content(nodes, columns, str(tmp_path / "index"))
    queries = [(0, "a"), (1, "ab"), (2, "Ba"), (3, "äb"), (4, "varch"), (5, "%_"), (6, "zz"), (7, ""), (8, None), (9, "stage"), (10, "aba"), (11, "ab"), (12, "aaaaaaaaaaaa")]
    found = search.search_indexed(spark, str(tmp_path / "index"), spark.createDataFrame(queries, "query_id int, query string"))
    got = sorted(map(tuple, found.collect()), key=str)
    want = []
    for i, text in queries:
        if text:
            want += [(i, *r) for r in search.search_content(nodes, columns, text).select("node_id", "field", "column_name", "snippet").collect()]
    assert got == sorted(want, key=str)
    none = search.search_indexed(spark, str(tmp_path / "index"), spark.createDataFrame([], "query_id int, query string"))
    assert none.count() == 0


def test_a_search_makes_no_text_lower_again(spark, tmp_path):
    nodes = spark.createDataFrame([(1, "😀Äb\nc", "View", "x" * 70 + "😀äB" + "y" * 70, None, "")], "node_id long, name string, node_type string, sql string, description string, config string")
    columns = spark.createDataFrame([(1, 0, "😀", "INT")], "node_id long, ordinal int, name string, data_type string")
    search.index_content(nodes, columns, str(tmp_path / "index"))
    found = search.search_indexed(spark, str(tmp_path / "index"), spark.createDataFrame([(1, "😀äb"), (2, "b\nc"), (3, "😀")], "query_id int, query string"))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "lower(text" not in text and text.count("instr(") == 1
    assert sorted((r["query_id"], r["field"], r["snippet"]) for r in found.collect()) == [
        (1, "name", "😀Äb\nc"), (1, "sql", "…" + "x" * 60 + "😀äB" + "y" * 60 + "…"), (2, "name", "😀Äb\nc"), (3, "columnName", "😀"), (3, "name", "😀Äb\nc"), (3, "sql", "…" + "x" * 60 + "😀" + "äB" + "y" * 58 + "…"),
    ]
    pieces = spark.createDataFrame([("a😀b\nab\na",)], "t string").select(textindex._pieces(F.col("t"))).first()[0]
    assert pieces == ["a😀b", "😀b\n", "b\na", "\nab", "ab\n"]
