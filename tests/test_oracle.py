"""Every registered query against its SQL counterpart at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def assert_no_product_and_no_single_task_window(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert not any("Window" in x for x in lines[max(0, i - 3) : i])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql_with_a_sound_plan(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert_no_product_and_no_single_task_window(df)
    verdict = compare(df, con, ORACLES[name])
    assert verdict.startswith("ok"), verdict


def test_sketches_are_close(spark):
    exact = spark.read.parquet(f"{FOLDER}/lineitem.parquet").groupBy("l_returnflag").agg({"l_orderkey": "count"})
    distinct = {
        r[0]: r[1]
        for r in spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_returnflag", "l_orderkey").distinct().groupBy("l_returnflag").count().collect()
    }
    assert exact.count() == len(distinct)
    for row in QUERIES["a12_sketches"](spark, FOLDER).collect():
        for estimate in (row["approx_count"], row["hll_count"]):
            assert abs(estimate - distinct[row["l_returnflag"]]) <= 0.15 * distinct[row["l_returnflag"]]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["custkey", "name", "lifetime_orders", "lifetime_value", "average_order", "first_order", "last_order"]
    assert df.count() > 0
    assert df.schema["custkey"].metadata == {"isBusinessKey": True}
    assert df.schema["lifetime_value"].metadata == {"isChangeTracking": True}
