"""Plans of chosen queries: filters at the scan, targets left in place, aggregation before the shuffle.

That no registered query plans a product or a single-task window is checked in ``test_oracle``.
"""

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = QUERIES["p3_add_where"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "GreaterThan(o_totalprice,300000.0)" in text and "EqualTo(o_orderstatus,F)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_incremental_filter_is_pushed(spark):
    text = QUERIES["l10_incremental_load"](spark, FOLDER)._jdf.queryExecution().toString()
    assert text.count("GreaterThan(o_orderdate") >= 1


def test_small_change_sets_leave_the_target_unshuffled(spark):
    from millrace.operators import load

    path = f"{FOLDER}/orders.parquet"
    target = spark.read.parquet(path).selectExpr("o_orderkey AS k", "o_custkey AS v")
    source = spark.read.parquet(f"{FOLDER}/supplier.parquet").selectExpr("s_suppkey AS k", "s_suppkey AS v")
    text = plan(load.merge_upsert(target, source, ["k"]))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_latest_per_key_combines_before_the_shuffle(spark):
    text = plan(QUERIES["w5_latest_per_key"](spark, FOLDER))
    assert "partial_max_by" in text and "Window" not in text
