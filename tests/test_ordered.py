"""Both ways of every ordered helper must agree with a plain window."""

import random

import pytest
from pyspark.sql import Window, functions as F

from millrace.functions import ordered


@pytest.fixture(scope="module")
def rows(spark):
    # Key 1 holds most of the rows and order value 7 a third of them.
    return spark.range(3000).select(
        F.when(F.col("id") % 5 == 0, F.col("id") % 3).otherwise(1).alias("k"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("o"),
        F.col("id").alias("t"),
        (F.col("id") % 11).alias("v"),
    )


def same(left, right):
    assert sorted(map(tuple, left.select(right.columns).collect()), key=str) == sorted(
        map(tuple, right.collect()), key=str
    )


@pytest.mark.parametrize("hot_rows", [0, 10**9])
@pytest.mark.parametrize("descending", [False, True])
def test_numbered_and_totals(rows, hot_rows, descending):
    order = [F.desc("o"), F.desc("t")] if descending else ["o", "t"]
    w = Window.partitionBy("k").orderBy(*order)
    same(ordered.numbered(rows, ["k"], "o", "t", "n", descending, hot_rows), rows.withColumn("n", F.row_number().over(w).cast("long")))
    same(
        ordered.running_total(rows, ["k"], "o", "t", F.col("v"), "s", descending, hot_rows),
        rows.withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))),
    )


@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_rank(rows, hot_rows):
    w = Window.partitionBy("k").orderBy("o")
    expected = rows.withColumn("rank", F.rank().over(w).cast("long")).withColumn("dense_rank", F.dense_rank().over(w).cast("long"))
    same(ordered.ranked(rows, ["k"], "o", hot_rows=hot_rows), expected)


@pytest.mark.parametrize("hot_rows", [0, 10**9])
@pytest.mark.parametrize("step", [-1, 1])
def test_neighbour(rows, hot_rows, step):
    w = Window.partitionBy("k").orderBy("o", "t")
    fn = F.lag if step < 0 else F.lead
    expected = rows.withColumn("near", fn("v").over(w)).withColumn("has", fn(F.lit(True)).over(w).isNotNull())
    same(ordered.neighbour(rows, ["k"], "o", "t", {"v": "near"}, step, "has", hot_rows), expected)


def test_top_per_key(rows):
    w = Window.partitionBy("k").orderBy("o", "t")
    expected = rows.withColumn("n", F.row_number().over(w).cast("long")).filter("n <= 9")
    same(ordered.top_per_key(rows, ["k"], [F.asc("o"), F.asc("t")], 9, "n"), expected)


@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_types_that_cannot_be_ordered_are_refused_in_both_ways(rows, hot_rows):
    with pytest.raises(TypeError):
        ordered.numbered(rows.withColumn("o", F.array("o")), ["k"], "o", "t", hot_rows=hot_rows)


ORDERS = {
    "microseconds in one second": "timestamp_micros(1700000000000000 + pmod(id * 7919, 3000))",
    "local times": "cast(timestamp_micros(1700000000000000 + pmod(id * 7919, 3000)) as timestamp_ntz)",
    "integers above 2^53": "9007199254740992L + pmod(id * 7919, 3000)",
    "wide decimals": "cast('12345678901234567890.' || lpad(cast(pmod(id * 7919, 3000) as string), 6, '0') as decimal(30, 6))",
    "text": "'x' || cast(pmod(id * 7919, 3000) as string)",
    "dates with nulls": "if(id % 7 = 0, null, date_add(date'2024-01-01', cast(pmod(id * 7919, 40) as int)))",
}


@pytest.mark.parametrize("kind", ORDERS)
@pytest.mark.parametrize("descending", [False, True])
def test_exact_for_every_type_with_reversed_ties(spark, kind, descending):
    df = spark.range(3000).selectExpr("id % 2 AS k", f"{ORDERS[kind]} AS o", "-id AS t", "id % 11 AS v")
    order = [F.desc("o"), F.desc("t")] if descending else ["o", "t"]
    w = Window.partitionBy("k").orderBy(*order)
    same(ordered.numbered(df, ["k"], "o", "t", "n", descending, hot_rows=0), df.withColumn("n", F.row_number().over(w).cast("long")))
    if not descending:
        same(ordered.neighbour(df, ["k"], "o", "t", {"v": "p"}, -1, hot_rows=0), df.withColumn("p", F.lag("v").over(w)))


def test_rows_that_agree_in_everything_are_still_cut(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BUCKET_ROWS", 50)
    df = spark.range(2000).selectExpr("1 AS k", "5 AS o", "5 AS t", "id AS v")
    split = ordered.bucketed(df, ["k"], ordered.hot_keys(df, ["k"], 0), "o", "t")
    assert split.groupBy("__bucket").count().agg(F.max("count")).first()[0] < 300
    found = ordered.numbered(df, ["k"], "o", "t", "n", hot_rows=0).select("n").collect()
    assert sorted(r["n"] for r in found) == list(range(1, 2001))
    near = ordered.neighbour(df, ["k"], "o", "t", {"v": "p"}, -1, hot_rows=0).select("v", "p").collect()
    assert len({r["p"] for r in near}) == 2000 and all(r["p"] != r["v"] for r in near)


def test_the_number_of_buckets_follows_the_rows(spark, monkeypatch):
    df = spark.range(4000).selectExpr("1 AS k", "id AS o", "id AS t")
    hot = ordered.hot_keys(df, ["k"], 0)
    counts = []
    for rows in (400, 40):
        monkeypatch.setattr(ordered, "BUCKET_ROWS", rows)
        counts.append(ordered.bucketed(df, ["k"], hot, "o", "t").select("__bucket").distinct().count())
    assert counts[0] <= 10 and counts[1] > 90


def test_only_hot_keys_are_split(spark, rows, monkeypatch):
    monkeypatch.setattr(ordered, "BUCKET_ROWS", 30)
    hot = ordered.hot_keys(rows, ["k"], 1000)
    assert [r["k"] for r in hot.keys.collect()] == [1]
    split = ordered.bucketed(rows, ["k"], hot, "o", "t")
    per_key = {r["k"]: r["n"] for r in split.groupBy("k").agg(F.countDistinct("__bucket").alias("n")).collect()}
    assert per_key[1] > 60 and per_key[0] == per_key[2] == 1
    largest = split.groupBy("k", "__bucket").count().agg(F.max("count")).first()[0]
    assert largest < 300
    w = Window.partitionBy("k").orderBy("o", "t")
    expected = rows.withColumn("n", F.row_number().over(w).cast("long"))
    same(ordered.numbered(rows, ["k"], "o", "t", "n", hot_rows=1000), expected)


def test_null_keys_and_orders(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, None, 2), (1, 3, 3), (1, 2, 4), (None, 5, 5)], "k int, o int, t int")
    w = Window.partitionBy("k").orderBy("o", "t")
    expected = df.withColumn("n", F.row_number().over(w).cast("long")).withColumn("p", F.lag("t").over(w))
    found = ordered.neighbour(ordered.numbered(df, ["k"], "o", "t", "n", hot_rows=0), ["k"], "o", "t", {"t": "p"}, hot_rows=0)
    same(found, expected)


def test_no_keys_at_all(rows):
    w = Window.orderBy("o", "t")
    same(ordered.numbered(rows, [], "o", "t", "n", hot_rows=0), rows.withColumn("n", F.row_number().over(w).cast("long")))


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_frames_equal_plain_windows_whatever_the_blocks(spark, block):
    pick = random.Random(block)
    data = [(pick.choice([None, "a", "b", "c"]), pick.randint(0, 30), k, pick.choice([None, *range(9)])) for k in range(120)]
    df = spark.createDataFrame([r for r in data if r[0] != "c"] + [("c", 1, 999, None)], "k string, o int, t int, v int")
    ends = [(None, 0), (None, None), (0, None), (2, 3), (0, 0), (5, 0), (None, 2), (4, None)]
    frames = {
        f"{f}_{i}": ordered.Frame(f, None if f == "count" and i == 1 else "v", ("k",), "o", "t", *e, descending=i % 2 == 1)
        for f in ("sum", "count", "min", "max", "avg", "first", "last") for i, e in enumerate(ends)
    }
    plain = ordered.framed(df, frames).collect()
    split = ordered.framed(df, frames, hot_rows=0, block_rows=block).collect()
    assert len(plain) == df.count()
    assert sorted(split, key=str) == sorted(plain, key=str)
    some = ordered.framed(df, {"n": ordered.Frame("count", None, ("k",), "o", "t")}, hot_rows=5, block_rows=block)
    assert sorted(some.select("k", "t", "n").collect(), key=str) == sorted([(r["k"], r["t"], r["n"]) for r in ordered.framed(df, {"n": ordered.Frame("count", None, ("k",), "o", "t")}).collect()], key=str)


def test_frames_ask_for_what_they_can_give(spark):
    with pytest.raises(ValueError):
        ordered.Frame("median", "v", ("k",), "o")
    with pytest.raises(ValueError):
        ordered.Frame("sum", "v", ("k",), "o", None, -1, 3)
