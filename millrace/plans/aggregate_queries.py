"""Aggregates, windows, sorts, set operations and scalar functions over the supplied tables."""

from pyspark.sql import functions as F

from millrace.functions import dialect, ordered
from millrace.operators import aggregate, profile, sets, sorting, windows
from millrace.plans import catalogue as c
from millrace.plans.catalogue import with_sql
from millrace.plans.join_queries import keyed
from millrace.plans.project_queries import LAYER_SQL, VARIANT_SQL
from millrace.plans.registry import query
from millrace.sources.scratch import Scratch

MONEY = "decimal(18,2)"


@query(
    "a1_join_to_aggregation",
    """SELECT c_custkey AS custkey, c_name AS name, count(DISTINCT o_orderkey) AS lifetime_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS lifetime_value,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS average_order,
       min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
       FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""",
)
def a1_join_to_aggregation(t):
    frames = {
        "customer": t.customer.selectExpr("c_custkey AS custkey", "c_name AS name"),
        "orders": t.orders.selectExpr("o_orderkey AS orderkey", "o_custkey AS custkey", "o_totalprice AS totalprice", "o_orderdate AS orderdate"),
    }
    total = f"cast(sum(cast(totalprice as {MONEY})) as double)"
    return aggregate.join_to_aggregation(
        frames,
        ["customer.custkey", "customer.name"],
        {
            "lifetime_orders": "count(DISTINCT orderkey)",
            "lifetime_value": total,
            "average_order": f"{total} / count(*)",
            "first_order": "min(orderdate)",
            "last_order": "max(orderdate)",
        },
    )


@query(
    "a2_analyze_group_by",
    with_sql("node_columns")
    + """, k AS (SELECT node_id, name, transform, CASE WHEN transform LIKE 'SUM(%' OR transform LIKE 'MAX(%' THEN 'aggregate' WHEN transform LIKE 'ROW_NUMBER%' THEN 'window' ELSE 'group' END AS kind FROM node_columns)
    SELECT *, bool_or(kind <> 'group') OVER w AS has_aggregates, bool_or(kind = 'window') OVER w AS has_window, NOT bool_or(kind = 'window') OVER w AS valid,
      bool_or(kind <> 'group') OVER w AND bool_or(kind = 'group') OVER w AS needs_group_by FROM k WINDOW w AS (PARTITION BY node_id)""",
)
def a2_analyze_group_by(t):
    return aggregate.analyze_group_by(c.node_columns(t))


@query(
    "a3_group_by_all",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
       FROM lineitem GROUP BY ALL""",
)
def a3_group_by_all(t):
    aggs = {"n": "count(*)", "price": f"cast(sum(cast(l_extendedprice as {MONEY})) as double)"}
    return aggregate.group_by_all(t.lineitem, aggs, ["l_returnflag", "l_linestatus"])


@query(
    "a4_global_aggregate",
    "SELECT count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, max(l_shipdate) AS last_ship FROM lineitem",
)
def a4_global_aggregate(t):
    return aggregate.global_aggregate(
        t.lineitem, {"n": "count(*)", "quantity": f"cast(sum(cast(l_quantity as {MONEY})) as double)", "last_ship": "max(l_shipdate)"}
    )


@query(
    "a5_basic_aggregates",
    """SELECT l_suppkey, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(*) AS average,
       min(l_extendedprice) AS least, max(l_extendedprice) AS most FROM lineitem GROUP BY 1""",
)
def a5_basic_aggregates(t):
    quantity = F.col("l_quantity").cast("long")
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(quantity).alias("total"),
        F.avg(quantity).alias("average"),
        F.min("l_extendedprice").alias("least"),
        F.max("l_extendedprice").alias("most"),
    )


@query(
    "a6_count_distinct",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1",
)
def a6_count_distinct(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers")
    )


@query(
    "a7_spread",
    """SELECT o_orderpriority, CAST(round(stddev_samp(o_totalprice), 2) AS DECIMAL(18,2)) AS deviation, round(var_samp(o_totalprice / 1000), 3) AS variance
       FROM orders GROUP BY 1""",
)
def a7_spread(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.round(F.stddev_samp("o_totalprice"), 2).cast(MONEY).alias("deviation"),
        F.round(F.var_samp(F.col("o_totalprice") / 1000), 3).alias("variance"),
    )


@query(
    "a8_listagg",
    "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1",
)
def a8_listagg(t):
    return aggregate.distinct_list(t.orders, ["o_custkey"], "o_orderpriority", "priorities", ", ")


@query(
    "a8_listagg_ordered",
    "SELECT o_custkey, string_agg(o_orderpriority, ', ' ORDER BY o_orderdate, o_orderkey) AS priorities FROM orders GROUP BY 1",
)
def a8_listagg_ordered(t):
    return aggregate.ordered_list(t.orders, ["o_custkey"], "o_orderpriority", "o_orderdate", "o_orderkey", "priorities", ", ")


@query("a9_array_agg_ordered", "SELECT user_id, list(event_type ORDER BY ts, event_id) AS kinds FROM events GROUP BY 1")
def a9_array_agg_ordered(t):
    return aggregate.ordered_list(t.events, ["user_id"], "event_type", "ts", "event_id", "kinds")


@query(
    "a9_array_agg",
    "SELECT user_id, list(DISTINCT event_type ORDER BY event_type) AS kinds FROM events GROUP BY 1",
)
def a9_array_agg(t):
    return aggregate.distinct_list(t.events, ["user_id"], "event_type", "kinds")


@query("a10_median", "SELECT user_id, median(value) AS middle FROM events GROUP BY 1")
def a10_median(t):
    return aggregate.exact_median(t.events, ["user_id"], "value", "middle")


@query(
    "a10_mode",
    """SELECT c_nationkey, min(c_mktsegment) AS commonest FROM (SELECT c_nationkey, c_mktsegment, rank() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC) AS r
       FROM customer GROUP BY 1, 2) WHERE r = 1 GROUP BY 1""",
)
def a10_mode(t):
    return aggregate.exact_mode(t.customer, ["c_nationkey"], "c_mktsegment", "commonest")


@query("a10_any_value", "SELECT n_regionkey, any_value(r_name) AS region FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def a10_any_value(t):
    both = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return both.groupBy("n_regionkey").agg(F.any_value("r_name").alias("region"))


@query(
    "a11_conditional",
    """SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS finished, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O'), 0) AS DOUBLE) AS open_value,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'P') AS DOUBLE) / count(*) FILTER (o_orderstatus = 'P') AS pending_average FROM orders GROUP BY 1""",
)
def a11_conditional(t):
    price, status = F.col("o_totalprice").cast(MONEY), F.col("o_orderstatus")
    pending = status == "P"
    return t.orders.groupBy("o_custkey").agg(
        F.count_if(status == "F").alias("finished"),
        F.coalesce(F.sum(F.when(status == "O", price)), F.lit(0)).cast("double").alias("open_value"),
        (F.sum(F.when(pending, price)).cast("double") / F.nullif(F.count_if(pending), F.lit(0))).alias("pending_average"),
    )


@query("a12_sketches")
def a12_sketches(t):
    return aggregate.sketch_counts(t.lineitem, ["l_returnflag"], "l_orderkey")


@query(
    "a12_sketches_are_close",
    """SELECT l_returnflag, TRUE AS approx_close, TRUE AS hll_close, percentile_disc(0.5) WITHIN GROUP (ORDER BY l_quantity) AS middle
       FROM lineitem GROUP BY 1""",
)
def a12_sketches_are_close(t):
    """Both sketches against the exact count: within 15 %, three times their stated error; and an approximate
    percentile whose accuracy covers all values of the column."""
    # apart: beside a distinct count, Spark would keep a percentile for every order
    exact = t.lineitem.select("l_returnflag", "l_orderkey").distinct().groupBy("l_returnflag").agg(F.count("l_orderkey").alias("n"))
    middle = t.lineitem.groupBy("l_returnflag").agg(F.percentile_approx("l_quantity", 0.5, 10_000).alias("middle"))
    both = aggregate.sketch_counts(t.lineitem, ["l_returnflag"], "l_orderkey").join(exact, "l_returnflag").join(middle, "l_returnflag")
    close = lambda c: F.abs(F.col(c) - F.col("n")) <= 0.15 * F.col("n")
    return both.select("l_returnflag", close("approx_count").alias("approx_close"), close("hll_count").alias("hll_close"), "middle")


@query("a13_select_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def a13_select_distinct(t):
    return aggregate.select_distinct(t.lineitem, ["l_partkey", "l_suppkey"])


@query(
    "a14_node_type_inventory",
    with_sql("nodes") + "SELECT workspace_id, node_type, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM nodes GROUP BY 1, 2",
)
def a14_node_type_inventory(t):
    return profile.node_type_inventory(c.nodes(t))


@query(
    "a15_package_usage",
    with_sql("nodes")
    + """, e AS (SELECT DISTINCT CASE p_size % 2 WHEN 0 THEN 'base-nodes' ELSE 'extra' END AS alias, CASE p_size % 4 WHEN 0 THEN 'Stage' WHEN 1 THEN 'Fact' WHEN 2 THEN 'Hub' ELSE 'View' END AS id FROM part),
    d AS (SELECT id, count(*) AS n FROM ((SELECT DISTINCT CASE p_size % 3 WHEN 0 THEN 'Stage' WHEN 1 THEN 'Fact' ELSE 'View' END AS id FROM part) UNION ALL SELECT DISTINCT 'Fact' FROM part) GROUP BY 1)
    SELECT e.alias, e.id, (SELECT count(*) FROM nodes WHERE node_type = e.alias || ':::' || e.id) AS used,
      CASE WHEN d.n IS NULL THEN 'missing' WHEN d.n = 1 THEN 'defined' ELSE 'ambiguous' END AS definition FROM e LEFT JOIN d ON d.id = e.id""",
)
def a15_package_usage(t):
    enabled = t.part.selectExpr(
        "CASE p_size % 2 WHEN 0 THEN 'base-nodes' ELSE 'extra' END AS alias",
        "CASE p_size % 4 WHEN 0 THEN 'Stage' WHEN 1 THEN 'Fact' WHEN 2 THEN 'Hub' ELSE 'View' END AS id",
    )
    once = t.part.selectExpr("CASE p_size % 3 WHEN 0 THEN 'Stage' WHEN 1 THEN 'Fact' ELSE 'View' END AS id").distinct()
    again = t.part.selectExpr("'Fact' AS id").distinct()
    return profile.package_usage(c.nodes(t), enabled, once.unionByName(again))


@query(
    "a16_detect_packages",
    with_sql("nodes")
    + """SELECT workspace_id, string_agg(DISTINCT split_part(node_type, ':::', 1), ',' ORDER BY split_part(node_type, ':::', 1)) FILTER (contains(node_type, ':::')) AS packages,
         string_agg(DISTINCT node_type, ',' ORDER BY node_type) FILTER (NOT contains(node_type, ':::')) AS built_in FROM nodes GROUP BY 1""",
)
def a16_detect_packages(t):
    found = profile.detect_packages(c.nodes(t))
    return found.select("workspace_id", F.array_join("packages", ",").alias("packages"), F.array_join("built_in_types", ",").alias("built_in"))


@query(
    "a17_layer_summary",
    with_sql("nodes")
    + f"""SELECT workspace_id, layer, count(*) AS n, string_agg(DISTINCT node_type, ',' ORDER BY node_type) AS node_types
          FROM (SELECT *, {LAYER_SQL} AS layer FROM nodes) GROUP BY 1, 2""",
)
def a17_layer_summary(t):
    return profile.layer_summary(c.nodes(t)).withColumn("node_types", F.array_join("node_types", ","))


@query(
    "a18_detect_methodology",
    with_sql("nodes")
    + """SELECT environment_id AS workspace_id, CASE WHEN bool_or(name LIKE 'HUB_%') AND bool_or(name LIKE 'SAT_%') THEN 'data-vault'
         WHEN bool_or(name LIKE 'DIM_%' OR node_type LIKE '%Dimension') AND bool_or(name LIKE 'FACT_%' OR node_type LIKE '%Fact') THEN 'kimball'
         WHEN bool_or(name LIKE 'STG_%') AND bool_or(name LIKE 'INT_%') THEN 'dbt-style' ELSE 'mixed' END AS methodology FROM nodes GROUP BY 1""",
)
def a18_detect_methodology(t):
    return profile.detect_methodology(c.nodes(t).withColumn("workspace_id", F.col("environment_id")))


@query(
    "a19_workspace_profile",
    with_sql("nodes")
    + f""", l AS (SELECT *, {LAYER_SQL} AS layer FROM nodes),
    r AS (SELECT DISTINCT layer, node_type, f, CASE WHEN node_type LIKE '%:::' || f THEN 0 WHEN node_type = f THEN 1 WHEN contains(node_type, ':::') THEN 2 ELSE 3 END AS k
          FROM l, (SELECT unnest(['Stage', 'View', 'Dimension', 'Fact']) AS f))
    SELECT CAST(0 AS INT) AS workspace_id, (SELECT count(*) FROM nodes) AS node_count, 'base-nodes' AS default_package, 'kimball' AS methodology,
      (SELECT arg_min(node_type, k || node_type) FROM r WHERE layer = 'staging' AND f = 'Stage') AS staging_type,
      (SELECT arg_min(node_type, k || node_type) FROM r WHERE layer = 'intermediate' AND f = 'View') AS transform_type,
      (SELECT arg_min(node_type, k || node_type) FROM r WHERE layer = 'mart' AND f = 'Dimension') AS dimension_type,
      (SELECT arg_min(node_type, k || node_type) FROM r WHERE layer = 'mart' AND f = 'Fact') AS fact_type""",
)
def a19_workspace_profile(t):
    return profile.workspace_profile(c.nodes(t))


@query(
    "a20_documentation_audit",
    with_sql("nodes", "node_columns")
    + """, n AS (SELECT count(*) AS tn, count(description) AS dn FROM nodes), k AS (SELECT count(*) AS tc, count(description) AS dc FROM node_columns)
    SELECT CAST(0 AS INT) AS workspace_id, tn AS total_nodes, dn AS documented_nodes, tc AS total_columns, dc AS documented_columns,
      round(dn / tn * 10000) / 100 AS node_percent, round(dc / tc * 10000) / 100 AS column_percent FROM n, k""",
)
def a20_documentation_audit(t):
    nodes = c.nodes(t).withColumn("meta_description", F.lit(None).cast("string"))
    return profile.documentation_audit(nodes, c.node_columns(t))


@query("a20_undocumented_nodes", with_sql("nodes") + "SELECT node_id, name FROM nodes WHERE coalesce(trim(description), '') = ''")
def a20_undocumented_nodes(t):
    nodes = c.nodes(t).withColumn("meta_description", F.lit(None).cast("string"))
    return profile.undocumented_nodes(nodes).select("node_id", "name")


@query(
    "a20_undocumented_columns",
    with_sql("node_columns") + "SELECT node_id, column_id, name FROM node_columns WHERE description IS NULL",
)
def a20_undocumented_columns(t):
    return profile.undocumented_columns(c.node_columns(t)).select("node_id", "column_id", "name")


@query("a21_variant_dedup", VARIANT_SQL + "SELECT variant_key, family, occurrences, packages, support_status FROM v")
def a21_variant_dedup(t):
    found = profile.variant_dedup(c.definitions(t))
    return found.select("variant_key", "family", "occurrences", F.array_join("packages", ",").alias("packages"), "support_status")


@query(
    "a22_variant_summary",
    VARIANT_SQL
    + """SELECT count(*) AS variants, count(DISTINCT family) AS families, CAST(sum(occurrences) AS BIGINT) AS definitions, count(*) FILTER (support_status = 'supported') AS supported,
         count(*) FILTER (support_status = 'partial') AS partial, count(*) FILTER (support_status = 'parse_error') AS parse_error FROM v""",
)
def a22_variant_summary(t):
    return profile.variant_summary(profile.variant_dedup(c.definitions(t)))


@query("a22_top_families", VARIANT_SQL + "SELECT family, count(*) AS n FROM v GROUP BY 1")
def a22_top_families(t):
    return profile.top_families(profile.variant_dedup(c.definitions(t)))


# ---- windows ---------------------------------------------------------------------------------


@query(
    "w1_qualify",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2""",
)
def w1_qualify(t):
    rows = t.orders.filter("o_orderstatus <> 'P'").select("o_custkey", "o_orderkey", "o_totalprice")
    return windows.qualify(rows, {"rn": "row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)"}, "rn <= 2")


@query(
    "w1_top_per_key",
    """SELECT event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 100""",
)
def w1_top_per_key(t):
    rows = t.events.select("event_type", "event_id", "value")
    return ordered.top_per_key(rows, ["event_type"], [F.desc("value"), F.asc("event_id")], 100)


RANK_SQL = """SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS row_number,
    rank() OVER (PARTITION BY event_type ORDER BY value) AS rank, dense_rank() OVER (PARTITION BY event_type ORDER BY value) AS dense_rank FROM events"""


def _ranked(t, **options):
    rows = t.events.select("event_type", "event_id", "ts", "value")
    rows = ordered.numbered(rows, ["event_type"], "ts", "event_id", "row_number", **options)
    return ordered.ranked(rows, ["event_type"], "value", **options).select("event_type", "event_id", "row_number", "rank", "dense_rank")


@query("w2_ranks", RANK_SQL)
def w2_ranks(t):
    return _ranked(t)


@query("w2_ranks_split_keys", RANK_SQL)
def w2_ranks_split_keys(t):
    """The same with every key treated as hot."""
    return _ranked(t, hot_rows=0)


TEXT_RANK_SQL = """SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY 'x' || event_id DESC, value DESC) AS row_number,
    rank() OVER (PARTITION BY event_type ORDER BY CAST(value AS DECIMAL(30, 10)) + 12345678901234567890) AS rank FROM events"""


@query("w2_typed_split_keys", TEXT_RANK_SQL)
def w2_typed_split_keys(t):
    """Hot keys ordered by text, downwards, and by decimals too wide for a double."""
    rows = t.events.selectExpr("event_type", "event_id", "value", "'x' || event_id AS o", "cast(value as decimal(30, 10)) + 12345678901234567890BD AS wide")
    rows = ordered.numbered(rows, ["event_type"], "o", "value", "row_number", descending=True, hot_rows=0)
    return ordered.ranked(rows, ["event_type"], "wide", hot_rows=0).select("event_type", "event_id", "row_number", "rank")


#: Times that differ by microseconds within one second of a day; ties run against the ids.
FINE_SQL = "SELECT *, date_trunc('day', ts) + to_microseconds(event_id // 2) AS fine, -event_id AS back FROM events"
FINE = ["*", "cast(timestampadd(MICROSECOND, event_id div 2, cast(date_trunc('day', ts) as timestamp_ntz)) as timestamp_ntz) AS fine", "-event_id AS back"]


@query(
    "w3_fine_times_split_keys",
    f"""SELECT event_type, event_id, lag(value) OVER (PARTITION BY event_type ORDER BY fine, back) AS before_value,
    lead(value) OVER (PARTITION BY event_type ORDER BY fine, back) AS after_value FROM ({FINE_SQL})""",
)
def w3_fine_times_split_keys(t):
    rows = t.events.selectExpr(*FINE).select("event_type", "event_id", "value", "fine", "back")
    rows = ordered.neighbour(rows, ["event_type"], "fine", "back", {"value": "before_value"}, -1, hot_rows=0)
    rows = ordered.neighbour(rows, ["event_type"], "fine", "back", {"value": "after_value"}, 1, hot_rows=0)
    return rows.select("event_type", "event_id", "before_value", "after_value")


@query(
    "w4_large_integers_split_keys",
    """SELECT event_type, event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY 9007199254740992 + event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM events""",
)
def w4_large_integers_split_keys(t):
    """Orders above 2^53 that differ by one."""
    rows = t.events.selectExpr("event_type", "event_id", "value", "9007199254740992L + event_id AS o")
    found = ordered.running_total(rows, ["event_type"], "o", "event_id", F.col("value").cast(MONEY), "running", hot_rows=0)
    return found.select("event_type", "event_id", F.col("running").cast("double").alias("running"))


NEAR_SQL = """SELECT event_type, event_id, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before_value,
    lead(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS after_value FROM events"""


def _near(t, **options):
    rows = t.events.select("event_type", "event_id", "ts", "value")
    rows = ordered.neighbour(rows, ["event_type"], "ts", "event_id", {"value": "before_value"}, -1, **options)
    rows = ordered.neighbour(rows, ["event_type"], "ts", "event_id", {"value": "after_value"}, 1, **options)
    return rows.select("event_type", "event_id", "before_value", "after_value")


@query("w3_lead_lag", NEAR_SQL)
def w3_lead_lag(t):
    return _near(t)


@query("w3_lead_lag_split_keys", NEAR_SQL)
def w3_lead_lag_split_keys(t):
    return _near(t, hot_rows=0)


@query(
    "w4_running_total",
    """SELECT user_id, event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM events""",
)
def w4_running_total(t):
    rows = t.events.select("user_id", "event_id", "ts", "value")
    found = ordered.running_total(rows, ["user_id"], "ts", "event_id", F.col("value").cast(MONEY), "running")
    return found.select("user_id", "event_id", F.col("running").cast("double").alias("running"))


FRAME_SQL = """SELECT event_type, event_id, CAST(sum(v) OVER (w ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS DOUBLE) AS near, min(value) OVER (w ROWS UNBOUNDED PRECEDING) AS least,
    max(value) OVER (w ROWS BETWEEN 2 PRECEDING AND UNBOUNDED FOLLOWING) AS most, first_value(user_id) OVER (w ROWS BETWEEN 200 PRECEDING AND CURRENT ROW) AS first_user,
    last_value(user_id) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 4 FOLLOWING) AS last_user, count(*) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS n,
    avg(event_id) OVER (w ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS mean FROM (SELECT *, CAST(value AS DECIMAL(18,2)) AS v FROM events)
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)"""


def _frames(t, **options):
    at = lambda function, column, before, after: ordered.Frame(function, column, ("event_type",), "ts", "event_id", before, after)
    frames = {
        "near": at("sum", "v", 3, 2), "least": at("min", "value", None, 0), "most": at("max", "value", 2, None), "first_user": at("first", "user_id", 200, 0),
        "last_user": at("last", "user_id", None, 4), "n": at("count", None, None, None), "mean": at("avg", "event_id", 7, 0),
    }
    rows = t.events.select("event_type", "event_id", "user_id", "ts", "value", F.col("value").cast(MONEY).alias("v"))
    return ordered.framed(rows, frames, **options).withColumn("near", F.col("near").cast("double")).drop("user_id", "ts", "value", "v")


@query("w4_frames", FRAME_SQL)
def w4_frames(t):
    return _frames(t)


@query("w4_frames_split_keys", FRAME_SQL)
def w4_frames_split_keys(t):
    """The same with every key cut into blocks of a thousand rows."""
    return _frames(t, hot_rows=0, block_rows=1000)


@query(
    "w1_qualify_split_keys",
    """SELECT event_id, event_type, value FROM events QUALIFY value > avg(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) / 100
       AND count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) > 10""",
)
def w1_qualify_split_keys(t):
    at = lambda function, column, before, after: ordered.Frame(function, column, ("event_type",), "ts", "event_id", before, after)
    window = {"mean": at("avg", "event_id", 5, 5), "n": at("count", None, None, 0)}
    kept = windows.qualify(t.events, window, "value > mean / 100 AND n > 10", hot_rows=0, block_rows=700)
    return kept.select("event_id", "event_type", "value")


@query(
    "w4_first_last_value",
    """SELECT DISTINCT user_id, first_value(event_type) OVER w AS first_value, last_value(event_type) OVER w AS last_value FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def w4_first_last_value(t):
    return windows.first_and_last(t.events, ["user_id"], "ts", "event_id", "event_type")


@query(
    "w5_latest_per_key",
    "SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1",
)
def w5_latest_per_key(t):
    return windows.latest_per_key(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "o_orderkey")


@query(
    "w6_first_per_key",
    "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1",
)
def w6_first_per_key(t):
    first = windows.first_per_key(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], "ts", "event_id")
    return first.select("user_id", "event_id", "event_type")


# ---- sort, limit, sets -------------------------------------------------------------------------


@query("t1_order_by", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def t1_order_by(t):
    return sorting.order_by(t.customer.select("c_custkey", "c_acctbal"), [("c_acctbal", "desc"), ("c_custkey", "asc")])


@query("t2_limit", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 40")
def t2_limit(t):
    return sorting.limit(t.orders.select("o_orderkey").orderBy("o_orderkey"), 100, 40)


@query("t3_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def t3_top_k(t):
    return sorting.top_k(t.orders.select("o_orderkey", "o_totalprice"), 50, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query(
    "u1_union_distinct",
    "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
)
def u1_union_distinct(t):
    return sets.union_distinct([t.customer.selectExpr("c_nationkey AS nationkey"), t.supplier.selectExpr("s_nationkey AS nationkey")])


@query(
    "u2_union_all",
    "SELECT c_nationkey AS nationkey, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_nationkey, s_name, NULL FROM supplier",
)
def u2_union_all(t):
    first = t.customer.selectExpr("c_nationkey AS nationkey", "c_name AS name", "c_mktsegment AS segment")
    return sets.union_all([first, t.supplier.selectExpr("s_name AS name", "s_nationkey AS nationkey")], allow_missing=True)


@query(
    "u3_insert_sequential",
    "SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def u3_insert_sequential(t):
    target = Scratch(t.spark, "insert").path
    parts = [t.customer.selectExpr("c_custkey AS key", "c_name AS name"), t.supplier.selectExpr("s_suppkey AS key", "s_name AS name")]
    sets.insert_sequential(parts, target)
    return t.spark.read.schema(parts[0].schema).parquet(target)


@query("u4_truncate_and_insert", "SELECT s_suppkey AS key, s_name AS name FROM supplier")
def u4_truncate_and_insert(t):
    target = Scratch(t.spark, "reload").path
    sets.truncate_and_insert(t.customer.selectExpr("c_custkey AS key", "c_name AS name"), target)
    rows = t.supplier.selectExpr("s_suppkey AS key", "s_name AS name")
    sets.truncate_and_insert(rows, target)
    return t.spark.read.schema(rows.schema).parquet(target)


@query("u5_intersect", "SELECT l_partkey AS k FROM lineitem INTERSECT SELECT l_orderkey FROM lineitem")
def u5_intersect(t):
    return sets.intersect(t.lineitem.selectExpr("l_partkey AS k"), t.lineitem.selectExpr("l_orderkey AS k"))


@query("u5_except_all", "SELECT l_partkey AS k FROM lineitem EXCEPT ALL SELECT l_suppkey FROM lineitem")
def u5_except_all(t):
    return sets.except_(t.lineitem.selectExpr("l_partkey AS k"), t.lineitem.selectExpr("l_suppkey AS k"), keep_duplicates=True)


# ---- scalar functions ----------------------------------------------------------------------------


@query(
    "f_cast_and_null",
    """SELECT event_id, CAST(trunc(value) AS BIGINT) AS whole, TRY_CAST(props AS INT) AS bad, coalesce(nullif(event_type, 'view'), 'seen') AS kind,
       ifnull(nullif(user_id, 8), -1) AS who FROM events""",
)
def f_cast_and_null(t):
    return t.events.selectExpr(
        "event_id",
        "CAST(value AS BIGINT) AS whole",
        "TRY_CAST(props AS INT) AS bad",
        "coalesce(nullif(event_type, 'view'), 'seen') AS kind",
        "nvl(nullif(user_id, 8), -1) AS who",
    )


@query(
    "f_conditional",
    """SELECT event_id, CASE WHEN value > 10 THEN 'big' ELSE 'small' END AS size, CASE event_type WHEN 'view' THEN 'V' WHEN 'click' THEN 'C' ELSE 'other' END AS code FROM events""",
)
def f_conditional(t):
    kind = F.col("event_type")
    code = dialect.decode(kind, F.lit("view"), F.lit("V"), F.lit("click"), F.lit("C"), F.lit("other"))
    return t.events.select("event_id", dialect.iff(F.col("value") > 10, F.lit("big"), F.lit("small")).alias("size"), code.alias("code"))


@query(
    "f_conversion",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day_text, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS day,
       CAST(o_orderpriority[1] AS DECIMAL(5,1)) AS level, CAST(o_orderkey AS DOUBLE) AS as_double FROM orders""",
)
def f_conversion(t):
    text = F.to_char("o_orderdate", F.lit("yyyy-MM-dd"))
    return t.orders.select(
        "o_orderkey",
        text.alias("day_text"),
        F.to_date(text, "yyyy-MM-dd").alias("day"),
        dialect.to_decimal(F.left("o_orderpriority", F.lit(1)), 5, 1).alias("level"),
        dialect.to_double(F.col("o_orderkey")).alias("as_double"),
    )


@query(
    "f_string",
    """SELECT p_partkey, replace(p_name, ' ', '-') AS a, upper(p_name) AS b, lower(p_brand) AS c, substring(p_name, 2, 3) AS d, left(p_type, 2) AS e, right(p_type, 2) AS f,
       concat(p_brand, '/', p_type) AS g, trim('  ' || p_type || ' ') AS h, string_split(p_name, ' ')[1] AS i, regexp_extract(p_brand, '[0-9]+') AS j,
       translate(p_name, 'ae', 'xy') AS k, reverse(p_type) AS l FROM part""",
)
def f_string(t):
    return t.part.select("*", dialect.regexp_substr(F.col("p_brand"), "[0-9]+").alias("j")).selectExpr(
        "p_partkey",
        "replace(p_name, ' ', '-') AS a",
        "upper(p_name) AS b",
        "lower(p_brand) AS c",
        "substr(p_name, 2, 3) AS d",
        "left(p_type, 2) AS e",
        "right(p_type, 2) AS f",
        "concat(p_brand, '/', p_type) AS g",
        "trim(concat('  ', p_type, ' ')) AS h",
        "split(p_name, ' ')[0] AS i",
        "j",
        "translate(p_name, 'ae', 'xy') AS k",
        "reverse(p_type) AS l",
    )


@query("f_hash", "SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha2 FROM documents")
def f_hash(t):
    return t.documents.select("doc_id", F.md5("text").alias("md5"), F.sha1("text").alias("sha1"), F.sha2("text", 256).alias("sha2"))


@query(
    "f_math",
    """SELECT c_custkey, abs(c_acctbal) AS a, CAST(ceil(c_acctbal) AS BIGINT) AS b, CAST(floor(c_acctbal) AS BIGINT) AS c, trunc(c_acctbal) AS d,
       CAST(round(CAST(c_acctbal AS DECIMAL(18,2)), 1) AS DOUBLE) AS e FROM customer""",
)
def f_math(t):
    balance = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey",
        F.abs(balance).alias("a"),
        F.ceil(balance).alias("b"),
        F.floor(balance).alias("c"),
        dialect.trunc_number(balance).alias("d"),
        F.round(balance.cast(MONEY), 1).cast("double").alias("e"),
    )


@query(
    "f_date",
    """SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2001-08-02') AS age, o_orderdate + INTERVAL 10 DAY AS later, date_trunc('month', o_orderdate) AS month_start,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS quarter_on, CAST(o_orderdate AS DATE) + 5 AS plus5, CAST(o_orderdate AS DATE) - 5 AS minus5,
       CAST(o_orderdate AS DATE) + CAST(8 - isodow(o_orderdate) AS INT) AS next_monday FROM orders""",
)
def f_date(t):
    return t.orders.selectExpr(
        "o_orderkey",
        "cast(datediff(DATE '2001-08-02', o_orderdate) as bigint) AS age",
        "o_orderdate + INTERVAL 10 DAY AS later",
        "cast(date_trunc('MONTH', o_orderdate) as timestamp_ntz) AS month_start",
        "add_months(to_date(o_orderdate), 3) AS quarter_on",
        "date_add(o_orderdate, 5) AS plus5",
        "date_sub(o_orderdate, 5) AS minus5",
        "next_day(o_orderdate, 'MON') AS next_monday",
    )


@query(
    "f_array",
    """WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part)
       SELECT p_partkey, CAST(i - 1 AS INT) AS place, words[i] AS word, len(words) AS words, list_contains(words, 'ring') AS has_ring, array_to_string(words[2:2], ' ') AS second
       FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM w)""",
)
def f_array(t):
    words = F.split("p_name", " ")
    return t.part.select(
        "p_partkey",
        F.posexplode(words).alias("place", "word"),
        F.size(words).cast("long").alias("words"),
        F.array_contains(words, "ring").alias("has_ring"),
        F.array_join(F.slice(words, 2, 1), " ").alias("second"),
    )


@query(
    "f_more_scalars",
    """SELECT event_id, TRY_CAST('' || event_id || '.5' AS DECIMAL(12, 1)) AS number, upper(event_type[1]) || lower(event_type[2:]) AS capital,
       ts + to_hours(CAST(event_id AS INTEGER) % 50) AS later,
       date_diff('month', date_trunc('month', ts), TIMESTAMP '2025-06-01') * 1.0 AS months, TRUE AS now_is_known FROM events""",
)
def f_more_scalars(t):
    """TO_NUMBER, INITCAP, DATEADD, MONTHS_BETWEEN, and the clock functions, of which only the kind is certain."""
    return t.events.select(
        "event_id",
        dialect.to_decimal(F.concat(F.col("event_id").cast("string"), F.lit(".5")), 12, 1).alias("number"),
        F.initcap("event_type").alias("capital"),
        dialect.dateadd("HOUR", F.col("event_id") % 50, F.col("ts")).alias("later"),
        F.months_between(F.lit("2025-06-01").cast("date"), F.trunc(F.col("ts").cast("date"), "month")).alias("months"),
        (F.to_date(F.current_timestamp()) == F.current_date()).alias("now_is_known"),
    )
