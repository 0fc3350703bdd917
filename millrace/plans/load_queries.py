"""Load patterns and streams over the supplied tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import load
from millrace.plans import catalogue as c
from millrace.plans.aggregate_queries import FINE, FINE_SQL
from millrace.plans.registry import query
from millrace.plans.steps import run_steps
from millrace.sources.scratch import Scratch
from millrace.streaming import streams

# A target and its change set: all customers, and what each one's latest order says about them, with
# every supplier as a new key.
TARGET_SQL = """WITH t AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer),
    o AS (SELECT o_custkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1),
    s AS (SELECT k, name, CASE WHEN o_orderstatus = 'F' THEN segment ELSE 'MOVED' END AS segment FROM t JOIN o ON o_custkey = k
      UNION ALL SELECT -1 - s_suppkey, s_name, 'SUPPLIER' FROM supplier)
"""


def merge_inputs(t):
    target = t.customer.selectExpr("c_custkey AS k", "c_name AS name", "c_mktsegment AS segment")
    last = load.latest_per_key(t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus"), ["o_custkey"], "o_orderdate", "o_orderkey")
    changed = target.join(last, F.col("k") == F.col("o_custkey")).selectExpr(
        "k", "name", "CASE WHEN o_orderstatus = 'F' THEN segment ELSE 'MOVED' END AS segment"
    )
    new = t.supplier.selectExpr("-1 - s_suppkey AS k", "s_name AS name", "'SUPPLIER' AS segment")
    return target, changed.unionByName(new)


UPSERT_SQL = TARGET_SQL + "SELECT * FROM s UNION ALL SELECT * FROM t WHERE k NOT IN (SELECT k FROM s)"


@query("l1_persistent_stage", UPSERT_SQL)
def l1_persistent_stage(t):
    target, source = merge_inputs(t)
    return load.persistent_stage(target, source, ["k"])


@query("l2_dimension_scd1", TARGET_SQL + "SELECT coalesce(t.k, s.k) AS k, coalesce(t.name, s.name) AS name, coalesce(s.segment, t.segment) AS segment FROM t FULL JOIN s ON t.k = s.k")
def l2_dimension_scd1(t):
    target, source = merge_inputs(t)
    return load.dimension_scd1(target, source, ["k"])


SCD2_SQL = TARGET_SQL + """, v AS (SELECT *, TIMESTAMP '2020-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM t
      UNION ALL SELECT k, name, 'OLD', TIMESTAMP '2019-01-01', TIMESTAMP '2020-01-01', FALSE FROM t),
    ch AS (SELECT s.k FROM s JOIN t ON s.k = t.k WHERE s.segment <> t.segment)
    SELECT k, name, segment, valid_from, CASE WHEN is_current AND k IN (SELECT k FROM ch) THEN TIMESTAMP '2024-01-01' ELSE valid_to END AS valid_to,
      is_current AND k NOT IN (SELECT k FROM ch) AS is_current FROM v
    UNION ALL SELECT k, name, segment, TIMESTAMP '2024-01-01', NULL, TRUE FROM s WHERE k IN (SELECT k FROM ch) OR k NOT IN (SELECT k FROM t)"""


def _scd2(t, merge):
    target, source = merge_inputs(t)
    none = F.lit(None).cast("timestamp_ntz")
    current = target.withColumns({"valid_from": F.expr("TIMESTAMP_NTZ '2020-01-01'"), "valid_to": none, "is_current": F.lit(True)})
    past = target.withColumns(
        {
            "segment": F.lit("OLD"),
            "valid_from": F.expr("TIMESTAMP_NTZ '2019-01-01'"),
            "valid_to": F.expr("TIMESTAMP_NTZ '2020-01-01'"),
            "is_current": F.lit(False),
        }
    )
    return merge(current.unionByName(past), source, F.expr("TIMESTAMP_NTZ '2024-01-01'"))


@query("l1_persistent_stage_history", SCD2_SQL)
def l1_persistent_stage_history(t):
    return _scd2(t, lambda v, s, at: load.persistent_stage(v, s, ["k"], 2, ["segment"], at))


@query("l3_dimension_scd2", SCD2_SQL)
def l3_dimension_scd2(t):
    return _scd2(t, lambda v, s, at: load.dimension_scd2(v, s, ["k"], ["segment"], at))


HISTORY_SQL = """WITH l AS (SELECT user_id, event_type, ts, event_id, lag(event_type) OVER w AS p FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT * FROM l WHERE p IS NULL OR p <> event_type)
    SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
      lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current FROM s"""


@query("l4_scd2_from_history", HISTORY_SQL)
def l4_scd2_from_history(t):
    return load.scd2_from_history(t.events, ["user_id"], ["event_type"], "ts", "event_id")


@query("l4_scd2_from_history_split_keys", HISTORY_SQL)
def l4_scd2_from_history_split_keys(t):
    return load.scd2_from_history(t.events, ["user_id"], ["event_type"], "ts", "event_id", hot_rows=0)


@query(
    "l4_fine_times_split_keys",
    f"""WITH f AS ({FINE_SQL}), v AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY fine, back) AS p FROM f)
    SELECT user_id, event_type, fine AS valid_from, lead(fine) OVER w AS valid_to, lead(fine) OVER w IS NULL AS is_current
    FROM v WHERE p IS NULL OR p <> event_type WINDOW w AS (PARTITION BY user_id ORDER BY fine, back)""",
)
def l4_fine_times_split_keys(t):
    return load.scd2_from_history(t.events.selectExpr(*FINE), ["user_id"], ["event_type"], "fine", "back", hot_rows=0)


@query(
    "l5_fact",
    """SELECT c_nationkey AS nationkey, o_orderpriority AS priority, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""",
)
def l5_fact(t):
    frames = {
        "orders": t.orders.selectExpr("o_custkey AS custkey", "o_orderpriority AS priority", "o_totalprice AS price"),
        "customer": t.customer.selectExpr("c_custkey AS custkey", "c_nationkey AS nationkey"),
    }
    return load.fact(
        frames,
        ["customer.nationkey", "orders.priority"],
        {"orders": "count(*)", "revenue": "cast(sum(cast(price as decimal(18,2))) as double)"},
    )


@query("l6_factless_fact", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def l6_factless_fact(t):
    return load.factless_fact(t.events.withColumn("day", F.to_date("ts")), ["user_id", "event_type", "day"])


@query(
    "l7_hub",
    """SELECT o_custkey AS custkey, sha256(length('' || o_custkey) || ':' || o_custkey) AS hash_key, min(o_orderdate) AS load_ts, 'orders' AS record_source FROM orders
       GROUP BY 1 HAVING o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def l7_hub(t):
    known = t.customer.filter("c_mktsegment = 'BUILDING'").selectExpr("c_custkey AS custkey", "c_custkey")
    existing = load.hub(known, ["custkey"], F.expr("TIMESTAMP_NTZ '1990-01-01'"), "crm")
    rows = t.orders.selectExpr("o_custkey AS custkey", "o_orderdate")
    return load.hub(rows, ["custkey"], F.col("o_orderdate"), "orders", existing)


#: Composite keys with separators inside, blanks around, nulls and empty texts.
ODD_KEYS = """CASE o_orderkey % 5 WHEN 0 THEN 'a||b' WHEN 1 THEN 'a' WHEN 2 THEN ' a ' WHEN 3 THEN '' END AS x,
    CASE o_orderkey % 5 WHEN 0 THEN 'c' WHEN 3 THEN '1:' WHEN 4 THEN '1:' ELSE 'b||c' END AS y"""


@query(
    "l7_hub_composite",
    f"""SELECT hash_key, min(load_ts) AS load_ts, 'orders' AS record_source FROM (SELECT
       sha256(length(coalesce(trim(x), '')) || ':' || coalesce(trim(x), '') || length(trim(y)) || ':' || trim(y)) AS hash_key, load_ts
       FROM (SELECT {ODD_KEYS}, o_orderdate AS load_ts FROM orders)) GROUP BY 1""",
)
def l7_hub_composite(t):
    rows = t.orders.selectExpr(*[k.strip() for k in ODD_KEYS.split(",\n")], "o_orderdate AS load_ts")
    return load.hub(rows, ["x", "y"], F.col("load_ts"), "orders").drop("x", "y")


SATELLITE_SQL = """SELECT sha256(length('' || user_id) || ':' || user_id) AS hash_key, user_id, event_type, ts, event_id, sha256(length('' || event_type) || ':' || event_type) AS hash_diff, 'events' AS record_source
    FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS NULL OR p <> event_type"""


@query("l8_satellite", SATELLITE_SQL)
def l8_satellite(t):
    return load.satellite(t.events, ["user_id"], ["event_type"], "ts", "event_id", "events")


@query("l8_satellite_in_two_loads", SATELLITE_SQL)
def l8_satellite_in_two_loads(t):
    """The same history, loaded up to a date and then from it."""
    cut = F.expr("TIMESTAMP_NTZ '2024-01-15'")
    args = (["user_id"], ["event_type"], "ts", "event_id", "events")
    first = load.satellite(t.events.filter(F.col("ts") < cut), *args)
    return first.unionByName(load.satellite(t.events.filter(F.col("ts") >= cut), *args, existing=first))


@query(
    "l9_link",
    """SELECT sha256(length('' || l_partkey) || ':' || l_partkey) AS part_hash, sha256(length('' || l_suppkey) || ':' || l_suppkey) AS supplier_hash, min(l_shipdate) AS load_ts,
       sha256('64:' || sha256(length('' || l_partkey) || ':' || l_partkey) || '64:' || sha256(length('' || l_suppkey) || ':' || l_suppkey)) AS hash_key, 'lineitem' AS record_source FROM lineitem GROUP BY l_partkey, l_suppkey""",
)
def l9_link(t):
    return load.link(t.lineitem, {"part_hash": ["l_partkey"], "supplier_hash": ["l_suppkey"]}, F.col("l_shipdate"), "lineitem")


@query("l10_incremental_load", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def l10_incremental_load(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return load.incremental_load(rows, rows.filter("o_orderdate < TIMESTAMP_NTZ '1999-01-01'"), "o_orderdate")


@query(
    "l11_merge_upsert",
    """WITH t AS (SELECT o_custkey AS k, max(o_orderdate) AS ts, arg_max(o_orderkey, o_orderdate::VARCHAR || printf('%09d', 999999999 - o_orderkey)) AS orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1),
    s AS (SELECT o_custkey AS k, o_orderdate AS ts, o_orderkey AS orderkey FROM orders WHERE o_orderdate > (SELECT max(ts) FROM t)
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1)
    SELECT * FROM s UNION ALL SELECT * FROM t WHERE k NOT IN (SELECT k FROM s)""",
)
def l11_merge_upsert(t):
    rows = t.orders.selectExpr("o_custkey AS k", "o_orderdate AS ts", "o_orderkey AS orderkey", "o_orderstatus")
    old = rows.filter("o_orderstatus = 'F' AND ts < TIMESTAMP_NTZ '2000-01-01'").drop("o_orderstatus")
    target = load.latest_per_key(old, ["k"], "ts", "orderkey")
    return load.merge_upsert(target, rows.drop("o_orderstatus"), ["k"], "ts", "orderkey")


@query("l12_view", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def l12_view(t):
    load.view(t.orders.filter("o_totalprice > 100000"), "millrace_big_orders")
    return t.spark.sql("SELECT o_orderstatus, count(*) AS n FROM millrace_big_orders GROUP BY 1")


@query("l12_materialise", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def l12_materialise(t):
    rows = t.orders.filter("o_totalprice > 100000").select("o_orderkey", "o_totalprice")
    return load.materialise(rows, Scratch(t.spark, "table").path)


@query(
    "l13_materialised_aggregate",
    "SELECT user_id, count(event_id) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1",
)
def l13_materialised_aggregate(t):
    measures = {
        "n": load.Measure("count", "event_id"),
        "total": load.Measure("sum", "amount"),
        "first_ts": load.Measure("min", "ts"),
        "last_ts": load.Measure("max", "ts"),
    }
    rows = t.events.withColumn("amount", F.col("value").cast("decimal(18,2)"))
    cut = F.expr("TIMESTAMP_NTZ '2024-01-20'")
    stored = load.materialised_aggregate(rows.filter(F.col("ts") < cut), ["user_id"], measures)
    fresh = load.refresh_aggregate(stored, rows.filter(F.col("ts") >= cut), ["user_id"], measures)
    return fresh.withColumn("total", F.col("total").cast("double"))


@query(
    "l13_signed_changes",
    """WITH r AS (SELECT user_id % 40 AS k, ts, CASE WHEN event_id % 7 = 0 THEN value + 5 ELSE value END AS value FROM events WHERE event_id % 5 <> 0 AND user_id % 40 <> 3)
    SELECT k, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, min(ts) AS first_ts, max(CAST(value AS DECIMAL(18,2))) AS most FROM r GROUP BY 1""",
)
def l13_signed_changes(t):
    """Rows that go, rows that change, rows that come and groups that end, without reading what stays."""
    measures = {"n": load.Measure("count", "ts"), "total": load.Measure("sum", "amount"), "first_ts": load.Measure("min", "ts"), "most": load.Measure("max", "amount")}
    rows = t.events.selectExpr("user_id % 40 AS k", "event_id", "ts", "cast(value as decimal(18,2)) AS amount")
    stays, changed = "event_id % 5 <> 0 AND k <> 3", F.when(F.expr("event_id % 7 = 0"), F.col("amount") + 5).otherwise(F.col("amount")).cast("decimal(18,2)")
    before = rows.where("event_id % 10 <> 1")
    after = rows.where(stays).withColumn("amount", changed)
    went = before.where(f"NOT ({stays}) OR event_id % 7 = 0").withColumn("sign", F.lit(-1))
    came = after.where("event_id % 10 = 1 OR event_id % 7 = 0").withColumn("sign", F.lit(1))
    state = load.apply_signed(load.signed_aggregate(before, ["k"], measures), went.unionByName(came), ["k"], measures, after)
    return state.select("k", "n", F.col("total").cast("double").alias("total"), "first_ts", F.col("most"))


@query(
    "l14_pivot",
    """SELECT o_custkey, nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS F, nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS O, nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS P FROM orders GROUP BY 1""",
)
def l14_pivot(t):
    return load.pivot(t.orders, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], F.count(F.lit(1)))


@query(
    "l14_unpivot",
    "SELECT c_custkey, 'c_name' AS name, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer",
)
def l14_unpivot(t):
    return load.unpivot(t.customer, ["c_custkey"], ["c_name", "c_mktsegment"])


@query(
    "l15_date_dimension",
    """SELECT CAST(d AS DATE) AS day, CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day_of_month,
       CAST(isodow(d) AS INT) AS iso_weekday, CAST(weekofyear(d) AS INT) AS iso_week, isodow(d) >= 6 AS is_weekend, last_day(d) = CAST(d AS DATE) AS is_month_end
       FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS d)""",
)
def l15_date_dimension(t):
    return load.date_dimension(t.orders, "o_orderdate")


SEQUENCE_SQL = """SELECT user_id, ts AS match_start, event_id AS first_row, t2 AS match_end FROM (SELECT *, lead(event_type) OVER w AS e1, lead(event_type, 2) OVER w AS e2, lead(ts, 2) OVER w AS t2 FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE event_type = 'view' AND e1 = 'click' AND e2 = 'purchase'"""


@query("l16_sequence_match", SEQUENCE_SQL)
def l16_sequence_match(t):
    return load.sequence_match(t.events, ["user_id"], "ts", "event_id", "event_type", ["view", "click", "purchase"])


@query("l16_sequence_match_split_keys", SEQUENCE_SQL)
def l16_sequence_match_split_keys(t):
    return load.sequence_match(t.events, ["user_id"], "ts", "event_id", "event_type", ["view", "click", "purchase"], hot_rows=0)


@query(
    "l16_fine_times_split_keys",
    f"""WITH n AS (SELECT user_id, fine, back, event_type, lead(event_type) OVER w AS b, lead(event_type, 2) OVER w AS c, lead(fine, 2) OVER w AS match_end FROM ({FINE_SQL})
    WINDOW w AS (PARTITION BY user_id ORDER BY fine, back))
    SELECT user_id, fine AS match_start, back AS first_row, match_end FROM n WHERE event_type = 'view' AND b = 'click' AND c = 'purchase'""",
)
def l16_fine_times_split_keys(t):
    return load.sequence_match(t.events.selectExpr(*FINE), ["user_id"], "fine", "back", "event_type", ["view", "click", "purchase"], hot_rows=0)


@query(
    "l8_fine_times_split_keys",
    f"""SELECT sha256(length('' || user_id) || ':' || user_id) AS hash_key, user_id, event_type, fine, back, sha256(length('' || event_type) || ':' || event_type) AS hash_diff, 'events' AS record_source
    FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY fine, back) AS p FROM ({FINE_SQL})) WHERE p IS NULL OR p <> event_type""",
)
def l8_fine_times_split_keys(t):
    return load.satellite(t.events.selectExpr(*FINE), ["user_id"], ["event_type"], "fine", "back", "events", hot_rows=0)


@query(
    "l16_sequence_match_runs",
    """WITH n AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS m FROM events),
    r AS (SELECT user_id, event_type, min(n) AS a, max(n) AS b FROM n GROUP BY user_id, event_type, n - m)
    SELECT x.user_id, x.b AS first_row, z.a AS last_row FROM r x JOIN r y ON y.user_id = x.user_id AND y.a = x.b + 1 JOIN r z ON z.user_id = y.user_id AND z.a = y.b + 1
    WHERE x.event_type = 'view' AND y.event_type = 'click' AND z.event_type = 'error'""",
)
def l16_sequence_match_runs(t):
    return load.sequence_match(t.events, ["user_id"], "ts", "event_id", "event_type", ["view", "click+", "error"])


PATTERN = "signup? (view | click){2,3} purchase* error"
PATTERN_SQL = """WITH n AS (SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, left(event_type, 1) AS a FROM events),
    s AS (SELECT user_id, string_agg(a, '' ORDER BY n) AS t FROM n GROUP BY 1),
    m AS (SELECT n.*, length(regexp_extract(substr(t, 1, n), 's?(?:v|c){2,3}p*e$')) AS size FROM n JOIN s USING (user_id))
    SELECT m.user_id, b.ts AS match_start, b.event_id AS first_row, m.ts AS match_end, m.event_id AS last_row FROM m JOIN n b ON b.user_id = m.user_id AND b.n = m.n - size + 1 WHERE size > 0"""


@query("l16_pattern", PATTERN_SQL)
def l16_pattern(t):
    return load.sequence_match(t.events, ["user_id"], "ts", "event_id", "event_type", PATTERN)


@query("l16_pattern_split_keys", PATTERN_SQL)
def l16_pattern_split_keys(t):
    """The same with every key cut into buckets, whose effects are composed."""
    return load.sequence_match(t.events, ["user_id"], "ts", "event_id", "event_type", PATTERN, hot_rows=0)


@query(
    "l17_recursive_expand",
    """WITH RECURSIVE e AS (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part WHERE p_partkey > 0),
    w(root, node, depth) AS (SELECT p_partkey, p_partkey, 0 FROM part UNION ALL SELECT root, src, depth + 1 FROM w JOIN e ON dst = node)
    SELECT root, node, depth, count(*) AS paths FROM w GROUP BY 1, 2, 3""",
)
def l17_recursive_expand(t):
    up = t.part.filter("p_partkey > 0").selectExpr("p_partkey AS src", "p_partkey div 2 AS dst")
    return load.recursive_expand(t.part.selectExpr("p_partkey AS root", "p_partkey AS node"), up)


@query(
    "l18_profile",
    """SELECT 'o_custkey' AS column_name, count(*) AS rows, count(*) - count(o_custkey) AS nulls, count(DISTINCT o_custkey) AS distinct_values, '' || min(o_custkey) AS least, '' || max(o_custkey) AS greatest, avg(o_custkey) AS mean FROM orders
       UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), count(DISTINCT o_orderstatus), min(o_orderstatus), max(o_orderstatus), NULL FROM orders""",
)
def l18_profile(t):
    return load.profile(t.orders, ["o_custkey", "o_orderstatus"], exact=True)


@query(
    "l18_profile_of_parts",
    """SELECT 'o_custkey' AS column_name, count(*) AS rows, count(*) - count(o_custkey) AS nulls, '' || min(o_custkey) AS least, '' || max(o_custkey) AS greatest, avg(o_custkey) AS mean, TRUE AS distinct_close, TRUE AS quantiles_close, CAST(NULL AS VARCHAR) AS most FROM orders
       UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), min(o_orderstatus), max(o_orderstatus), NULL, TRUE, NULL, (SELECT o_orderstatus FROM orders GROUP BY 1 ORDER BY count(*) DESC LIMIT 1) FROM orders""",
)
def l18_profile_of_parts(t):
    """Stored profiles of years, one of them made again, against exact counts and ranks."""
    folder = Scratch(t.spark, "profile").path
    rows = t.orders.withColumn("year", F.year("o_orderdate"))
    last = rows.agg(F.max("year")).first()[0]
    columns = ["o_custkey", "o_orderstatus"]
    for some in (F.col("year") < last, F.col("year") == last):
        load.profile_parts(rows.where(some), "year", columns).write.mode("append").parquet(folder)
    found = load.profile_of_parts(t.spark.read.parquet(folder), columns)
    cuts = found.where("quantiles is not null").select("quantiles").first()[0]  # three numbers
    near = [F.abs(F.count_if(F.col("o_custkey") <= cut) / F.count("*") - (k + 1) / 4) <= 0.03 for k, cut in enumerate(cuts)]
    near = rows.agg(near[0] & near[1] & near[2]).first()[0]  # one flag; joined by its literal name, it would leave no key to join by
    exact = [rows.select(c).distinct().agg(F.lit(c).alias("column_name"), F.count(c).alias("n")) for c in columns]
    out = found.join(exact[0].unionByName(exact[1]), "column_name")
    close = F.abs(F.col("distinct_values") - F.col("n")) <= 0.05 * F.col("n")
    most = F.when(F.col("column_name") == "o_orderstatus", F.get("frequent", F.lit(0))["value"])
    return out.select("column_name", "rows", "nulls", "least", "greatest", "mean", close.alias("distinct_close"), F.when(F.col("column_name") == "o_custkey", F.lit(near)).cast("boolean").alias("quantiles_close"), most.alias("most"))


CHECKS = {"positive": "value > 1", "known": "event_type IN ('view', 'click', 'purchase', 'signup')", "early": "ts < TIMESTAMP_NTZ '2024-01-25'"}


@query(
    "l19_passed_rows",
    "SELECT event_id, value FROM events WHERE value > 1 AND event_type IN ('view', 'click', 'purchase', 'signup') AND ts < TIMESTAMP '2024-01-25'",
)
def l19_passed_rows(t):
    return load.split_tested(t.events, CHECKS)[0].select("event_id", "value")


@query(
    "l19_failed_rows",
    """SELECT event_id, concat_ws(',', CASE WHEN NOT coalesce(value > 1, FALSE) THEN 'positive' END, CASE WHEN event_type NOT IN ('view', 'click', 'purchase', 'signup') THEN 'known' END,
       CASE WHEN NOT ts < TIMESTAMP '2024-01-25' THEN 'early' END) AS failed FROM events
       WHERE NOT (coalesce(value > 1, FALSE) AND event_type IN ('view', 'click', 'purchase', 'signup') AND ts < TIMESTAMP '2024-01-25')""",
)
def l19_failed_rows(t):
    return load.split_tested(t.events, CHECKS)[1].select("event_id", F.array_join("failed_checks", ",").alias("failed"))


@query(
    "l20_steps_from_ctes",
    """WITH stg AS (SELECT o_custkey AS custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders WHERE o_orderstatus <> 'P'),
    enriched AS (SELECT stg.*, c_nationkey AS nationkey FROM stg JOIN customer ON custkey = c_custkey),
    totals AS (SELECT nationkey, count(*) AS n, CAST(sum(price) AS DOUBLE) AS revenue FROM enriched GROUP BY 1)
    SELECT n_name, n, revenue FROM totals JOIN nation ON nationkey = n_nationkey""",
)
def l20_steps_from_ctes(t):
    steps = {
        "final": "SELECT n_name, n, revenue FROM {totals} t JOIN {nation} ON nationkey = n_nationkey",
        "totals": "SELECT nationkey, count(*) AS n, CAST(sum(price) AS DOUBLE) AS revenue FROM {enriched} e GROUP BY nationkey",
        "enriched": "SELECT s.*, c_nationkey AS nationkey FROM {stg} s JOIN {customer} ON custkey = c_custkey",
        "stg": "SELECT o_custkey AS custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM {orders} WHERE o_orderstatus <> 'P'",
    }
    sources = {"orders": t.orders, "customer": t.customer, "nation": t.nation}
    return run_steps(t.spark, steps, sources, store=["enriched"])["final"]


# ---- streams --------------------------------------------------------------------------------------


def event_stream(t):
    return streams.file_stream(t.spark, t.folder, t.events.schema, "events.parquet")


@query("x1_stream_incremental", "SELECT event_id, user_id, event_type, value FROM events")
def x1_stream_incremental(t):
    folder = Scratch(t.spark, "stream").path
    rows = event_stream(t).select("event_id", "user_id", "event_type", "value")
    for _ in range(2):  # the second run finds nothing new
        streams.stream_incremental(rows, f"{folder}/sink", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.schema(rows.schema).parquet(f"{folder}/sink")


@query(
    "x2_deferred_merge",
    """WITH b AS (SELECT c_custkey AS user_id, 'none' AS event_type, TIMESTAMP '2020-01-01' AS ts, CAST(-1 AS BIGINT) AS event_id FROM customer),
    u AS (SELECT * FROM b UNION ALL SELECT user_id, event_type, ts, event_id FROM events)
    SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1""",
)
def x2_deferred_merge(t):
    folder = Scratch(t.spark, "merge").path
    rows = event_stream(t).select("user_id", "event_type", "ts", "event_id")
    streams.stream_deferred_merge(rows, folder, ["user_id"], "ts", "event_id", f"{folder}/checkpoint").awaitTermination()
    base = t.customer.selectExpr("c_custkey AS user_id", "'none' AS event_type", "TIMESTAMP_NTZ '2020-01-01' AS ts", "-1L AS event_id")
    return streams.read_merged(t.spark, folder, rows.schema, ["user_id"], "ts", "event_id", base)


@query(
    "x3_rolling_aggregate",
    """WITH e AS (SELECT *, date_trunc('hour', ts) AS h FROM events), w AS (SELECT h - INTERVAL 1 HOUR * i AS s, e.* FROM e, (SELECT unnest(range(0, 2)) AS i))
    SELECT s AS window_start, s + INTERVAL 2 HOUR AS window_end, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM w GROUP BY 1, 2, 3""",
)
def x3_rolling_aggregate(t):
    folder = Scratch(t.spark, "rolling").path
    aggs = {"n": "count(*)", "total": "cast(sum(cast(value as decimal(18,2))) as double)"}
    rolling = streams.rolling_aggregate(event_stream(t), "ts", ["event_type"], aggs, "2 hours", "1 hour")
    streams.stream_rolling_aggregate(rolling, f"{folder}/sink", f"{folder}/checkpoint", ["event_type"]).awaitTermination()
    return streams.read_rolling(t.spark, f"{folder}/sink", rolling.schema, ["event_type"])


@query(
    "x4_run_status",
    """WITH s AS (SELECT user_id AS run_id, ts, CASE event_type WHEN 'signup' THEN 'waitingToRun' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' END AS status FROM events WHERE event_type <> 'click'),
    l AS (SELECT run_id, min(ts) AS started, arg_max(status, ts) AS status FROM s GROUP BY 1)
    SELECT run_id, started, status, status IN ('completed', 'failed') AS terminal, status NOT IN ('completed', 'failed') AND started + INTERVAL 1800 SECOND < TIMESTAMP '2024-01-31' AS timed_out FROM l""",
)
def x4_run_status(t):
    folder = Scratch(t.spark, "status").path
    status = "CASE event_type WHEN 'signup' THEN 'waitingToRun' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'odd' END AS status"
    states = streams.run_states(event_stream(t).selectExpr("user_id AS run_id", "ts", status))
    streams.stream_run_status(states, f"{folder}/sink", f"{folder}/checkpoint").awaitTermination()
    found = streams.read_run_status(t.spark, f"{folder}/sink", states.schema)
    return streams.with_timeout(found, "2024-01-31 00:00:00").select("run_id", "started", "status", "terminal", "timed_out")


def batched_events(t, folder, batches, *columns):
    """The events in the order of their ids, as a stream of that many files, one to a batch."""
    last = t.events.agg(F.max("event_id")).first()[0] or 0
    number = F.floor(F.col("event_id") * batches / F.lit(last + 1)).cast("int").alias("batch")
    t.events.select(*columns, number).repartition("batch").write.partitionBy("batch").parquet(f"{folder}/in")
    return streams.file_stream(t.spark, f"{folder}/in/*", t.events.select(*columns).schema, files_per_batch=1)


@query(
    "x2_merge_of_many_batches",
    """SELECT user_id, event_type, ts, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1""",
)
def x2_merge_of_many_batches(t):
    """Twenty batches, merged into a few runs as they come."""
    folder = Scratch(t.spark, "merge").path
    rows = batched_events(t, folder, 20, "user_id", "event_type", "ts", "event_id")
    streams.stream_deferred_merge(rows, f"{folder}/target", ["user_id"], "ts", "event_id", f"{folder}/checkpoint").awaitTermination()
    return streams.read_merged(t.spark, f"{folder}/target", rows.schema, ["user_id"], "ts", "event_id")


@query(
    "x4_timed_out_runs",
    """WITH s AS (SELECT event_id // 3 AS run_id, ts, CASE event_type WHEN 'signup' THEN 'waitingToRun' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' END AS status FROM events WHERE event_type <> 'click'),
    l AS (SELECT run_id, min(ts) AS started, max(ts) AS updated, arg_max(status, struct_pack(a := ts, b := status)) AS status FROM s GROUP BY 1),
    w AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR AS mark FROM s)
    SELECT run_id, started, updated, status, status IN ('completed', 'failed') AS terminal, status NOT IN ('completed', 'failed') AND date_trunc('millisecond', started + INTERVAL 600 SECOND) < mark AS timed_out FROM l, w""",
)
def x4_timed_out_runs(t):
    """Timers end the runs that said nothing more: no moment is given from outside."""
    folder = Scratch(t.spark, "status").path
    status = "CASE event_type WHEN 'signup' THEN 'waitingToRun' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'odd' END AS status"
    states = streams.run_states(event_stream(t).selectExpr("event_id div 3 AS run_id", "ts", status), timeout_seconds=600)
    streams.stream_run_status(states, f"{folder}/sink", f"{folder}/checkpoint").awaitTermination()
    return streams.read_run_status(t.spark, f"{folder}/sink", states.schema)
