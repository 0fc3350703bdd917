"""Joins, name resolution and job selectors over the supplied tables."""

from pyspark.sql import functions as F

from millrace.functions import ordered
from millrace.functions.spread import spread
from millrace.operators import joins, resolve
from millrace.plans import catalogue as c
from millrace.plans.catalogue import with_sql
from millrace.plans.registry import query


def keyed(t):
    """Tables with shared key names, so that common columns can be found."""
    return {
        "customer": t.customer.selectExpr("c_custkey AS custkey", "c_name AS name", "c_nationkey AS nationkey"),
        "orders": t.orders.selectExpr("o_orderkey AS orderkey", "o_custkey AS custkey", "o_totalprice AS totalprice"),
        "lineitem": t.lineitem.selectExpr("l_orderkey AS orderkey", "l_suppkey AS suppkey", "l_quantity AS quantity"),
    }


@query(
    "j1_suggest_joins",
    with_sql("edges", "node_columns")
    + """, h AS (SELECT e.dst AS node_id, dense_rank() OVER (PARTITION BY e.dst ORDER BY e.src) AS pos, e.src AS pred_id, c.name AS key
                 FROM edges e JOIN node_columns c ON c.node_id = e.src),
    p AS (SELECT b.node_id, b.pos AS right_pos, min(a.pos) AS left_pos FROM h a JOIN h b ON a.node_id = b.node_id AND a.key = b.key AND a.pos < b.pos GROUP BY 1, 2)
    SELECT p.node_id, p.left_pos, p.right_pos, a.pred_id AS left_id, b.pred_id AS right_id, a.key AS key, a.key AS left_name, b.key AS right_name
    FROM p JOIN h a ON a.node_id = p.node_id AND a.pos = p.left_pos JOIN h b ON b.node_id = p.node_id AND b.pos = p.right_pos AND a.key = b.key""",
)
def j1_suggest_joins(t):
    edges = c.edges(t).selectExpr("dst AS node_id", "src AS pred_id")
    placed = ordered.numbered(edges, ["node_id"], "pred_id", None, "pos")
    cols = c.node_columns(t).selectExpr("node_id AS pred_id", "ordinal", "name")
    return joins.suggest_joins(placed.join(spread(cols), "pred_id"))


@query(
    "j2_join_on_common",
    """SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, o_orderkey AS orderkey, o_totalprice AS totalprice,
       l_suppkey AS suppkey, l_quantity AS quantity FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey""",
)
def j2_join_on_common(t):
    return joins.join_on_common(keyed(t))


@query(
    "j2_join_with_overrides",
    """SELECT s_suppkey AS id, s_name AS supplier_name, s_nationkey AS nation, n_nationkey AS nation_id, n_name AS nation_name
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def j2_join_with_overrides(t):
    frames = {
        "s": t.supplier.selectExpr("s_suppkey AS id", "s_name AS supplier_name", "s_nationkey AS nation"),
        "n": t.nation.selectExpr("n_nationkey AS nation_id", "n_name AS nation_name"),
    }
    return joins.join_on_common(frames, "left", {("s", "n"): [("nation", "nation_id")]})


@query(
    "j3_join_bare",
    """SELECT coalesce(c_custkey, o_custkey) AS custkey, c_name AS name, c_nationkey AS nationkey, o_orderkey AS orderkey, o_totalprice AS totalprice
       FROM customer FULL JOIN orders ON c_custkey = o_custkey""",
)
def j3_join_bare(t):
    frames = keyed(t)
    return joins.join_bare({"customer": frames["customer"], "orders": frames["orders"]}, "full")


JOIN_WORD = {"inner": "JOIN", "left": "LEFT JOIN", "right": "RIGHT JOIN", "full": "FULL JOIN"}
for _how, _word in JOIN_WORD.items():

    @query(
        f"j4_{_how}_join",
        f"""SELECT s_suppkey, s_name, p_partkey, p_brand FROM supplier {_word} part ON s_suppkey * 7 = p_partkey AND s_nationkey = p_size""",
    )
    def j4_join(t, how=_how):
        left = t.supplier.withColumn("k", F.col("s_suppkey") * 7)
        return joins.equi_join(left, t.part, [("k", "p_partkey"), ("s_nationkey", "p_size")], how).select(
            "s_suppkey", "s_name", "p_partkey", "p_brand"
        )


@query(
    "j5_using_join",
    "SELECT o_custkey AS custkey, o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def j5_using_join(t):
    left = t.orders.selectExpr("o_custkey AS custkey", "o_orderkey")
    return joins.join_using(left, t.customer.selectExpr("c_custkey AS custkey", "c_name"), ["custkey"])


@query(
    "j5_natural_join",
    "SELECT n_regionkey AS regionkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def j5_natural_join(t):
    return joins.natural_join(
        t.nation.selectExpr("n_regionkey AS regionkey", "n_name"), t.region.selectExpr("r_regionkey AS regionkey", "r_name")
    )


@query(
    "j5_comma_join",
    """SELECT c_custkey, n_name, r_name FROM customer, nation, region
       WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey AND c_acctbal > 5000""",
)
def j5_comma_join(t):
    frames = {"c": t.customer, "n": t.nation, "r": t.region}
    pairs = [("c.c_nationkey", "n.n_nationkey"), ("n.n_regionkey", "r.r_regionkey")]
    return joins.comma_join(frames, pairs, "c_acctbal > 5000").select("c_custkey", "n_name", "r_name")


@query(
    "j5_lateral_join",
    """SELECT c_custkey, n_orders, last_key FROM customer, LATERAL (SELECT count(*) AS n_orders, max(o_orderkey) AS last_key FROM orders WHERE o_custkey = c_custkey)""",
)
def j5_lateral_join(t):
    mine = t.orders.filter(F.col("o_custkey") == F.col("c_custkey").outer())
    summary = mine.select(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderkey").alias("last_key"))
    return joins.lateral_join(t.customer.select("c_custkey"), summary)


@query(
    "j6_theta_join",
    """SELECT o_orderkey, l_partkey, l_suppkey, l_shipdate FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       AND l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 60 DAY""",
)
def j6_theta_join(t):
    within = "l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 60 DAY"
    return joins.theta_join(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")], within).select(
        "o_orderkey", "l_partkey", "l_suppkey", "l_shipdate"
    )


@query(
    "j7_predecessor_coverage",
    with_sql("edges", "node_columns", "column_refs")
    + """, x AS (SELECT dst AS node_id, src AS pred_id FROM edges UNION SELECT p_partkey, p_partkey + 1 FROM part),
    u AS (SELECT DISTINCT dst_node, src_node FROM column_refs)
    SELECT node_id, pred_id, src_node IS NOT NULL AS referenced, bool_and(src_node IS NOT NULL) OVER (PARTITION BY node_id) AS all_represented
    FROM x LEFT JOIN u ON dst_node = node_id AND src_node = pred_id""",
)
def j7_predecessor_coverage(t):
    extra = t.part.selectExpr("p_partkey AS node_id", "p_partkey + 1 AS pred_id")
    expected = c.edges(t).selectExpr("dst AS node_id", "src AS pred_id").unionByName(extra)
    return joins.predecessor_coverage(c.column_refs(t), expected)


def wanted_refs(t):
    """References by node type name: many namesakes, told apart by brand."""
    return t.part.selectExpr(
        "p_partkey AS ref_id",
        "CASE WHEN p_partkey % 4 = 3 THEN 'nowhere' ELSE lower(concat(p_type, p_partkey div 4)) END AS node_name",
        "CASE WHEN p_partkey % 3 = 0 THEN array(lower(p_brand)) WHEN p_partkey % 3 = 1 THEN array('elsewhere') ELSE array() END AS locations",
        "p_partkey % 2 = 0 AS strict",
    )


def named_nodes(t):
    return t.part.selectExpr("p_partkey AS node_id", "concat(p_type, p_partkey div 4) AS name", "p_brand AS location", "p_type AS node_type")


@query(
    "j8_resolve_refs",
    """WITH n AS (SELECT p_partkey AS node_id, upper(p_type || (p_partkey // 4)) AS key, upper(p_brand) AS loc FROM part),
    r AS (SELECT p_partkey AS ref_id, CASE WHEN p_partkey % 4 = 3 THEN 'nowhere' ELSE lower(p_type || (p_partkey // 4)) END AS node_name,
      CASE WHEN p_partkey % 3 = 0 THEN upper(p_brand) WHEN p_partkey % 3 = 1 THEN 'ELSEWHERE' END AS hint, p_partkey % 2 = 0 AS strict FROM part),
    x AS (SELECT ref_id, node_name, hint, strict, count(node_id) AS n_name, min(node_id) AS any_id, count(node_id) FILTER (loc = hint) AS n_hint,
      min(node_id) FILTER (loc = hint) AS hint_id FROM r LEFT JOIN n ON key = upper(node_name) GROUP BY ALL),
    y AS (SELECT *, CASE WHEN n_hint = 1 THEN 'resolved' WHEN n_hint > 1 THEN 'ambiguous' WHEN n_name = 1 AND strict AND hint IS NOT NULL THEN 'wrong_location'
      WHEN n_name = 1 THEN 'resolved' WHEN n_name > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status FROM x)
    SELECT ref_id, node_name, status, CASE WHEN status = 'resolved' THEN CASE WHEN n_hint = 1 THEN hint_id ELSE any_id END END AS node_id, n_name AS candidates FROM y""",
)
def j8_resolve_refs(t):
    return resolve.resolve_refs(wanted_refs(t), named_nodes(t))


SCORE_SQL = """WITH q AS (SELECT s_suppkey AS query_id, CASE s_suppkey % 4 WHEN 0 THEN 'PROMO_' || (s_suppkey // 4) WHEN 1 THEN '' || (s_suppkey // 4 + 100)
        WHEN 2 THEN 'ECONOMY_' || (s_suppkey // 4) || 'S' ELSE 'Large' END AS name FROM supplier),
    n AS (SELECT p_partkey AS node_id, CASE p_size % 7 WHEN 0 THEN 'RAW_' WHEN 1 THEN 'STG_' WHEN 2 THEN 'INT_' WHEN 3 THEN 'DIM_' WHEN 4 THEN 'FACT_' WHEN 5 THEN 'HUB_' ELSE '' END
        || upper(p_type) || '_' || p_partkey AS c FROM part),
    s AS (SELECT query_id, node_id, c, upper(name) AS q, CASE WHEN upper(name) LIKE '%S' THEN substring(upper(name), 1, length(name) - 1) ELSE upper(name) || 'S' END AS pl,
        regexp_replace(c, '^(STG_|DIM_|FACT_|INT_|RAW_)', '') AS st FROM q, n),
    m AS (SELECT query_id, node_id, CASE WHEN q = c THEN 100 WHEN ends_with(c, '_' || q) THEN 90 WHEN starts_with(c, q || '_') THEN 80 WHEN contains(c, q) THEN 70
        WHEN st = q THEN 85 WHEN c = pl OR st = pl THEN 82 WHEN ends_with(c, '_' || pl) THEN 78 ELSE 0 END AS score FROM s),
    hit AS (SELECT * FROM m WHERE score > 0),
    top AS (SELECT query_id, max(score) AS best FROM hit GROUP BY 1),
    cnt AS (SELECT hit.query_id, best, count(*) AS n, min(node_id) AS node_id FROM hit JOIN top ON hit.query_id = top.query_id AND score = best GROUP BY 1, 2)
"""


def entity_queries(t):
    return t.supplier.selectExpr(
        "s_suppkey AS query_id",
        """CASE s_suppkey % 4 WHEN 0 THEN concat('PROMO_', s_suppkey div 4) WHEN 1 THEN string(s_suppkey div 4 + 100)
             WHEN 2 THEN concat('ECONOMY_', s_suppkey div 4, 'S') ELSE 'Large' END AS name""",
    )


@query(
    "j9_fuzzy_verdicts",
    SCORE_SQL
    + """SELECT q.query_id, q.name, CASE WHEN n = 1 AND best >= 85 THEN 'exact' WHEN n = 1 THEN 'fuzzy' ELSE 'unresolved' END AS confidence,
         CASE WHEN n = 1 THEN node_id END AS node_id, best AS score FROM q LEFT JOIN cnt ON q.query_id = cnt.query_id""",
)
def j9_fuzzy_verdicts(t):
    return resolve.fuzzy_match_entities(entity_queries(t), c.nodes(t))[0]


@query(
    "j9_fuzzy_candidates",
    SCORE_SQL
    + """SELECT hit.query_id, hit.node_id, hit.score FROM hit JOIN cnt ON hit.query_id = cnt.query_id WHERE n = 1 OR score = best""",
)
def j9_fuzzy_candidates(t):
    return resolve.fuzzy_match_entities(entity_queries(t), c.nodes(t))[1]


@query(
    "j10_find_existing",
    """WITH n AS (SELECT p_partkey AS node_id, upper(p_type || (p_partkey // 4)) AS key, upper(p_brand) AS loc, p_type AS type FROM part),
    w AS (SELECT p_partkey AS want_id, upper(p_type || (p_partkey // 4)) AS key, CASE WHEN p_partkey % 2 = 0 THEN upper(p_brand) ELSE 'OTHER' END AS loc,
      CASE p_partkey % 3 WHEN 0 THEN p_type WHEN 1 THEN 'none' END AS type FROM part),
    x AS (SELECT want_id, w.type AS wt, min(n.node_id) FILTER (n.loc = w.loc) AS l, min(n.node_id) AS a, min(n.node_id) FILTER (n.loc = w.loc AND n.type = w.type) AS lt,
      min(n.node_id) FILTER (n.type = w.type) AS at_ FROM w LEFT JOIN n ON n.key = w.key GROUP BY ALL)
    SELECT want_id, CASE WHEN wt IS NULL THEN coalesce(l, a) WHEN l IS NOT NULL THEN lt ELSE at_ END AS node_id FROM x""",
)
def j10_find_existing(t):
    wanted = t.part.selectExpr(
        "p_partkey AS want_id",
        "lower(concat(p_type, p_partkey div 4)) AS name",
        "CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'other' END AS location",
        "CASE p_partkey % 3 WHEN 0 THEN concat('pkg:::', p_type) WHEN 1 THEN 'none' END AS node_type",
    )
    return resolve.find_existing(named_nodes(t), wanted)


@query("j11_duplicate_names", "SELECT p_brand AS location, p_name AS name, count(*) AS n FROM part GROUP BY 1, 2 HAVING count(*) > 1")
def j11_duplicate_names(t):
    return resolve.duplicate_names(t.part.selectExpr("p_brand AS location", "p_name AS name"))


@query(
    "j12_join_cardinality",
    """WITH l AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), r AS (SELECT c_custkey AS k, count(*) AS n FROM customer GROUP BY 1)
    SELECT (SELECT max(n) FROM l) = 1 AS left_unique, (SELECT max(n) FROM r) = 1 AS right_unique,
      (SELECT CAST(sum(l.n * r.n) AS BIGINT) FROM l JOIN r ON l.k = r.k) AS predicted_rows,
      (SELECT count(*) FROM orders) AS left_rows, (SELECT count(*) FROM customer) AS right_rows""",
)
def j12_join_cardinality(t):
    return joins.join_cardinality(t.orders, t.customer, [("o_custkey", "c_custkey")])


TERMS_SQL = """terms AS (
    SELECT s_suppkey AS job_id, 'include' AS side, 0 AS term_no, '{ subgraph: G' || (s_suppkey % 12) || ' }' AS term, 'subgraph' AS kind, CAST(NULL AS VARCHAR) AS location, 'G' || (s_suppkey % 12) AS name, CAST(NULL AS VARCHAR) AS warning FROM supplier WHERE s_suppkey % 6 = 0
    UNION ALL SELECT s_suppkey, 'include', 0, '{ location: Brand#' || (s_suppkey % 25 + 1) || ' name: NONE }', 'location_name', 'Brand#' || (s_suppkey % 25 + 1), 'NONE', NULL FROM supplier WHERE s_suppkey % 6 = 1
    UNION ALL SELECT s_suppkey, 'include', 1, '{subgraph: "G' || (s_suppkey % 10) || '"}', 'subgraph', NULL, 'G' || (s_suppkey % 10), NULL FROM supplier WHERE s_suppkey % 6 = 1
    UNION ALL SELECT s_suppkey, 'include', 0, '{ subgraph: G1 || G2 }', NULL, NULL, NULL, 'combined_or' FROM supplier WHERE s_suppkey % 6 = 2
    UNION ALL SELECT s_suppkey, 'include', 1, '{ subgraph: G' || (s_suppkey % 10) || ' }', 'subgraph', NULL, 'G' || (s_suppkey % 10), NULL FROM supplier WHERE s_suppkey % 6 = 2
    UNION ALL SELECT s_suppkey, 'include', 0, 'subgraph: G' || (s_suppkey % 10), NULL, NULL, NULL, 'no_braces' FROM supplier WHERE s_suppkey % 6 = 3
    UNION ALL SELECT s_suppkey, 'include', 0, '{ subgraph: "A||B" }', 'subgraph', NULL, 'A||B', NULL FROM supplier WHERE s_suppkey % 6 = 5
    UNION ALL SELECT s_suppkey, 'include', 1, '{ name: X }', NULL, NULL, NULL, 'unrecognised_clause' FROM supplier WHERE s_suppkey % 6 = 5
    UNION ALL SELECT s_suppkey, 'exclude', 0, '{ subgraph: G' || (s_suppkey % 7) || ' }', 'subgraph', NULL, 'G' || (s_suppkey % 7), NULL FROM supplier WHERE s_suppkey % 2 = 0)
"""


@query("j14_parse_selectors", "WITH " + TERMS_SQL + "SELECT * FROM terms")
def j14_parse_selectors(t):
    return resolve.parse_selectors(c.jobs(t))


@query(
    "j13_resolve_job_nodes",
    with_sql("subgraphs")
    + ", "
    + TERMS_SQL
    + """, hits AS (SELECT DISTINCT job_id, side, node_id FROM terms JOIN subgraphs ON kind = 'subgraph' AND name = subgraph_name)
    SELECT i.job_id, i.node_id, subgraph_id, subgraph_name FROM hits i JOIN subgraphs s ON s.node_id = i.node_id WHERE side = 'include'
      AND NOT EXISTS (SELECT 1 FROM hits x WHERE x.side = 'exclude' AND x.job_id = i.job_id AND x.node_id = i.node_id)""",
)
def j13_resolve_job_nodes(t):
    kept, _ = resolve.resolve_job_nodes(resolve.parse_selectors(c.jobs(t)), c.subgraphs(t), c.nodes(t))
    return kept.select("job_id", "node_id", "subgraph_id", "subgraph_name")


@query(
    "j13_unresolved_terms",
    with_sql("subgraphs")
    + ", "
    + TERMS_SQL
    + """SELECT job_id, side, term_no, term FROM terms WHERE warning IS NULL
         AND NOT (kind = 'subgraph' AND name IN (SELECT subgraph_name FROM subgraphs))""",
)
def j13_unresolved_terms(t):
    _, unresolved = resolve.resolve_job_nodes(resolve.parse_selectors(c.jobs(t)), c.subgraphs(t), c.nodes(t))
    return unresolved.select("job_id", "side", "term_no", "term")


@query(
    "j15_resolve_node_types",
    """WITH r AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN '' || (p_partkey % 60) WHEN p_partkey % 50 = 1 THEN ':::5' ELSE p_brand || ':::' || (p_partkey % 60) END AS request,
        CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 50 = 1 THEN '' ELSE p_brand END AS alias, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 50 = 1 THEN '5' ELSE '' || (p_partkey % 60) END AS id FROM part),
    p AS (SELECT alias, count(*) AS n FROM (SELECT 'Brand#' || n_nationkey AS alias FROM nation UNION ALL SELECT 'Brand#' || r_regionkey FROM region) GROUP BY 1),
    e AS (SELECT DISTINCT p_brand AS alias, '' || (p_size * 2) AS id FROM part),
    d AS (SELECT id, count(*) AS n FROM ((SELECT DISTINCT '' || p_size AS id FROM part) UNION ALL SELECT '' || (r_regionkey * 2) FROM region) GROUP BY 1)
    SELECT request, CASE WHEN alias IS NULL THEN 'direct' ELSE 'package' END AS kind,
      CASE WHEN r.alias = '' THEN 'malformed' WHEN alias IS NOT NULL AND p.n IS NULL THEN 'no_alias' WHEN alias IS NOT NULL AND p.n > 1 THEN 'ambiguous_alias'
           WHEN alias IS NOT NULL AND e.id IS NULL THEN 'not_enabled' WHEN d.n IS NULL THEN 'missing' WHEN d.n > 1 THEN 'ambiguous' ELSE 'resolved' END AS status
    FROM (SELECT request, r.alias, r.id FROM r) r LEFT JOIN p USING (alias) LEFT JOIN e USING (alias, id) LEFT JOIN d USING (id)""",
)
def j15_resolve_node_types(t):
    requests = t.part.selectExpr(
        """CASE WHEN p_partkey % 3 = 0 THEN string(p_partkey % 60) WHEN p_partkey % 50 = 1 THEN ':::5'
             ELSE concat(p_brand, ':::', p_partkey % 60) END AS request"""
    )
    manifests = t.nation.selectExpr("n_nationkey AS k").unionByName(t.region.selectExpr("r_regionkey AS k"))
    packages = manifests.selectExpr("concat('Brand#', k) AS alias")
    enabled = t.part.selectExpr("p_brand AS alias", "string(p_size * 2) AS id")
    defined = t.part.selectExpr("string(p_size) AS id").distinct()
    definitions = defined.unionByName(t.region.selectExpr("string(r_regionkey * 2) AS id"))
    return resolve.resolve_node_types(requests, packages, enabled, definitions)
