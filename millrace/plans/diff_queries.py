"""Schema and SQL comparison over the derived catalogue."""

from pyspark.sql import functions as F

from millrace.operators import diff
from millrace.plans import catalogue as c
from millrace.plans.catalogue import with_sql
from millrace.plans.registry import query

# The two schema versions, written for the other engine from the rules of their derivation.
VERSIONS_SQL = with_sql("node_columns") + """, b AS (SELECT node_id, ordinal, column_id, name, data_type, coalesce(transform, '') AS expression, description FROM node_columns),
    a AS (SELECT node_id, ordinal, CASE WHEN node_id % 7 = 0 AND ordinal = 1 THEN name || '_NEW' ELSE name END AS name,
        CASE WHEN node_id % 13 = 0 AND ordinal = 2 THEN 'VARCHAR(99)' ELSE lower(data_type) END AS data_type,
        CASE WHEN node_id % 5 = 0 AND ordinal = 1 THEN 'MIN( X )' WHEN expression = '' THEN 'NULL' ELSE replace(expression, '.', ' . ') END AS expression
      FROM b WHERE NOT (node_id % 11 = 0 AND ordinal = 0)
      UNION ALL SELECT p_partkey, CAST(3 + p_partkey % 6 AS INT), 'EXTRA', 'VARCHAR', '"S"."NAME"' FROM part WHERE p_partkey % 3 = 0)
"""


@query(
    "d1_diff_columns",
    VERSIONS_SQL
    + """, m AS (SELECT b.node_id, b.name, upper(a.data_type) <> upper(b.data_type) AS ty,
        NOT (b.expression = '' AND a.expression IN ('', 'NULL')) AND replace(replace(a.expression, ' . ', '.'), 'MIN( X )', 'MIN(X)') <> b.expression AS ex
        FROM b JOIN a ON a.node_id = b.node_id AND a.name = b.name),
    gone AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.node_id = b.node_id AND a.name = b.name)),
    new AS (SELECT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.node_id = b.node_id AND a.name = b.name)),
    byexpr AS (SELECT g.node_id, g.name AS bk, n.name AS ak, upper(g.data_type) <> upper(n.data_type) AS ty FROM gone g JOIN new n ON n.node_id = g.node_id AND g.expression <> ''
       AND g.expression = replace(n.expression, ' . ', '.')),
    place AS (SELECT g.node_id, g.name AS bk, n.name AS ak, FALSE AS ty FROM gone g JOIN new n ON n.node_id = g.node_id AND n.ordinal = g.ordinal AND upper(n.data_type) = upper(g.data_type)
       WHERE NOT EXISTS (SELECT 1 FROM byexpr x WHERE x.node_id = g.node_id AND (x.bk = g.name OR x.ak = n.name))),
    ren AS (SELECT * FROM byexpr UNION ALL SELECT * FROM place)
    SELECT node_id, name AS before_key, name AS after_key, 'type_changed' AS change FROM m WHERE ty UNION ALL SELECT node_id, name, name, 'expression_changed' FROM m WHERE ex
    UNION ALL SELECT node_id, name, name, 'unchanged' FROM m WHERE NOT ty AND NOT ex UNION ALL SELECT node_id, bk, ak, 'renamed' FROM ren UNION ALL SELECT node_id, bk, ak, 'type_changed' FROM ren WHERE ty
    UNION ALL SELECT node_id, name, NULL, 'removed' FROM gone g WHERE NOT EXISTS (SELECT 1 FROM ren r WHERE r.node_id = g.node_id AND r.bk = g.name)
    UNION ALL SELECT node_id, NULL, name, 'added' FROM new n WHERE NOT EXISTS (SELECT 1 FROM ren r WHERE r.node_id = n.node_id AND r.ak = n.name)""",
)
def d1_diff_columns(t):
    return diff.diff_columns(c.schema_before(t), c.schema_after(t))


@query(
    "d2_normalise_expression",
    VERSIONS_SQL + r"SELECT node_id, ordinal, regexp_replace(regexp_replace(trim(expression), '\s+', ' ', 'g'), '\s*([^\w\s])\s*', '\1', 'g') AS expression FROM a",
)
def d2_normalise_expression(t):
    return c.schema_after(t).select("node_id", "ordinal", diff.norm_expression(F.col("expression")).alias("expression"))


@query(
    "d3_diff_sources",
    """WITH p AS (SELECT p_partkey AS k, 'L' || (p_partkey % 3) || '::' || upper(p_type) AS main, 'L' || (p_partkey % 5) || '::T' || (p_partkey % 9) AS extra FROM part),
    s AS (SELECT k, list_distinct(CASE WHEN k % 2 = 0 THEN [main, extra] ELSE [main] END) AS b,
      list_distinct(CASE WHEN k % 11 = 0 THEN CASE WHEN k % 4 = 0 THEN ['L0::X', extra] ELSE ['L0::X'] END WHEN k % 4 = 0 THEN [main, extra] ELSE [main] END) AS a FROM p),
    x AS (SELECT k, list_filter(a, lambda v: NOT list_contains(b, v)) AS added, list_filter(b, lambda v: NOT list_contains(a, v)) AS removed FROM s)
    SELECT k AS node_id, CASE WHEN k % 17 = 0 THEN 'unsupported' WHEN len(added) > 0 THEN 'new_source' WHEN len(removed) > 0 THEN 'removed_source'
      WHEN k % 7 = 0 OR (k % 19 = 0 AND k % 6 <> 0 AND k % 8 <> 0 AND k % 13 <> 0 AND k % 10 <> 0 AND k % 9 <> 0 AND k % 14 <> 1) THEN 'where_or_join_edit' ELSE 'identical' END AS verdict,
      array_to_string(list_sort(added), ',') AS added, array_to_string(list_sort(removed), ',') AS removed FROM x""",
)
def d3_diff_sources(t):
    return diff.diff_sources(c.sql_corpus(t)).withColumns({n: F.array_join(n, ",") for n in ("added", "removed")})


@query("d3_unsupported_sources", "SELECT p_partkey AS node_id FROM part WHERE p_partkey % 17 = 0")
def d3_unsupported_sources(t):
    return diff.diff_sources(c.sql_corpus(t)).filter("verdict = 'unsupported'").select("node_id")


@query(
    "d4_diff_tail",
    """WITH p AS (SELECT p_partkey AS k FROM part),
    x AS (SELECT k, k % 6 = 0 AS g, k % 3 = 0 AS og, k % 8 = 0 AND NOT (k % 19 = 0 AND k % 10 <> 0 AND k % 9 <> 0 AND k % 14 <> 1) AS plain, k % 8 = 0 OR k % 13 = 0 AS o, k % 4 = 0 AS oo,
      CASE WHEN k % 10 = 0 THEN CASE WHEN k % 19 = 0 THEN NULL ELSE 10 END WHEN k % 9 = 0 THEN -1 WHEN k % 14 = 1 THEN CASE WHEN k % 19 = 0 THEN NULL ELSE 7 END END AS l, CASE WHEN k % 5 = 0 THEN 10 END AS ol, k % 7 = 0 AS commented FROM p),
    y AS (SELECT * REPLACE (g AND NOT commented AS g, plain AND NOT commented AS plain, o AND NOT commented AS o, CASE WHEN NOT commented THEN l END AS l) FROM x),
    z AS (SELECT k, og, oo, CASE WHEN g = og THEN 'identical' WHEN g THEN 'added' ELSE 'removed' END AS group_by,
      CASE WHEN o AND NOT plain THEN 'identical' WHEN NOT plain AND NOT oo THEN 'identical' WHEN NOT plain THEN 'removed' WHEN NOT oo THEN 'added' WHEN k % 16 = 0 THEN 'identical' ELSE 'changed' END AS order_by,
      CASE WHEN l = -1 THEN 'unsupported' WHEN l IS NOT DISTINCT FROM ol THEN 'identical' WHEN l IS NULL THEN 'removed' WHEN ol IS NULL THEN 'added' ELSE 'changed' END AS limit_change FROM y)
    SELECT k AS node_id, group_by, order_by, limit_change, limit_change IN ('added', 'changed') AND (og OR oo) AS limit_misplaced FROM z""",
)
def d4_diff_tail(t):
    # Half of the ordered nodes store the ascending order the edited statement has.
    stored = F.when(F.col("node_id") % 16 == 0, "asc").otherwise("desc")
    rows = c.sql_corpus(t).select(
        "node_id",
        F.col("after_sql").alias("sql"),
        (F.col("node_id") % 3 == 0).alias("group_by_all"),
        (F.col("node_id") % 4 == 0).alias("order_by"),
        F.array(F.struct(F.lit("ID").alias("name"), stored.alias("direction"))).alias("order_items"),
        F.col("before_sql").alias("join_condition"),
    )
    return diff.diff_tail(rows)


@query(
    "d5_lint_sql",
    """SELECT p_partkey AS node_id, 'error' AS level, 'SQL_DOUBLE_QUOTED_REF' AS code FROM part WHERE p_partkey % 11 = 0
       UNION ALL SELECT p_partkey, 'warning', 'SQL_LITERAL_UNION_ALL' FROM part WHERE p_partkey % 19 = 0 AND p_partkey % 7 <> 0""",
)
def d5_lint_sql(t):
    return diff.lint_sql(c.sql_corpus(t), "after_sql")


@query("d6_lint_selectors", "SELECT s_suppkey AS job_id, 'include' AS side, 'error' AS level, 'SELECTOR_COMBINED_OR' AS code FROM supplier WHERE s_suppkey % 6 = 2")
def d6_lint_selectors(t):
    return diff.lint_selectors(c.jobs(t))


@query(
    "d7_validate_expected",
    with_sql("edges")
    + """SELECT p_partkey AS node_id, p_partkey % 4 <> 0 AS columns_ok, NOT (p_partkey % 5 = 0 AND p_partkey IN (SELECT dst FROM edges)) AS dependencies_ok,
         p_partkey % 6 <> 0 AS join_ok, NOT (p_partkey % 9 = 0 AND p_partkey IN (SELECT dst FROM edges)) AS coverage_ok FROM part""",
)
def d7_validate_expected(t):
    columns = c.node_columns(t).select("node_id", "ordinal", "name")
    e = c.edges(t).selectExpr("dst AS node_id", "src AS pred_id")
    deps = e.selectExpr("node_id", "'L' AS location", "concat('N', pred_id) AS name")
    text = t.part.selectExpr("p_partkey AS node_id", "'ON  a = b' AS join_condition")
    saved = {
        "columns": columns.selectExpr("node_id", "ordinal", "CASE WHEN node_id % 4 = 0 AND ordinal = 1 THEN 'other' ELSE lower(name) END AS name"),
        "dependencies": deps.selectExpr("node_id", "lower(location) AS location", "CASE WHEN node_id % 5 = 0 THEN concat(name, 'X') ELSE name END AS name"),
        "joins": text.selectExpr("node_id", "CASE WHEN node_id % 6 = 0 THEN '' ELSE ' ON a  =  b' END AS join_condition"),
        "refs": e.selectExpr("pred_id AS src_node", "CASE WHEN node_id % 9 = 0 THEN -1 ELSE node_id END AS dst_node"),
    }
    return diff.validate_expected(saved, {"columns": columns, "dependencies": deps, "joins": text, "predecessors": e})


@query(
    "d8_sql_profile",
    """SELECT p_partkey AS node_id, CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 1 END AS sources, p_partkey % 2 = 0 AS has_join, p_partkey % 3 = 0 AS has_group_by, 0 AS ctes,
       CASE WHEN p_partkey % 3 = 0 THEN 'aggregation' WHEN p_partkey % 2 = 0 THEN 'multiSource' ELSE 'staging' END AS kind FROM part""",
)
def d8_sql_profile(t):
    return diff.sql_profile(c.sql_corpus(t), "before_sql")


@query(
    "d8_cte_profile",
    """SELECT p_partkey AS node_id, i AS position, ['A', 'B', 'C_X'][i + 1] AS cte, i = 1 AS has_join, i = 2 AND p_partkey % 2 = 0 AS has_group_by,
       CASE WHEN i = 1 THEN 'multiSource' WHEN i = 2 AND p_partkey % 2 = 0 THEN 'aggregation' ELSE 'staging' END AS kind, ['', 'A', 'B'][i + 1] AS depends_on
       FROM part, (SELECT CAST(unnest(range(0, 3)) AS INT) AS i)""",
)
def d8_cte_profile(t):
    text = """concat('with a as (select id, count(*) over (partition by f(x)) n from t', p_partkey, '), b as (select * from a join u on a.id = (u.id)), c_x AS (select max(n) from b',
              CASE WHEN p_partkey % 2 = 0 THEN ' group by id' ELSE '' END, ') select * from c_x')"""
    found = diff.cte_profile(t.part.selectExpr("p_partkey AS node_id", f"{text} AS sql"))
    return found.withColumn("depends_on", F.array_join("depends_on", ","))


@query(
    "d9_merge_versions",
    VERSIONS_SQL
    + """, old AS (SELECT a.*, b.column_id, b.expression AS be, b.description AS d, CASE WHEN a.name <> b.name THEN 'renamed' ELSE 'kept' END AS origin
        FROM a JOIN b ON a.node_id = b.node_id AND (a.name = b.name OR (a.name = b.name || '_NEW'
          AND (b.expression = replace(a.expression, ' . ', '.') OR upper(a.data_type) = upper(b.data_type)))))
    SELECT node_id, ordinal, CAST(column_id AS VARCHAR) AS column_id, name, data_type,
      CASE WHEN origin = 'kept' AND expression = 'MIN( X )' THEN expression ELSE be END AS expression, coalesce(d, '') AS description, origin FROM old
    UNION ALL SELECT node_id, ordinal, 'new-' || md5(node_id || '|' || name), name, data_type, expression, '', 'added' FROM a WHERE name = 'EXTRA'""",
)
def d9_merge_versions(t):
    before, after = c.schema_before(t), c.schema_after(t)
    return diff.merge_schema_versions(before, after, diff.diff_columns(before, after))
