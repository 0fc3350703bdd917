"""Projection, filter, classification and search over the supplied tables."""

from pyspark.sql import functions as F

from millrace.operators import classify, project, search
from millrace.operators.profile import variant_dedup
from millrace.plans import catalogue as c
from millrace.plans.catalogue import with_sql
from millrace.plans.registry import query
from millrace.sources.scratch import Scratch


@query(
    "p1_stage",
    """SELECT c_custkey AS custkey, upper(c_name) AS name, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
       CASE WHEN c_acctbal < 0 THEN 'debit' ELSE 'credit' END AS side FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def p1_stage(t):
    columns = {
        "custkey": "c_custkey",
        "name": "upper(c_name)",
        "balance": "cast(c_acctbal as decimal(18,2))",
        "side": "CASE WHEN c_acctbal < 0 THEN 'debit' ELSE 'credit' END",
    }
    return project.stage(t.customer, columns, "WHERE c_mktsegment = 'BUILDING'")


@query(
    "p2_expand_wildcard",
    "SELECT c.* FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE n.n_regionkey = 1",
)
def p2_expand_wildcard(t):
    joined = t.customer.alias("c").join(t.nation.alias("n"), F.expr("c.c_nationkey = n.n_nationkey")).filter("n.n_regionkey = 1")
    return project.expand_wildcard({"c": t.customer, "n": t.nation}, joined, "c.*")


@query(
    "p3_add_where",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000",
)
def p3_add_where(t):
    df = project.add_where(t.orders, "  where o_orderstatus = 'F'")
    return project.add_where(project.add_where(df, ""), "o_totalprice > 300000").select("o_orderkey", "o_totalprice")


@query(
    "p4_conform_to_schema",
    """SELECT CAST(l_orderkey AS VARCHAR) AS L_ORDERKEY, CAST(l_quantity AS DECIMAL(12,2)) AS quantity_missing,
       CAST(l_shipdate AS DATE) AS L_SHIPDATE, CAST(NULL AS VARCHAR) AS comment, l_returnflag || l_linestatus AS state FROM lineitem""",
)
def p4_conform_to_schema(t):
    target = [
        project.Target("L_ORDERKEY", "VARCHAR"),
        project.Target("quantity_missing", "NUMBER(12,2)", "l_quantity"),
        project.Target("L_SHIPDATE", "DATE"),
        project.Target("comment", "VARCHAR"),
        project.Target("state", "VARCHAR", "concat(l_returnflag, l_linestatus)"),
    ]
    return project.conform_to_schema(t.lineitem, target)[0]


@query(
    "p4_conform_catalogue",
    with_sql("node_columns")
    + """, s AS (SELECT node_id, upper(name) AS key, name AS s_name, upper(data_type) AS s_type FROM node_columns),
    a AS (SELECT node_id, name, lower(CASE WHEN node_id % 13 = 0 AND ordinal = 2 THEN 'VARCHAR(99)' ELSE data_type END) AS data_type, transform
          FROM node_columns WHERE NOT (node_id % 11 = 0 AND ordinal = 0)
          UNION ALL SELECT p_partkey, 'EXTRA', 'VARCHAR', CASE WHEN p_partkey % 2 = 0 THEN 'X' END FROM part WHERE p_partkey % 3 = 0),
    x AS (SELECT node_id, upper(name) AS key, name AS t_name, upper(data_type) AS t_type, transform FROM a)
    SELECT coalesce(s.node_id, x.node_id) AS node_id, coalesce(t_name, s_name) AS name,
      CASE WHEN s_name IS NULL THEN 'added' WHEN t_name IS NULL THEN 'dropped' ELSE 'matched' END AS state,
      s_type AS from_type, t_type AS to_type, coalesce(s_type <> t_type, FALSE) AS type_changed,
      s_name IS NULL AND transform IS NULL AS needs_transform
    FROM s FULL JOIN x ON s.node_id = x.node_id AND s.key = x.key""",
)
def p4_conform_catalogue(t):
    source = c.node_columns(t).select("node_id", "name", "data_type")
    kept = c.node_columns(t).filter("NOT (node_id % 11 = 0 AND ordinal = 0)").selectExpr(
        "node_id", "name", "lower(CASE WHEN node_id % 13 = 0 AND ordinal = 2 THEN 'VARCHAR(99)' ELSE data_type END) AS data_type", "transform"
    )
    extra = t.part.filter("p_partkey % 3 = 0").selectExpr(
        "p_partkey AS node_id", "'EXTRA' AS name", "'VARCHAR' AS data_type", "CASE WHEN p_partkey % 2 = 0 THEN 'X' END AS transform"
    )
    return project.conform_catalogue(source, kept.unionByName(extra))


@query(
    "p5_edit_columns",
    "SELECT s_suppkey AS suppkey, s_name, s_acctbal * 2 AS twice FROM supplier",
)
def p5_edit_columns(t):
    df = project.add_column(t.supplier, "twice", "s_acctbal * 2")
    df = project.drop_column(df, "s_nationkey", "s_acctbal")
    return project.rename_columns(df, {"s_suppkey": "suppkey"})


@query(
    "p6_infer_types",
    with_sql("node_columns")
    + """SELECT column_id, CASE WHEN contains(u, 'COUNT(') THEN 'NUMBER' WHEN contains(u, 'SUM(') THEN 'NUMBER(38,4)'
         WHEN contains(u, 'MAX(') AND contains(u, '_TS') THEN 'TIMESTAMP_NTZ(9)' WHEN contains(u, 'UPPER(') THEN 'VARCHAR'
         WHEN contains(u, 'CASE') THEN 'VARCHAR' WHEN contains(u, 'ROW_NUMBER()') THEN 'NUMBER' END AS inferred_type
         FROM (SELECT column_id, upper(transform) AS u FROM node_columns)""",
)
def p6_infer_types(t):
    return classify.infer_types(c.node_columns(t)).select("column_id", "inferred_type")


@query(
    "p7_flag_passthrough",
    with_sql("node_columns")
    + """SELECT column_id, transform IS NULL OR trim(transform) = '' OR upper(transform) = name
         OR regexp_extract(transform, '^"[^"]+"\\s*\\.\\s*"([^"]+)"$', 1) = name AS is_passthrough FROM node_columns""",
)
def p7_flag_passthrough(t):
    return classify.flag_passthrough(c.node_columns(t)).select("column_id", "is_passthrough")


@query(
    "p8_infer_column_roles",
    with_sql("node_columns")
    + """, f AS (SELECT *, regexp_matches(name, '_(ID|KEY|CODE|NUM)$|^(ID|KEY|CODE)_') AS k,
        NOT regexp_matches(name, '^(SYS_|DW_|ETL_|LOAD_|CREATED_|UPDATED_|MODIFIED_|INSERT_|UPDATE_)')
          AND NOT regexp_matches(coalesce(transform, ''), '(?i)\\b(COUNT|SUM|AVG|MIN|MAX|STDDEV|VARIANCE|LISTAGG|ARRAY_AGG)\\s*\\(')
          AND NOT is_business_key AS t,
        bool_or(is_business_key) OVER (PARTITION BY node_id) AS ak, bool_or(is_change_tracking) OVER (PARTITION BY node_id) AS at_ FROM node_columns)
    SELECT column_id, regexp_matches(name, '_TS$|_TIMESTAMP$|TIMESTAMP_') AS is_timestamp, regexp_matches(name, '_DATE$|_DT$|DATE_') AS is_date,
      CASE WHEN ak THEN is_business_key ELSE k END AS business_key,
      CASE WHEN at_ THEN is_change_tracking ELSE t AND NOT k END AS change_tracking FROM f""",
)
def p8_infer_column_roles(t):
    return classify.infer_column_roles(c.node_columns(t)).select(
        "column_id", "is_timestamp", "is_date", "business_key", "change_tracking"
    )


@query(
    "p9_detect_scd2_nodes",
    with_sql("node_columns")
    + """SELECT node_id, count(DISTINCT name) FILTER (name IN ('START_DATE', 'END_DATE', 'IS_CURRENT')) = 3 AS is_scd2
         FROM node_columns GROUP BY node_id""",
)
def p9_detect_scd2_nodes(t):
    return classify.detect_scd2_nodes(c.node_columns(t))


CONTEXT_SQL = with_sql("nodes", "edges", "node_columns") + """, f AS (SELECT node_id,
      bool_or(regexp_matches(coalesce(transform, ''), '(?i)\\b(SUM|MAX)\\s*\\(')) AS agg,
      bool_or(regexp_matches(name, '_TS$|_TIMESTAMP$|TIMESTAMP_|_DATE$|_DT$|DATE_')) AS tim,
      count(DISTINCT name) FILTER (name IN ('START_DATE', 'END_DATE', 'IS_CURRENT')) = 3 AS hist,
      bool_or(is_business_key) AS marked FROM node_columns GROUP BY node_id),
    ctx AS (SELECT n.node_id, n.node_type, coalesce(agg, FALSE) AS agg, coalesce(tim, FALSE) AS tim, coalesce(hist, FALSE) AS hist,
      coalesce(marked, FALSE) AS marked, (SELECT count(*) FROM edges e WHERE e.dst = n.node_id) AS sources, n.materialization AS stored
      FROM nodes n LEFT JOIN f USING (node_id))
"""


@query(
    "p10_suggest_load_config",
    CONTEXT_SQL
    + """SELECT node_id, CASE WHEN sources > 1 AND agg THEN 'UNION' WHEN sources > 1 THEN 'UNION ALL' END AS insert_strategy,
         CASE WHEN agg OR stored = 'view' THEN FALSE END AS select_distinct,
         CASE WHEN stored = 'table' THEN FALSE END AS truncate_before,
         hist AS check_history_settings, stored = 'table' AND NOT tim AS lacks_audit_columns FROM ctx""",
)
def p10_suggest_load_config(t):
    context = classify.node_context(c.nodes(t), c.node_columns(t), c.edges(t))
    return classify.suggest_load_config(context).select(
        "node_id", "insert_strategy", "select_distinct", "truncate_before", "check_history_settings", "lacks_audit_columns"
    )


def config_items(t):
    """Settings per node type, derived from the types in use."""
    kinds = c.nodes(t).select("node_type").distinct()
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(item).alias("item"),
                    F.lit(kind).alias("kind"),
                    F.lit(required).alias("required"),
                    F.lit(default).cast("string").alias("default_value"),
                )
                for item, kind, required, default in (
                    ("insertStrategy", "dropdownSelector", False, "INSERT"),
                    ("truncateBefore", "toggleButton", False, "true"),
                    ("preSQL", "textBox", False, None),
                    ("target", "textBox", True, "T"),
                    ("owner", "textBox", True, None),
                    ("isBusinessKey", "columnSelector", False, None),
                )
            ]
        )
    )
    return kinds.select("node_type", rows)


@query(
    "p11_complete_config",
    CONTEXT_SQL
    + """SELECT node_id, CASE WHEN sources > 1 AND agg THEN 'UNION' WHEN sources > 1 THEN 'UNION ALL' ELSE 'INSERT' END AS insert_strategy,
         CASE WHEN stored = 'table' THEN 'false' ELSE 'true' END AS truncate_before,
         CASE WHEN node_id % 3 = 0 THEN 'mine' ELSE 'T' END AS target,
         CASE WHEN node_id % 2 = 0 THEN '' ELSE 'owner' END AS missing,
         NOT marked AND node_type IN ('Dimension', 'Fact', 'persistentStage') AS lacks_business_key,
         CASE WHEN node_id % 2 = 1 THEN 'incomplete'
              WHEN NOT marked AND node_type IN ('Dimension', 'Fact', 'persistentStage') THEN 'needs_attention'
              ELSE 'complete' END AS status FROM ctx""",
)
def p11_complete_config(t):
    context = classify.node_context(c.nodes(t), c.node_columns(t), c.edges(t))
    suggested = classify.suggestion_map(classify.suggest_load_config(context))
    own = F.map_filter(
        F.create_map(
            F.lit("owner"),
            F.when(F.col("node_id") % 2 == 0, "me"),
            F.lit("target"),
            F.when(F.col("node_id") % 3 == 0, "mine"),
        ),
        lambda k, v: v.isNotNull(),
    )
    done = classify.complete_config(suggested.withColumn("config", own), config_items(t))
    return done.select(
        "node_id",
        F.col("applied")["insertStrategy"].alias("insert_strategy"),
        F.col("applied")["truncateBefore"].alias("truncate_before"),
        F.col("applied")["target"].alias("target"),
        F.array_join("missing_required", ",").alias("missing"),
        "lacks_business_key",
        "status",
    )


def searchable(t):
    """Nodes whose description is a whole document and whose SQL is a stored statement."""
    text = t.documents.select(F.col("doc_id").alias("node_id"), F.col("text").alias("long_text"))
    sql = c.sql_corpus(t).select("node_id", F.col("before_sql").alias("sql"))
    return (
        c.nodes(t).join(sql, "node_id").join(text, "node_id", "left")
        .select("node_id", "name", "node_type", "sql", F.coalesce("long_text", "description").alias("description"), F.lit(None).cast("string").alias("config"))
    )


@query(
    "p12_search_content",
    with_sql("nodes", "node_columns")
    + """, s AS (SELECT n.node_id, n.name, n.node_type,
       'SELECT "A"."ID" FROM {{ ref(''L' || (n.node_id % 3) || ''', ''' || upper(p_type) || ''') }} "A"' ||
        CASE WHEN n.node_id % 2 = 0 THEN ' JOIN "DB"."L' || (n.node_id % 5) || '"."T' || (n.node_id % 9) || '" "B" ON "A"."ID" = "B"."ID"' ELSE '' END ||
        CASE WHEN n.node_id % 3 = 0 THEN ' GROUP BY "A"."ID"' ELSE '' END || CASE WHEN n.node_id % 4 = 0 THEN ' ORDER BY "A"."ID" DESC' ELSE '' END ||
        CASE WHEN n.node_id % 5 = 0 THEN ' LIMIT 10' ELSE '' END AS sql, coalesce(d.text, n.description) AS description
       FROM nodes n JOIN part ON p_partkey = n.node_id LEFT JOIN documents d ON d.doc_id = n.node_id),
    m AS (SELECT node_id, 'name' AS field, CAST(NULL AS VARCHAR) AS column_name, name AS text, TRUE AS whole FROM s
      UNION ALL SELECT node_id, 'nodeType', NULL, node_type, TRUE FROM s UNION ALL SELECT node_id, 'sql', NULL, sql, FALSE FROM s
      UNION ALL SELECT node_id, 'description', NULL, description, FALSE FROM s
      UNION ALL SELECT node_id, 'columnName', name, name, TRUE FROM node_columns
      UNION ALL SELECT node_id, 'columnDataType', name, data_type, TRUE FROM node_columns),
    h AS (SELECT *, instr(lower(text), 'at') AS p, length(text) AS n FROM m WHERE instr(lower(text), 'at') > 0)
    SELECT node_id, field, column_name, CASE WHEN whole THEN text ELSE
      CASE WHEN p > 61 THEN '…' ELSE '' END || substring(text, greatest(p - 60, 1), least(p + 61, n) - greatest(p - 60, 1) + 1) ||
      CASE WHEN p + 61 < n THEN '…' ELSE '' END END AS snippet FROM h""",
)
def p12_search_content(t):
    return search.search_content(searchable(t), c.node_columns(t), "AT")


#: A hundred search texts of two to six characters, a tenth of which nothing holds.
SEARCHES = """SELECT p_partkey AS query_id, CASE WHEN p_partkey % 10 = 9 THEN '#' ELSE '' END || substr(upper(p_type) || '_' || p_partkey, CAST(2 + p_partkey % 3 AS INT), CAST(2 + p_partkey % 5 AS INT)) AS query FROM part WHERE p_partkey < 100"""


@query(
    "p12_search_many",
    with_sql("nodes", "node_columns")
    + """, s AS (SELECT n.node_id, n.name, n.node_type,
       'SELECT "A"."ID" FROM {{ ref(''L' || (n.node_id % 3) || ''', ''' || upper(p_type) || ''') }} "A"' ||
        CASE WHEN n.node_id % 2 = 0 THEN ' JOIN "DB"."L' || (n.node_id % 5) || '"."T' || (n.node_id % 9) || '" "B" ON "A"."ID" = "B"."ID"' ELSE '' END ||
        CASE WHEN n.node_id % 3 = 0 THEN ' GROUP BY "A"."ID"' ELSE '' END || CASE WHEN n.node_id % 4 = 0 THEN ' ORDER BY "A"."ID" DESC' ELSE '' END ||
        CASE WHEN n.node_id % 5 = 0 THEN ' LIMIT 10' ELSE '' END AS sql, coalesce(d.text, n.description) AS description
       FROM nodes n JOIN part ON p_partkey = n.node_id LEFT JOIN documents d ON d.doc_id = n.node_id),
    m AS (SELECT node_id, 'name' AS field, CAST(NULL AS VARCHAR) AS column_name, name AS text, TRUE AS whole FROM s
      UNION ALL SELECT node_id, 'nodeType', NULL, node_type, TRUE FROM s UNION ALL SELECT node_id, 'sql', NULL, sql, FALSE FROM s
      UNION ALL SELECT node_id, 'description', NULL, description, FALSE FROM s
      UNION ALL SELECT node_id, 'columnName', name, name, TRUE FROM node_columns
      UNION ALL SELECT node_id, 'columnDataType', name, data_type, TRUE FROM node_columns),
    q AS ("""
    + SEARCHES
    + """), h AS (SELECT q.query_id, length(query) AS size, m.*, instr(lower(text), lower(query)) AS p, length(text) AS n FROM m, q WHERE instr(lower(text), lower(query)) > 0)
    SELECT query_id, node_id, field, column_name, CASE WHEN whole THEN text ELSE
      CASE WHEN p > 61 THEN '…' ELSE '' END || substr(text, greatest(p - 60, 1), least(p - 1 + size + 60, n) - greatest(p - 60, 1) + 1) || CASE WHEN p - 1 + size + 60 < n THEN '…' ELSE '' END END AS snippet FROM h""",
)
def p12_search_many(t):
    """From an index of the catalogue's texts, built once for all searches."""
    folder = Scratch(t.spark, "textindex").path
    search.index_content(searchable(t), c.node_columns(t), folder)
    return search.search_indexed(t.spark, folder, t.part.where("p_partkey < 100").selectExpr("p_partkey AS query_id", SEARCHES.split("query_id, ")[1].split(" AS query FROM")[0] + " AS query"))


@query(
    "p13_classify_node_family",
    with_sql("nodes")
    + """SELECT node_id, CASE node_type WHEN 'Stage' THEN 'stage' WHEN 'View' THEN 'view' WHEN 'Work' THEN 'work' WHEN 'Dimension' THEN 'dimension'
         WHEN 'Fact' THEN 'fact' WHEN 'persistentStage' THEN 'persistent-stage' ELSE 'unknown' END AS family FROM nodes""",
)
def p13_classify_node_family(t):
    return classify.classify_node_family(c.nodes(t)).select("node_id", "family")


LAYER_SQL = """CASE WHEN regexp_matches(name, '^(RAW_|SRC_|LANDING_|L0_)') THEN 'bronze' WHEN regexp_matches(name, '^(STG_|STAGE_|CLEAN_|L1_)') THEN 'staging'
    WHEN regexp_matches(name, '^(INT_|TMP_|WORK_|TRANSFORM_)') THEN 'intermediate' WHEN regexp_matches(name, '^(DIM_|DIMENSION_|FACT_|FCT_|MART_|RPT_)') THEN 'mart'
    WHEN regexp_replace(node_type, '.*:::', '') IN ('Dimension', 'Fact') THEN 'mart' ELSE 'unknown' END"""


@query("p14_infer_layer", with_sql("nodes") + f"SELECT node_id, {LAYER_SQL} AS layer FROM nodes")
def p14_infer_layer(t):
    return classify.infer_layer(c.nodes(t)).select("node_id", "layer")


@query(
    "p15_check_materialization",
    with_sql("nodes") + "SELECT node_id, name FROM nodes WHERE node_type = 'View' AND materialization = 'table'",
)
def p15_check_materialization(t):
    return classify.check_materialization(c.nodes(t)).select("node_id", "name")


VARIANT_SQL = """WITH d AS (SELECT p_type AS family, p_brand AS package, 'size ' || (p_size % 9) AS dt, 'create ' || p_type AS ct, 'run ' || (p_size % 2) AS rt,
      CASE WHEN p_size % 9 = 8 THEN NULL WHEN p_size % 9 = 7 THEN 'label,tabular' WHEN p_size % 9 = 6 THEN 'columnSelector,textBox' ELSE 'textBox,toggleButton' END AS prim FROM part),
    v AS (SELECT family || '|' || sha256(dt) || '|' || sha256(ct) || '|' || sha256(rt) AS variant_key, family, count(*) AS occurrences,
      string_agg(DISTINCT package, ',' ORDER BY package) AS packages, max(prim) AS prim,
      CASE WHEN max(prim) IS NULL THEN 'parse_error' WHEN max(prim) = 'textBox,toggleButton' THEN 'supported' ELSE 'partial' END AS support_status
      FROM d GROUP BY 1, 2)
"""


@query(
    "p16_search_variants",
    VARIANT_SQL
    + """SELECT variant_key, occurrences FROM v WHERE lower(family) = 'promo' AND contains(',' || prim || ',', ',textBox,') AND support_status = 'partial'
         AND contains(',' || packages || ',', ',Brand#12,')""",
)
def p16_search_variants(t):
    variants = variant_dedup(c.definitions(t))
    return search.search_variants(variants, " Promo ", "brand#12", "TEXTBOX", "partial").select("variant_key", "occurrences")


@query(
    "p17_suggest_names",
    with_sql("nodes")
    + """SELECT node_id, regexp_replace(CASE node_type WHEN 'Stage' THEN 'STG' WHEN 'View' THEN 'VW' WHEN 'Work' THEN 'WRK' WHEN 'Dimension' THEN 'DIM'
         WHEN 'Fact' THEN 'FACT' WHEN 'persistentStage' THEN 'PSTG' ELSE 'NODE' END || '_' || regexp_replace(name, '^(STG_|DIM_|FACT_|INT_)', ''), '__+', '_') AS suggested_name
         FROM nodes""",
)
def p17_suggest_names(t):
    return classify.suggest_names(c.nodes(t)).select("node_id", "suggested_name")
