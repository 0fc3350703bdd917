"""A pipeline catalogue derived from the supplied tables by plain arithmetic.

Every row comes from a row of ``part``, ``supplier``, ``orders`` or ``lineitem``, so the catalogue
grows with them. ``k`` is p_partkey. ``SQL`` holds the same rules for the other engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.spread import spread

AS_OF = "2001-08-02 00:00:00"
TYPES = ["Stage", "base-nodes:::Stage", "View", "Work", "Dimension", "Fact", "persistentStage", "base-nodes:::Fact"]
PREFIXES = ["RAW_", "STG_", "INT_", "DIM_", "FACT_", "HUB_", ""]
COLUMN_NAMES = ["ID", "CODE", "LOAD_TS", "AMOUNT", "NAME", "START_DATE", "END_DATE", "IS_CURRENT"]
COLUMN_TYPES = ["NUMBER(38,0)", "VARCHAR(16)", "TIMESTAMP_NTZ(9)", "NUMBER(38,4)", "VARCHAR", "DATE", "DATE", "BOOLEAN"]
ERRORS = [
    "SQL compilation error: syntax error line 1",
    "Object 'X' does not exist or is unknown",
    "Insufficient privileges to operate on table",
    "Cannot cast value to NUMBER",
    "Statement reached its timeout",
    "duplicate column name in config",
    "Procedure P does not exist",
    "opaque failure",
]


class Tables:
    """The supplied Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def _pick(values: list[str], index: str) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"element_at(array({quoted}), cast(({index}) % {len(values)} as int) + 1)"


def nodes(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "cast(p_size div 100 as int) AS workspace_id",
        "p_partkey AS node_id",
        f"concat({_pick(PREFIXES, 'p_size')}, upper(p_type), '_', p_partkey) AS name",
        f"{_pick(TYPES, 'p_size')} AS node_type",
        "p_brand AS location",
        "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS description",
        "CASE WHEN p_partkey % 6 = 0 THEN 'view' ELSE 'table' END AS materialization",
        "p_partkey % 5 AS environment_id",
    )


def edges(t: Tables) -> DataFrame:
    """Distinct (src, dst), always src < dst."""
    rules = t.part.selectExpr(
        "p_partkey AS dst",
        "explode(array(p_partkey div 2, p_partkey div 3, CASE WHEN p_partkey % 3 = 0 THEN (p_partkey div 50) * 50 END)) AS src",
    )
    return rules.filter("src IS NOT NULL AND src <> dst").select("src", "dst").distinct()


def node_columns(t: Tables) -> DataFrame:
    """3 + k % 6 columns per node; odd positions carry a transform."""
    rows = t.part.selectExpr("cast(p_size div 100 as int) AS workspace_id", "p_partkey AS node_id", "explode(sequence(0, cast(2 + p_partkey % 6 as int))) AS ordinal")
    return rows.selectExpr(
        "workspace_id",
        "node_id",
        "ordinal",
        "node_id * 10 + ordinal AS column_id",
        f"{_pick(COLUMN_NAMES, 'ordinal')} AS name",
        f"{_pick(COLUMN_TYPES, 'ordinal')} AS data_type",
        """CASE WHEN ordinal % 2 = 0 THEN NULL
                WHEN node_id % 7 = 0 THEN 'SUM("S"."AMOUNT")'
                WHEN node_id % 7 = 1 THEN concat('"S"."', CASE ordinal WHEN 1 THEN 'CODE' ELSE 'AMOUNT' END, '"')
                WHEN node_id % 7 = 2 THEN 'UPPER("S"."NAME")'
                WHEN node_id % 7 = 3 THEN 'ROW_NUMBER() OVER (ORDER BY "S"."ID")'
                WHEN node_id % 7 = 4 THEN 'MAX("S"."LOAD_TS")'
                WHEN node_id % 7 = 5 THEN 'CASE WHEN 1 = 1 THEN 2 END'
                ELSE 'COALESCE("S"."ID", 0)' END AS transform""",
        "CASE WHEN (node_id + ordinal) % 3 = 0 THEN NULL ELSE 'text' END AS description",
        "node_id % 5 = 0 AND ordinal = 1 AS is_business_key",
        "node_id % 10 = 0 AND ordinal = 2 AS is_change_tracking",
    )


def column_refs(t: Tables) -> DataFrame:
    """Column j of a node refers to column j of each predecessor that has one."""
    counts = t.part.selectExpr("p_partkey AS node_id", "cast(2 + p_partkey % 6 as int) AS last")
    e = edges(t)
    both = e.join(spread(counts.select(F.col("node_id").alias("src"), F.col("last").alias("s_last"))), "src").join(
        spread(counts.select(F.col("node_id").alias("dst"), F.col("last").alias("d_last"))), "dst"
    )
    return both.selectExpr("src", "dst", "explode(sequence(0, least(s_last, d_last))) AS ordinal").selectExpr(
        "src AS src_node", "src * 10 + ordinal AS src_column", "dst AS dst_node", "dst * 10 + ordinal AS dst_column"
    )


def runs(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey AS run_id",
        "o_custkey % 5 AS environment_id",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'canceled' END AS status",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'deploy' ELSE 'refresh' END AS run_type",
        "o_orderdate AS start_time",
        "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 HOUR END AS end_time",
        "CASE WHEN o_orderkey % 4 = 0 THEN o_custkey END AS job_id",
        "CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS nodes_in_run",
    )


def run_nodes(t: Tables) -> DataFrame:
    """One row per (run, node): the lowest status letter of its lines."""
    once = t.lineitem.groupBy(F.col("l_orderkey").alias("run_id"), F.col("l_partkey").alias("node_id")).agg(
        F.min("l_returnflag").alias("flag")
    )
    return once.selectExpr(
        "run_id",
        "node_id",
        "CASE flag WHEN 'A' THEN 'completed' WHEN 'R' THEN 'Failed' ELSE 'skipped' END AS status",
        f"CASE WHEN flag = 'R' AND node_id % 9 <> 8 THEN {_pick(ERRORS, 'node_id % 9')} END AS error",
    )


def jobs(t: Tables) -> DataFrame:
    """One job per supplier, with good, quoted, unknown and malformed terms."""
    return t.supplier.selectExpr(
        "s_suppkey AS job_id",
        """CASE s_suppkey % 6
             WHEN 0 THEN concat('{ subgraph: G', s_suppkey % 12, ' }')
             WHEN 1 THEN concat('{ location: Brand#', s_suppkey % 25 + 1, ' name: NONE } OR {subgraph: "G', s_suppkey % 10, '"}')
             WHEN 2 THEN concat('{ subgraph: G1 || G2 } or { subgraph: G', s_suppkey % 10, ' }')
             WHEN 3 THEN concat('subgraph: G', s_suppkey % 10)
             WHEN 4 THEN ''
             ELSE '{ subgraph: "A||B" } OR { name: X }' END AS include_selector""",
        "CASE WHEN s_suppkey % 2 = 0 THEN concat('{ subgraph: G', s_suppkey % 7, ' }') END AS exclude_selector",
    )


def subgraphs(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "p_partkey % 10 AS subgraph_id", "concat('G', p_partkey % 10) AS subgraph_name", "p_partkey AS node_id"
    )


def roles(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "c_custkey % 500 AS user_id",
        "CASE c_custkey % 3 WHEN 0 THEN 'org' WHEN 1 THEN 'project' ELSE 'environment' END AS scope",
        "cast(c_nationkey as bigint) AS scope_id",
        "c_mktsegment AS role",
    )


def sql_corpus(t: Tables) -> DataFrame:
    """A stored statement before and after an edit, for every node."""
    return t.part.selectExpr(
        "p_partkey AS node_id",
        """concat('SELECT "A"."ID" FROM {{ ref(''L', p_partkey % 3, ''', ''', upper(p_type), ''') }} "A"',
                  CASE WHEN p_partkey % 2 = 0 THEN concat(' JOIN "DB"."L', p_partkey % 5, '"."T', p_partkey % 9, '" "B" ON "A"."ID" = "B"."ID"') ELSE '' END,
                  CASE WHEN p_partkey % 3 = 0 THEN ' GROUP BY "A"."ID"' ELSE '' END,
                  CASE WHEN p_partkey % 4 = 0 THEN ' ORDER BY "A"."ID" DESC' ELSE '' END,
                  CASE WHEN p_partkey % 5 = 0 THEN ' LIMIT 10' ELSE '' END) AS before_sql""",
        """concat(CASE WHEN p_partkey % 17 = 0 THEN 'WITH c AS (SELECT 1) ' ELSE '' END,
                  'select "A"."ID"  from {{ ref(', CASE WHEN p_partkey % 11 = 0 THEN '"L0", "X"' ELSE concat('''L', p_partkey % 3, ''', ''', upper(p_type), '''') END, ') }} "A"',
                  CASE WHEN p_partkey % 4 = 0 THEN concat(' JOIN "DB"."L', p_partkey % 5, '"."T', p_partkey % 9, '" "B" ON "A"."ID" = "B"."ID"') ELSE '' END,
                  CASE WHEN p_partkey % 7 = 0 THEN ' where "A"."ID" > 1 -- union all' ELSE '' END,
                  CASE WHEN p_partkey % 6 = 0 THEN ' group by "A"."ID"' ELSE '' END,
                  CASE WHEN p_partkey % 8 = 0 THEN ' order by "A"."ID"' WHEN p_partkey % 13 = 0 THEN ' order by abs("A"."ID")' ELSE '' END,
                  CASE WHEN p_partkey % 10 = 0 THEN ' limit 10' WHEN p_partkey % 9 = 0 THEN ' limit 5 offset 2' WHEN p_partkey % 14 = 1 THEN ' limit 7' ELSE '' END,
                  CASE WHEN p_partkey % 19 = 0 THEN ' UNION ALL SELECT 2' ELSE '' END) AS after_sql""",
    )


def schema_before(t: Tables) -> DataFrame:
    return node_columns(t).selectExpr(
        "node_id", "ordinal", "column_id", "name", "data_type", "coalesce(transform, '') AS expression", "description"
    )


def schema_after(t: Tables) -> DataFrame:
    """Renames, drops, type changes, re-expressions and additions against ``schema_before``."""
    kept = schema_before(t).filter("NOT (node_id % 11 = 0 AND ordinal = 0)")
    changed = kept.selectExpr(
        "node_id",
        "ordinal",
        "CASE WHEN node_id % 7 = 0 AND ordinal = 1 THEN concat(name, '_NEW') ELSE name END AS name",
        "CASE WHEN node_id % 13 = 0 AND ordinal = 2 THEN 'VARCHAR(99)' ELSE lower(data_type) END AS data_type",
        "CASE WHEN node_id % 5 = 0 AND ordinal = 1 THEN 'MIN( X )' WHEN expression = '' THEN 'NULL' ELSE replace(expression, '.', ' . ') END AS expression",
    )
    added = t.part.filter("p_partkey % 3 = 0").selectExpr(
        "p_partkey AS node_id",
        "cast(3 + p_partkey % 6 as int) AS ordinal",
        "'EXTRA' AS name",
        "'VARCHAR' AS data_type",
        "'\"S\".\"NAME\"' AS expression",
    )
    return changed.unionByName(added)


def definitions(t: Tables) -> DataFrame:
    """Node type definitions: many copies of few variants."""
    return t.part.selectExpr(
        "concat(p_type, '-', p_partkey) AS family_dir",
        "p_brand AS package",
        "concat('size ', p_size % 9) AS definition_text",
        "concat('create ', p_type) AS create_text",
        "concat('run ', p_size % 2) AS run_text",
        """CASE p_size % 9 WHEN 8 THEN NULL WHEN 7 THEN array('label', 'tabular') WHEN 6 THEN array('columnSelector', 'textBox')
             ELSE array('textBox', 'toggleButton') END AS primitives""",
    )


# ---- the same rules for the other engine ---------------------------------------------------


def _sql_pick(values: list[str], index: str) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"list_extract([{quoted}], CAST(({index}) % {len(values)} AS INT) + 1)"


SQL = {
    "nodes": f"""SELECT CAST(p_size // 100 AS INT) AS workspace_id, p_partkey AS node_id,
        {_sql_pick(PREFIXES, 'p_size')} || upper(p_type) || '_' || p_partkey AS name,
        {_sql_pick(TYPES, 'p_size')} AS node_type, p_brand AS location,
        CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name END AS description,
        CASE WHEN p_partkey % 6 = 0 THEN 'view' ELSE 'table' END AS materialization,
        p_partkey % 5 AS environment_id FROM part""",
    "edges": """SELECT DISTINCT src, dst FROM (
        SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part
        UNION ALL SELECT p_partkey // 3, p_partkey FROM part
        UNION ALL SELECT (p_partkey // 50) * 50, p_partkey FROM part WHERE p_partkey % 3 = 0) WHERE src <> dst""",
    "node_columns": f"""SELECT CAST(0 AS INT) AS workspace_id, node_id, ordinal, node_id * 10 + ordinal AS column_id,
        {_sql_pick(COLUMN_NAMES, 'ordinal')} AS name, {_sql_pick(COLUMN_TYPES, 'ordinal')} AS data_type,
        CASE WHEN ordinal % 2 = 0 THEN NULL
             WHEN node_id % 7 = 0 THEN 'SUM("S"."AMOUNT")'
             WHEN node_id % 7 = 1 THEN '"S"."' || CASE ordinal WHEN 1 THEN 'CODE' ELSE 'AMOUNT' END || '"'
             WHEN node_id % 7 = 2 THEN 'UPPER("S"."NAME")'
             WHEN node_id % 7 = 3 THEN 'ROW_NUMBER() OVER (ORDER BY "S"."ID")'
             WHEN node_id % 7 = 4 THEN 'MAX("S"."LOAD_TS")'
             WHEN node_id % 7 = 5 THEN 'CASE WHEN 1 = 1 THEN 2 END'
             ELSE 'COALESCE("S"."ID", 0)' END AS transform,
        CASE WHEN (node_id + ordinal) % 3 = 0 THEN NULL ELSE 'text' END AS description,
        (node_id % 5 = 0 AND ordinal = 1) AS is_business_key,
        (node_id % 10 = 0 AND ordinal = 2) AS is_change_tracking
        FROM (SELECT p_partkey AS node_id, CAST(unnest(range(0, 3 + p_partkey % 6)) AS INT) AS ordinal FROM part)""",
    "column_refs": """SELECT a.node_id AS src_node, a.column_id AS src_column, b.node_id AS dst_node, b.column_id AS dst_column
        FROM edges JOIN node_columns a ON a.node_id = src JOIN node_columns b ON b.node_id = dst AND a.ordinal = b.ordinal""",
    "runs": """SELECT o_orderkey AS run_id, o_custkey % 5 AS environment_id,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'canceled' END AS status,
        CASE WHEN o_orderkey % 3 = 0 THEN 'deploy' ELSE 'refresh' END AS run_type, o_orderdate AS start_time,
        CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 HOUR END AS end_time,
        CASE WHEN o_orderkey % 4 = 0 THEN o_custkey END AS job_id,
        CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS nodes_in_run FROM orders""",
    "run_nodes": f"""SELECT run_id, node_id, CASE flag WHEN 'A' THEN 'completed' WHEN 'R' THEN 'Failed' ELSE 'skipped' END AS status,
        CASE WHEN flag = 'R' AND node_id % 9 <> 8 THEN {_sql_pick(ERRORS, 'node_id % 9')} END AS error
        FROM (SELECT l_orderkey AS run_id, l_partkey AS node_id, min(l_returnflag) AS flag FROM lineitem GROUP BY 1, 2)""",
    "subgraphs": "SELECT p_partkey % 10 AS subgraph_id, 'G' || (p_partkey % 10) AS subgraph_name, p_partkey AS node_id FROM part",
    "roles": """SELECT c_custkey % 500 AS user_id,
        CASE c_custkey % 3 WHEN 0 THEN 'org' WHEN 1 THEN 'project' ELSE 'environment' END AS scope,
        CAST(c_nationkey AS BIGINT) AS scope_id, c_mktsegment AS role FROM customer""",
}


def with_sql(*names: str) -> str:
    """``WITH`` clause holding the named catalogue tables and what they build on."""
    need = list(names)
    if "column_refs" in need:
        need = ["edges", "node_columns", *[n for n in need if n not in ("edges", "node_columns")]]
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in dict.fromkeys(need)) + "\n"
