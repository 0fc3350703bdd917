"""Lineage, review and health queries over the catalogue derived from the supplied tables."""

from pyspark.sql import functions as F

from millrace.functions.spread import spread
from millrace.operators import graph, review, runs, sorting
from millrace.plans import catalogue as c
from millrace.plans.catalogue import AS_OF, with_sql
from millrace.plans.project_queries import LAYER_SQL
from millrace.plans.registry import query
from millrace.plans.source_queries import node_documents
from millrace.sources import catalog
from millrace.sources.scratch import Scratch

# ---- edges ------------------------------------------------------------------------------------

DOC_EDGES = with_sql("edges") + ", known AS (SELECT p_partkey AS k FROM part WHERE p_partkey % 97 <> 5)\n"


def documents(t):
    return catalog.parse_nodes(node_documents(t), "raw")


@query(
    "g1_edges_lineage",
    DOC_EDGES
    + "SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM edges WHERE dst IN (SELECT k FROM known) AND src IN (SELECT k FROM known)",
)
def g1_edges_lineage(t):
    return graph.extract_edges(documents(t), "lineage").select("src", "dst")


@query(
    "g1_edges_health",
    DOC_EDGES
    + "SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM edges WHERE dst IN (SELECT k FROM known) AND src IN (SELECT k FROM known)",
)
def g1_edges_health(t):
    return graph.extract_edges(documents(t), "health").select("src", "dst")


@query(
    "g1_edges_review",
    DOC_EDGES + "SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM edges WHERE dst % 2 = 0 AND dst IN (SELECT k FROM known)",
)
def g1_edges_review(t):
    return graph.extract_edges(documents(t), "review").select("src", "dst")


@query(
    "g1_edges_join",
    DOC_EDGES + "SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM edges WHERE dst IN (SELECT k FROM known)",
)
def g1_edges_join(t):
    nodes = documents(t)
    return graph.extract_edges(nodes, "join", catalog.column_refs(catalog.node_columns(nodes))).select("src", "dst")


@query("g2_column_edges", with_sql("column_refs") + "SELECT DISTINCT src_column, dst_column FROM column_refs")
def g2_column_edges(t):
    return graph.column_edges(c.column_refs(t)).select(F.col("src.p1").alias("src_column"), F.col("dst.p1").alias("dst_column"))


# ---- traversal ----------------------------------------------------------------------------------


def all_roots(t):
    return c.nodes(t).select(F.col("node_id").alias("root"))


def changed(t):
    """The nodes that suppliers stand for, as a table of changed nodes to start from."""
    return t.supplier.select(F.col("s_suppkey").alias("root"))


CHANGED = "(SELECT s_suppkey FROM supplier)"
CLOSURE = """, walk(root, node, depth) AS (SELECT src, dst, 1 FROM edges UNION SELECT root, dst, depth + 1 FROM walk JOIN edges ON node = src),
    reach AS (SELECT root, node, CAST(min(depth) AS INT) AS depth FROM walk WHERE root <> node GROUP BY 1, 2)
"""


@query(
    "g3_upstream",
    with_sql("edges").replace("WITH", "WITH RECURSIVE", 1) + CLOSURE + f"SELECT node AS root, root AS node, depth FROM reach WHERE node IN {CHANGED}",
)
def g3_upstream(t):
    return graph.upstream(c.edges(t), changed(t))


@query("g4_downstream", with_sql("edges").replace("WITH", "WITH RECURSIVE", 1) + CLOSURE + f"SELECT root, node, depth FROM reach WHERE root IN {CHANGED}")
def g4_downstream(t):
    return graph.downstream(c.edges(t), changed(t))


COLUMN_CLOSURE = """, ce AS (SELECT src_column AS src, dst_column AS dst FROM column_refs),
    walk(root, node, depth) AS (SELECT src, dst, 1 FROM ce UNION SELECT root, dst, depth + 1 FROM walk JOIN ce ON node = src),
    reach AS (SELECT root, node, CAST(min(depth) AS INT) AS depth FROM walk GROUP BY 1, 2)
"""
COLUMNS_RECURSIVE = with_sql("column_refs").replace("WITH", "WITH RECURSIVE", 1)


@query(
    "g5_column_lineage",
    COLUMNS_RECURSIVE
    + COLUMN_CLOSURE
    + """SELECT root AS root_column, node AS column_id, 'downstream' AS direction, depth FROM reach WHERE root IN (SELECT column_id FROM node_columns WHERE name = 'IS_CURRENT')
         UNION ALL SELECT node, root, 'upstream', depth FROM reach WHERE node IN (SELECT column_id FROM node_columns WHERE name = 'IS_CURRENT')""",
)
def g5_column_lineage(t):
    columns = c.node_columns(t)
    found = graph.column_lineage(graph.column_edges(c.column_refs(t)), columns.filter("name = 'IS_CURRENT'"), columns)
    return found.select(F.col("root.p1").alias("root_column"), "column_id", "direction", "depth")


@query(
    "g6_impact_columns",
    COLUMNS_RECURSIVE
    + COLUMN_CLOSURE
    + """SELECT root // 10 AS root, node AS column_id, CAST(min(depth) AS INT) AS depth FROM reach
         WHERE root // 10 IN (SELECT p_partkey FROM part WHERE p_size % 8 = 4) GROUP BY 1, 2""",
)
def g6_impact_columns(t):
    roots = c.nodes(t).filter("node_type = 'Dimension'").select(F.col("node_id").alias("root"))
    found = graph.impact_columns(graph.column_edges(c.column_refs(t)), c.node_columns(t), roots)
    return found.select("root", "column_id", "depth")


@query(
    "g6_impact_by_depth",
    with_sql("edges").replace("WITH", "WITH RECURSIVE", 1) + CLOSURE + f"SELECT root, depth, count(*) AS nodes FROM reach WHERE root IN {CHANGED} GROUP BY 1, 2",
)
def g6_impact_by_depth(t):
    return graph.impact_by_depth(graph.impact_nodes(c.edges(t), changed(t)))


@query(
    "g6_impact_summary",
    with_sql("column_refs", "nodes").replace("WITH", "WITH RECURSIVE", 1)
    + CLOSURE
    + """, ce AS (SELECT src_column AS src, dst_column AS dst FROM column_refs),
    cw(root, node) AS (SELECT src // 10, dst FROM ce UNION SELECT root, dst FROM cw JOIN ce ON node = src),
    roots AS (SELECT node_id FROM nodes WHERE node_type = 'Fact'),
    n AS (SELECT root, count(*) AS impacted_nodes, max(depth) AS deepest FROM reach WHERE root IN (SELECT * FROM roots) GROUP BY 1),
    k AS (SELECT root, count(*) AS impacted_columns FROM cw WHERE root IN (SELECT * FROM roots) GROUP BY 1)
    SELECT coalesce(n.root, k.root) AS root, coalesce(impacted_nodes, 0) AS impacted_nodes, coalesce(deepest, 0) AS deepest, coalesce(impacted_columns, 0) AS impacted_columns
    FROM n FULL JOIN k ON n.root = k.root""",
)
def g6_impact_summary(t):
    roots = c.nodes(t).filter("node_type = 'Fact'").select(F.col("node_id").alias("root"))
    nodes_hit = graph.impact_nodes(c.edges(t), roots)
    columns_hit = graph.impact_columns(graph.column_edges(c.column_refs(t)), c.node_columns(t), roots)
    return graph.impact_summary(nodes_hit, columns_hit)


LONGEST = with_sql("edges").replace("WITH", "WITH RECURSIVE", 1) + """, walk(node, dist) AS (SELECT p_partkey, 0 FROM part WHERE p_partkey NOT IN (SELECT dst FROM edges)
    UNION SELECT dst, dist + 1 FROM walk JOIN edges ON node = src), far AS (SELECT node, max(dist) AS dist FROM walk GROUP BY 1)
"""


@query(
    "g7_longest_paths",
    LONGEST
    + """SELECT f.node, CAST(f.dist AS INT) AS dist, min(p.node) AS prev FROM far f LEFT JOIN edges ON dst = f.node LEFT JOIN far p ON p.node = src AND p.dist = f.dist - 1
         GROUP BY 1, 2""",
)
def g7_longest_paths(t):
    e = c.edges(t)
    starts = all_roots(t).join(spread(e.select(F.col("dst").alias("root"))), "root", "left_anti")
    return graph.longest_paths(e, starts.select(F.lit(0).alias("root"), F.col("root").alias("node"))).select("node", "dist", "prev")


@query(
    "g7_critical_path",
    LONGEST
    + """, prev AS (SELECT f.node, f.dist, min(p.node) AS prev FROM far f LEFT JOIN edges ON dst = f.node LEFT JOIN far p ON p.node = src AND p.dist = f.dist - 1 GROUP BY 1, 2),
    back(position, node) AS (SELECT dist, min(node) FROM far WHERE dist = (SELECT max(dist) FROM far) GROUP BY 1
      UNION ALL SELECT position - 1, prev FROM back JOIN prev USING (node) WHERE prev IS NOT NULL)
    SELECT CAST(0 AS BIGINT) AS root, CAST(position AS INT) AS position, node FROM back""",
)
def g7_critical_path(t):
    e = c.edges(t)
    roots = all_roots(t).join(spread(e.select(F.col("dst").alias("root"))), "root", "left_anti")
    return graph.critical_path(e, roots)


CHAIN = with_sql("edges", "nodes").replace("WITH", "WITH RECURSIVE", 1) + """, up AS (SELECT dst, max(src) AS src FROM edges GROUP BY 1),
    chain(node_id, at_, depth) AS (SELECT node_id, node_id, 0 FROM nodes UNION ALL SELECT node_id, src, depth + 1 FROM chain JOIN up ON dst = at_),
    deep AS (SELECT node_id, CAST(max(depth) AS INT) AS chain_depth FROM chain GROUP BY 1)
"""


@query("g8_chain_depth", CHAIN + "SELECT node_id, chain_depth FROM deep")
def g8_chain_depth(t):
    return graph.chain_depth(c.nodes(t), c.edges(t))


def workspace_files(t):
    """Node documents of two workspaces that share node ids, as files of lines. B lists predecessors the other way round and lacks
    some nodes; nodes with odd ids list their predecessors in an object-shaped source mapping."""
    ups = c.edges(t).groupBy(F.col("dst").alias("node_id")).agg(F.sort_array(F.collect_set("src")).alias("ups"))
    nodes = c.nodes(t).select("node_id", "name", "node_type").join(ups, "node_id", "left")
    folder = Scratch(t.spark, "files").path
    for ws, order in (("A", F.col("ups")), ("B", F.reverse("ups"))):
        own = nodes.where("node_id % 5 <> 0") if ws == "B" else nodes
        listed = F.transform(order, lambda u: u.cast("string"))
        even = F.col("node_id") % 2 == 0
        mapping = F.struct(F.struct(F.transform(F.when(~even, listed), lambda u: F.struct(u.alias("nodeID"))).alias("sources")).alias("sourceMapping"))
        doc = F.struct(F.lit(ws).alias("workspaceID"), F.col("node_id").cast("string").alias("id"), "name", F.col("node_type").alias("nodeType"), F.when(even, listed).alias("predecessorNodeIDs"), mapping.alias("metadata"))
        own.select(F.to_json(doc)).write.mode("append").text(folder)
    return folder


@query(
    "g8_chains_of_files",
    with_sql("edges").replace("WITH", "WITH RECURSIVE", 1)
    + """, n AS (SELECT 'A' AS ws, p_partkey AS node FROM part UNION ALL SELECT 'B', p_partkey FROM part WHERE p_partkey % 5 <> 0),
    f AS (SELECT 'A' AS ws, dst AS node, min(src) AS up FROM edges GROUP BY 2 UNION ALL SELECT 'B', dst, max(src) FROM edges GROUP BY 2),
    walk(ws, node, here, d) AS (SELECT ws, node, node, 0 FROM n UNION ALL
      SELECT walk.ws, walk.node, f.up, d + 1 FROM walk JOIN n ON n.ws = walk.ws AND n.node = walk.here JOIN f ON f.ws = walk.ws AND f.node = walk.here)
    SELECT ws AS workspace_id, CAST(node AS VARCHAR) AS node_id, max(d) AS chain_depth FROM walk GROUP BY 1, 2""",
)
def g8_chains_of_files(t):
    """First predecessors by their place in the list, from files, for workspaces that share node ids."""
    vertex = lambda node: F.struct(F.col("workspaceID").alias("workspace_id"), node.alias("node_id"))
    nodes = catalog.read_nodes(t.spark, workspace_files(t))
    edges = graph.extract_edges(nodes, "review").select(*[vertex(F.col(e)).alias(e) for e in ("src", "dst")], "pos")
    found = graph.chain_depth(nodes.select(vertex(F.col("id")).alias("node_id")), edges)
    return found.select("node_id.workspace_id", "node_id.node_id", "chain_depth")


@query(
    "g9_graph_stats",
    LONGEST
    + """SELECT CAST(0 AS INT) AS workspace_id, (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT dst FROM edges)) AS root_nodes,
         (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT src FROM edges)) AS leaf_nodes,
         round((SELECT count(*) FROM edges) / (SELECT count(*) FROM part), 1) AS avg_fan_out, (SELECT CAST(max(dist) AS INT) FROM far) AS max_depth""",
)
def g9_graph_stats(t):
    return graph.graph_stats(c.nodes(t), c.edges(t))


@query(
    "g10_propagate_change",
    COLUMNS_RECURSIVE
    + COLUMN_CLOSURE
    + """, ch AS (SELECT column_id FROM node_columns WHERE name = 'END_DATE'),
    hit AS (SELECT node AS column_id, arg_min(root, depth * 10000000000 + root) AS root FROM reach WHERE root IN (SELECT column_id FROM ch) GROUP BY 1)
    SELECT k.column_id, CASE WHEN h.root IS NOT NULL THEN 'CLOSED_' || h.root ELSE name END AS name,
      CASE WHEN h.root % 20 >= 10 THEN 'TIMESTAMP' ELSE data_type END AS data_type, h.root IS NOT NULL AS changed FROM node_columns k LEFT JOIN hit h USING (column_id)""",
)
def g10_propagate_change(t):
    columns = c.node_columns(t)
    changes = columns.filter("name = 'END_DATE'").selectExpr(
        "node_id", "column_id", "concat('CLOSED_', column_id) AS new_name", "CASE WHEN column_id % 20 >= 10 THEN 'TIMESTAMP' END AS new_type"
    )
    after, _ = graph.propagate_column_change(columns, graph.column_edges(c.column_refs(t)), changes)
    return after.select("column_id", "name", "data_type", "changed")


@query(
    "g10_before_image",
    COLUMNS_RECURSIVE
    + COLUMN_CLOSURE
    + "SELECT column_id, name, data_type FROM node_columns WHERE column_id IN (SELECT node FROM reach WHERE root IN (SELECT column_id FROM node_columns WHERE name = 'END_DATE'))",
)
def g10_before_image(t):
    columns = c.node_columns(t)
    changes = columns.filter("name = 'END_DATE'").selectExpr("node_id", "column_id", "'X' AS new_name", "string(null) AS new_type")
    _, before = graph.propagate_column_change(columns, graph.column_edges(c.column_refs(t)), changes)
    return before.select("column_id", "name", "data_type")


def expression_columns(t):
    """Two predecessors per node, and expressions that use none, one or both of them."""
    return t.part.selectExpr(
        "p_partkey AS node_id",
        "p_partkey AS column_id",
        "CASE WHEN p_partkey % 5 = 0 THEN 'id' ELSE 'AMOUNT' END AS name",
        """CASE p_partkey % 8
             WHEN 0 THEN '"A"."ID"' WHEN 1 THEN 'CAST(b.code AS INT)' WHEN 2 THEN 'COALESCE("A"."ID", B.CODE)'
             WHEN 3 THEN 'code' WHEN 4 THEN 'UPPER(''A.ID'')' WHEN 5 THEN 'A.NOPE + B.NOPE2' WHEN 6 THEN '42' ELSE 'A.LOAD_TS || B.NONE' END AS transform""",
    )


@query(
    "g11_infer_column_refs",
    with_sql("node_columns")
    + """, x AS (SELECT p_partkey AS k, p_partkey % 8 AS m, CASE WHEN p_partkey % 5 = 0 THEN 'ID' ELSE 'AMOUNT' END AS own, p_partkey // 2 AS a, p_partkey // 3 AS b FROM part),
    w AS (SELECT *, CASE m WHEN 0 THEN 'ID' WHEN 1 THEN 'CODE' WHEN 3 THEN 'CODE' ELSE own END AS want, CASE m WHEN 1 THEN 2 ELSE 1 END AS target FROM x),
    cand AS (SELECT k, m, c.node_id, c.column_id, CASE WHEN p.pos = w.target THEN 0 ELSE 1 END AS off, p.pos, CASE WHEN c.name = w.want THEN 0 ELSE 1 END AS no
      FROM w, LATERAL (SELECT 1 AS pos, w.a AS src UNION ALL SELECT 2, w.b) p JOIN node_columns c ON c.node_id = p.src AND c.name IN (w.want, w.own)),
    single AS (SELECT k, node_id, column_id FROM cand QUALIFY row_number() OVER (PARTITION BY k ORDER BY off, pos, no) = 1),
    multi AS (SELECT k, 1 AS pos, a AS src, CASE m WHEN 2 THEN 'ID' WHEN 5 THEN 'NOPE' ELSE 'LOAD_TS' END AS col FROM x WHERE m IN (2, 5, 7)
      UNION ALL SELECT k, 2, b, CASE m WHEN 2 THEN 'CODE' WHEN 5 THEN 'NOPE2' ELSE 'NONE' END FROM x WHERE m IN (2, 5, 7)),
    mh AS (SELECT k, c.node_id, c.column_id, count(*) OVER (PARTITION BY k) AS n FROM multi JOIN node_columns c ON c.node_id = src AND c.name = col WHERE k NOT IN (SELECT k FROM single))
    SELECT k AS column_id, node_id AS src_node, column_id AS src_column, 'single' AS strategy FROM single
    UNION ALL SELECT k, node_id, column_id, CASE WHEN n = 2 THEN 'multi' ELSE 'partial' END FROM mh""",
)
def g11_infer_column_refs(t):
    aliases = t.part.selectExpr(
        "p_partkey AS node_id",
        "inline(array(struct(1 AS pos, 'a' AS alias, p_partkey div 2 AS src_node), struct(2 AS pos, 'B' AS alias, p_partkey div 3 AS src_node)))",
    )
    found = graph.infer_column_refs(expression_columns(t), aliases, c.node_columns(t))
    return found.select("column_id", "src_node", "src_column", "strategy")


@query(
    "g12_refs_from_sql",
    """SELECT DISTINCT p_partkey AS node_id, 'L' || (p_partkey % 3) AS location, upper(p_type) AS name FROM part
       UNION SELECT p_partkey, 'L' || (p_partkey % 5), 'T' || (p_partkey % 9) FROM part WHERE p_partkey % 2 = 0""",
)
def g12_refs_from_sql(t):
    return graph.refs_from_sql(c.sql_corpus(t), "before_sql")


@query(
    "g13_preserve_lineage",
    with_sql("node_columns")
    + """SELECT column_id, CASE WHEN column_id % 4 = 0 THEN 'own' WHEN column_id % 3 = 0 THEN '' ELSE 'old' || column_id END AS refs FROM node_columns""",
)
def g13_preserve_lineage(t):
    own = "CASE WHEN column_id % 4 = 0 THEN array('own') WHEN column_id % 2 = 0 THEN cast(array() as array<string>) END AS refs"
    old = "CASE WHEN column_id % 3 = 0 THEN cast(array() as array<string>) ELSE array(concat('old', column_id)) END AS refs"
    columns = c.node_columns(t)
    kept = graph.preserve_lineage(
        columns.selectExpr("node_id", "column_id", "lower(name) AS name", own), columns.selectExpr("node_id", "name", old)
    )
    return kept.select("column_id", F.coalesce(F.array_join("refs", ","), F.lit("")).alias("refs"))


# ---- review -------------------------------------------------------------------------------------

JOINS_SQL = ", joins AS (SELECT p_partkey AS node_id, CASE WHEN p_partkey % 3 = 1 THEN 'ON 1 = 1' WHEN p_partkey % 3 = 2 THEN '  ' END AS join_condition FROM part)\n"
NODES_EDGES = with_sql("nodes", "edges")


def join_conditions(t):
    return t.part.selectExpr(
        "p_partkey AS node_id", "CASE WHEN p_partkey % 3 = 1 THEN 'ON 1 = 1' WHEN p_partkey % 3 = 2 THEN '  ' END AS join_condition"
    )


R1 = """SELECT 'warning' AS severity, 'redundant_passthrough' AS category, node_id, 'all ' || count(*) || ' columns pass through from one predecessor' AS message FROM node_columns
    WHERE node_id IN (SELECT dst FROM edges GROUP BY 1 HAVING count(*) = 1) AND node_id NOT IN (SELECT node_id FROM joins WHERE trim(join_condition) <> '') GROUP BY node_id
    HAVING bool_and(transform IS NULL OR regexp_extract(transform, '^"[^"]+"\\."([^"]+)"$', 1) = name)"""
R2 = """SELECT 'critical' AS severity, 'missing_join_condition' AS category, dst AS node_id, count(*) || ' predecessors but no join condition' AS message FROM edges
    WHERE dst NOT IN (SELECT node_id FROM joins WHERE trim(join_condition) <> '') GROUP BY dst HAVING count(*) >= 2"""
LAYERED = f""", lay AS (SELECT node_id, name, node_type, {LAYER_SQL} AS layer FROM nodes),
    rk AS (SELECT *, CASE layer WHEN 'bronze' THEN 0 WHEN 'staging' THEN 1 WHEN 'intermediate' THEN 2 WHEN 'mart' THEN 3 ELSE -1 END AS r FROM lay)
"""
R3 = """SELECT 'suggestion' AS severity, 'layer_violation' AS category, d.node_id, d.layer || ' node reads ' || s.name || ' in ' || s.layer AS message
    FROM edges JOIN rk d ON d.node_id = dst JOIN rk s ON s.node_id = src WHERE d.r > 0 AND s.r >= 0 AND d.r - s.r > 1"""
R4 = """SELECT 'suggestion' AS severity, 'fan_out_risk' AS category, src AS node_id, count(*) || ' direct dependents' AS message FROM edges GROUP BY src HAVING count(*) > 10"""
R5 = """SELECT 'warning' AS severity, 'orphan_node' AS category, node_id, 'no predecessors and no dependents' AS message FROM nodes
    WHERE node_id NOT IN (SELECT src FROM edges) AND node_id NOT IN (SELECT dst FROM edges)"""
R6 = """SELECT 'suggestion' AS severity, 'deep_chain' AS category, node_id, 'end of a chain of ' || chain_depth || ' hops' AS message FROM deep WHERE chain_depth >= 8"""
R7 = """SELECT 'suggestion' AS severity, 'naming_inconsistency' AS category, node_id, 'mart node without DIM_ or FACT_ prefix' AS message FROM lay
    WHERE layer = 'mart' AND NOT regexp_matches(name, '^(DIM_|DIMENSION_|FACT_|FCT_)')"""
R8 = """SELECT 'warning' AS severity, 'type_mismatch' AS category, node_id, 'view with several predecessors' AS message FROM nodes
      WHERE node_type = 'View' AND node_id IN (SELECT dst FROM edges GROUP BY 1 HAVING count(*) >= 2)
    UNION ALL SELECT 'warning', 'type_mismatch', node_id, regexp_replace(node_type, '.*:::', '') || ' in layer ' || layer FROM lay
      WHERE regexp_replace(node_type, '.*:::', '') IN ('Dimension', 'Fact') AND layer IN ('bronze', 'staging')"""
R9 = """SELECT 'suggestion' AS severity, 'unused_columns' AS category, node_id, unused || ' of ' || n || ' columns unused' AS message FROM (
      SELECT k.node_id, count(*) AS n, count(*) FILTER (u.src_column IS NULL) AS unused FROM wide k LEFT JOIN (SELECT DISTINCT src_column FROM narrow) u ON u.src_column = k.column_id GROUP BY 1)
    WHERE unused > 5 AND unused < n AND unused / n > 0.5"""
WIDE_SQL = """, wide AS (SELECT node_id, column_id, name FROM node_columns UNION ALL SELECT p_partkey, p_partkey * 10 + 8 + unnest(range(0, 2)), 'W' || unnest(range(0, 2)) FROM part),
    narrow AS (SELECT r.* FROM column_refs r JOIN node_columns n ON n.column_id = r.src_column AND n.name IN ('ID', 'CODE'))
"""


def wide_columns(t):
    """Two more columns per node that nothing refers to."""
    more = t.part.selectExpr("p_partkey AS node_id", "explode(array(0, 1)) AS i").selectExpr(
        "node_id", "node_id * 10 + 8 + i AS column_id", "concat('W', i) AS name", "string(null) AS transform"
    )
    return c.node_columns(t).select("node_id", "column_id", "name", "transform").unionByName(more)


def narrow_refs(t):
    """References to identifiers and codes only."""
    read = c.node_columns(t).filter("name IN ('ID', 'CODE')").selectExpr("column_id AS src_column")
    return c.column_refs(t).join(spread(read), "src_column", "left_semi")


@query(
    "r1_redundant_passthrough",
    with_sql("nodes", "node_columns") + ", edges AS (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part)\n" + JOINS_SQL + R1,
)
def r1_redundant_passthrough(t):
    tree = t.part.selectExpr("p_partkey div 2 AS src", "p_partkey AS dst")
    return review.redundant_passthrough(c.nodes(t), tree, c.node_columns(t), join_conditions(t))


@query("r2_missing_join_condition", NODES_EDGES + JOINS_SQL + R2)
def r2_missing_join_condition(t):
    return review.missing_join_condition(c.nodes(t), c.edges(t), join_conditions(t))


@query("r3_layer_violation", NODES_EDGES + LAYERED + R3)
def r3_layer_violation(t):
    return review.layer_violation(c.nodes(t), c.edges(t))


@query("r4_fan_out_risk", NODES_EDGES + R4)
def r4_fan_out_risk(t):
    return review.fan_out_risk(c.nodes(t), c.edges(t))


@query("r5_orphan_node", with_sql("nodes") + ", edges AS (SELECT o_custkey AS src, o_orderkey AS dst FROM orders WHERE o_orderstatus = 'F')\n" + R5)
def r5_orphan_node(t):
    links = t.orders.filter("o_orderstatus = 'F'").selectExpr("o_custkey AS src", "o_orderkey AS dst")
    return review.orphan_node(c.nodes(t), links)


@query("r6_deep_chain", CHAIN + R6)
def r6_deep_chain(t):
    return review.deep_chain(c.nodes(t), c.edges(t))


@query("r7_naming_inconsistency", with_sql("nodes") + LAYERED + R7)
def r7_naming_inconsistency(t):
    return review.naming_inconsistency(c.nodes(t))


@query("r8_type_mismatch", NODES_EDGES + LAYERED + R8)
def r8_type_mismatch(t):
    return review.type_mismatch(c.nodes(t), c.edges(t))


@query("r9_unused_columns", with_sql("column_refs") + WIDE_SQL + R9)
def r9_unused_columns(t):
    return review.unused_columns(wide_columns(t), narrow_refs(t))


# All rules over one catalogue; the first rule looks at the widened columns too.
WIDE_TRANSFORMS = ", wide_t AS (SELECT node_id, name, transform FROM node_columns UNION ALL SELECT p_partkey, 'W' || unnest(range(0, 2)), NULL FROM part)\n"
REVIEW_WITH = (
    CHAIN.replace("WITH RECURSIVE", "WITH RECURSIVE node_columns AS (" + c.SQL["node_columns"] + "),\n", 1)
    + ", column_refs AS ("
    + c.SQL["column_refs"]
    + ")\n"
    + JOINS_SQL
    + LAYERED
    + WIDE_SQL
    + WIDE_TRANSFORMS
)
REVIEW = " UNION ALL ".join(f"({r})" for r in (R1.replace("FROM node_columns", "FROM wide_t"), R2, R3, R4, R5, R6, R7, R8, R9))


def review_all(t):
    return review.review(c.nodes(t), c.edges(t), wide_columns(t), join_conditions(t), narrow_refs(t))


@query("r10_severity_counts", REVIEW_WITH + f"SELECT severity, category, count(*) AS n FROM ({REVIEW}) GROUP BY 1, 2")
def r10_severity_counts(t):
    return review.severity_counts(review_all(t))


@query("r10_review", REVIEW_WITH + REVIEW)
def r10_review(t):
    return sorting.severity_sort(review_all(t))


# ---- runs and health ------------------------------------------------------------------------------


def raw_results(t):
    """Results as the three shapes of JSON text a service may give, one page per result."""
    item = F.struct(
        F.when(F.col("node_id") % 5 != 0, F.col("node_id").cast("string")).alias("nodeID"),
        F.when(F.col("node_id") % 3 == 0, F.col("status")).alias("status"),
        F.when(F.col("node_id") % 3 == 1, F.col("status")).alias("nodeStatus"),
        F.when(F.col("node_id") % 2 == 0, F.col("error")).alias("failureMessage"),
        F.when(F.col("node_id") % 2 == 1, F.struct(F.col("error").alias("message"))).alias("error"),
    )
    items = c.run_nodes(t).select("run_id", F.to_json(F.array(item)).alias("j"))
    text = "CASE run_id % 3 WHEN 0 THEN j WHEN 1 THEN concat('{\"data\":', j, '}') ELSE concat('{\"results\":', j, ',\"data\":{}}') END AS results"
    return items.selectExpr("run_id", text)


@query(
    "e1_normalise_results",
    with_sql("run_nodes")
    + """SELECT run_id, CASE WHEN node_id % 5 <> 0 THEN CAST(node_id AS VARCHAR) ELSE 'unknown' END AS node_id, CASE WHEN node_id % 3 < 2 THEN status ELSE 'unknown' END AS status, error FROM run_nodes""",
)
def e1_normalise_results(t):
    return runs.normalise_run_results(raw_results(t)).select("run_id", "node_id", "status", "error")


@query(
    "e2_bucket_status",
    with_sql("run_nodes")
    + "SELECT CASE status WHEN 'completed' THEN 'succeeded' WHEN 'Failed' THEN 'failed' ELSE status END AS bucket, count(*) AS n FROM run_nodes GROUP BY 1",
)
def e2_bucket_status(t):
    return runs.bucket_status(c.run_nodes(t)).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


CATEGORY_SQL = """CASE node_id % 9 % 8 WHEN 0 THEN 'sql_error' WHEN 1 THEN 'reference_error' WHEN 2 THEN 'permission_error' WHEN 3 THEN 'data_type_error'
    WHEN 4 THEN 'timeout' WHEN 5 THEN 'configuration_error' WHEN 6 THEN 'missing_object' ELSE 'unknown' END"""


@query(
    "e3_classify_errors",
    with_sql("run_nodes")
    + f"""SELECT run_id, node_id, CASE WHEN error IS NULL THEN 'unknown' ELSE {CATEGORY_SQL} END AS category,
          CASE WHEN error IS NULL THEN 0 ELSE 1 END AS n_fixes FROM run_nodes WHERE status = 'Failed'""",
)
def e3_classify_errors(t):
    return runs.classify_errors(c.run_nodes(t)).select("run_id", "node_id", "category", F.size("fixes").alias("n_fixes"))


@query(
    "e4_diagnose_runs",
    with_sql("runs", "run_nodes")
    + f""", k AS (SELECT run_id, status, CASE WHEN status = 'Failed' THEN CASE WHEN error IS NULL THEN 'unknown' ELSE {CATEGORY_SQL} END END AS cat FROM run_nodes),
    a AS (SELECT run_id, count(*) AS total, count(*) FILTER (status = 'completed') AS ok, count(*) FILTER (status = 'Failed') AS bad, count(*) FILTER (status = 'skipped') AS skip,
      count(*) FILTER (cat = 'permission_error') AS p, count(*) FILTER (cat IN ('reference_error', 'missing_object')) AS r, count(*) FILTER (cat = 'sql_error') AS s,
      count(*) FILTER (cat = 'data_type_error') AS d, count(*) FILTER (cat = 'timeout') AS t, count(*) FILTER (cat = 'configuration_error') AS g, count(*) FILTER (cat = 'unknown') AS u FROM k GROUP BY 1),
    b AS (SELECT r.run_id, r.status AS run_status, coalesce(total, 0) AS total, coalesce(ok, 0) AS succeeded, coalesce(bad, 0) AS failed, coalesce(skip, 0) AS skipped, p, a.r, s, d, t, g, u FROM runs r LEFT JOIN a ON a.run_id = r.run_id)
    SELECT run_id, run_status, total, succeeded, failed, skipped, total > 0 AND failed / nullif(total, 0) > 0.5 AS over_half_failed,
      CASE WHEN run_status = 'canceled' THEN 'retry_if_unintended' WHEN failed = 0 AND run_status = 'completed' THEN 'nothing_to_do' WHEN failed = 0 THEN 'suspect_system_failure'
      ELSE concat_ws(',', CASE WHEN p > 0 THEN 'fix_permissions' END, CASE WHEN r > 0 THEN 'deploy_missing_objects' END, CASE WHEN s > 0 THEN 'fix_sql' END, CASE WHEN d > 0 THEN 'fix_types' END,
        CASE WHEN t > 0 THEN 'reduce_work_or_scale_up' END, CASE WHEN g > 0 THEN 'fix_settings' END, CASE WHEN u > 0 THEN 'read_full_errors' END,
        CASE WHEN failed > 0 AND s = 0 AND g = 0 THEN 'retry_failed_nodes' END, CASE WHEN failed / total > 0.5 THEN 'suspect_systemic_cause' END) END AS advice FROM b""",
)
def e4_diagnose_runs(t):
    found = runs.diagnose_runs(c.runs(t), c.run_nodes(t))
    return found.select(
        "run_id", "run_status", "total", "succeeded", "failed", "skipped", "over_half_failed", F.array_join("recommendations", ",").alias("advice")
    )


RUNS_SQL = with_sql("runs", "run_nodes", "nodes", "edges") + """, sizes AS (SELECT environment_id, count(*) AS n FROM nodes GROUP BY 1),
    rs AS (SELECT r.* REPLACE (CASE WHEN nodes_in_run IS NOT NULL THEN n END AS nodes_in_run) FROM runs r LEFT JOIN sizes s ON s.environment_id = r.environment_id),
    ls AS (SELECT DISTINCT run_id, node_id FROM run_nodes),
    done AS (SELECT *, coalesce(end_time, start_time) AS run_time FROM rs WHERE status IN ('completed', 'failed', 'canceled')),
    exp AS (SELECT d.environment_id, d.run_id, d.status, run_time, node_id FROM done d JOIN ls ON ls.run_id = d.run_id),
    whole AS (SELECT d.environment_id, d.run_id, d.status, run_time FROM done d JOIN sizes s ON s.environment_id = d.environment_id
      WHERE job_id IS NULL AND nodes_in_run = s.n AND d.run_id NOT IN (SELECT run_id FROM ls)),
    every AS (SELECT * FROM exp UNION ALL SELECT w.*, n.node_id FROM whole w JOIN nodes n ON n.environment_id = w.environment_id),
    live AS (SELECT e.* FROM every e JOIN nodes n ON n.node_id = e.node_id AND n.environment_id = e.environment_id WHERE status <> 'canceled'
      QUALIFY row_number() OVER (PARTITION BY e.environment_id, e.node_id ORDER BY run_time DESC, run_id DESC) = 1),
    lst AS (SELECT n.environment_id, n.node_id, CASE WHEN l.status IS NULL THEN 'never_run' WHEN l.status = 'completed' THEN 'passed' ELSE 'failed' END AS last_status, run_time AS last_time
      FROM nodes n LEFT JOIN live l ON l.node_id = n.node_id)
"""


def health_inputs(t):
    """Runs, results and nodes; a run without results may cover its whole environment."""
    env_nodes = c.nodes(t).select("environment_id", "node_id")
    sizes = env_nodes.groupBy("environment_id").agg(F.count(F.lit(1)).alias("n"))
    full = F.when(F.col("nodes_in_run").isNotNull(), F.col("n"))
    rs = c.runs(t).join(sizes, "environment_id", "left").withColumn("nodes_in_run", full).drop("n")
    return rs, c.run_nodes(t), env_nodes


@query("e5_attribute_runs", RUNS_SQL + "SELECT environment_id, run_id, status, node_id FROM exp UNION ALL SELECT environment_id, run_id, status, NULL FROM whole")
def e5_attribute_runs(t):
    explicit, whole = runs.attribute_runs(*health_inputs(t))
    rows = explicit.select("environment_id", "run_id", "status", "node_id")
    return rows.unionByName(whole.select("environment_id", "run_id", "status"), allowMissingColumns=True)


@query("e6_node_last_status", RUNS_SQL + "SELECT environment_id, node_id, last_status, last_time FROM lst")
def e6_node_last_status(t):
    return runs.node_last_status(*health_inputs(t))


@query("e7_failed_runs", with_sql("runs") + f"SELECT run_id, environment_id, start_time FROM runs WHERE status = 'failed' AND start_time >= TIMESTAMP '{AS_OF}' - INTERVAL 72 HOUR")
def e7_failed_runs(t):
    return runs.failed_runs(c.runs(t), AS_OF, 72).select("run_id", "environment_id", "start_time")


@query(
    "e8_stale_nodes",
    RUNS_SQL
    + f"""SELECT node_id, last_status, CAST(floor(date_diff('second', last_time, TIMESTAMP '{AS_OF}') / 86400) AS BIGINT) AS days_since FROM lst
          WHERE last_status = 'never_run' OR last_time < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""",
)
def e8_stale_nodes(t):
    return runs.stale_nodes(runs.node_last_status(*health_inputs(t)), AS_OF).select("node_id", "last_status", "days_since")


HEALTH_LINKS = """, links AS (SELECT a.environment_id, e.src, e.dst FROM edges e JOIN nodes a ON a.node_id = e.src JOIN nodes b ON b.node_id = e.dst AND a.environment_id = b.environment_id),
    alone AS (SELECT environment_id, node_id FROM nodes WHERE node_id NOT IN (SELECT src FROM links) AND node_id NOT IN (SELECT dst FROM edges))
"""


@query(
    "e9_dependency_health",
    NODES_EDGES
    + HEALTH_LINKS
    + """SELECT n.environment_id, (SELECT count(*) FROM links l WHERE l.environment_id = n.environment_id) AS edges,
         (SELECT count(*) FROM alone a WHERE a.environment_id = n.environment_id) AS orphans FROM (SELECT DISTINCT environment_id FROM nodes) n""",
)
def e9_dependency_health(t):
    env_nodes = c.nodes(t).select("environment_id", "node_id")
    orphans, links = runs.dependency_health(env_nodes, c.edges(t))
    alone = orphans.groupBy("environment_id").agg(F.count(F.lit(1)).alias("orphans"))
    return env_nodes.select("environment_id").distinct().join(links, "environment_id", "left").join(alone, "environment_id", "left").fillna(0)


@query(
    "e10_environment_health",
    RUNS_SQL
    + HEALTH_LINKS
    + f""", m AS (SELECT e.environment_id, (SELECT count(*) FROM lst WHERE lst.environment_id = e.environment_id) AS nodes,
      (SELECT count(*) FROM lst WHERE lst.environment_id = e.environment_id AND last_status = 'failed') AS failed_nodes,
      (SELECT count(*) FROM lst WHERE lst.environment_id = e.environment_id AND last_status = 'never_run') AS never_run,
      (SELECT count(*) FROM lst WHERE lst.environment_id = e.environment_id AND (last_status = 'never_run' OR last_time < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY)) AS stale,
      (SELECT count(*) FROM rs WHERE rs.environment_id = e.environment_id AND status = 'failed' AND start_time >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR) AS failed_runs,
      (SELECT count(*) FROM alone a WHERE a.environment_id = e.environment_id) AS orphans
      FROM (SELECT CAST(n_nationkey AS BIGINT) AS environment_id FROM nation) e)
    SELECT environment_id, nodes, failed_nodes, never_run, stale, failed_runs, orphans,
      CASE WHEN nodes = 0 THEN 'warning' WHEN failed_runs >= 3 OR failed_nodes > nodes * 0.5 THEN 'critical' WHEN failed_runs + stale + orphans + never_run > 0 THEN 'warning' ELSE 'healthy' END AS score,
      CASE WHEN nodes = 0 THEN 'no_nodes' ELSE concat_ws(',', CASE WHEN failed_runs > 0 THEN 'failed_runs' END, CASE WHEN failed_nodes > 0 THEN 'failed_nodes' END, CASE WHEN stale > 0 THEN 'stale' END,
        CASE WHEN orphans > 0 THEN 'orphans' END, CASE WHEN never_run > 0 THEN 'never_run' END) END AS reasons FROM m""",
)
def e10_environment_health(t):
    rs, results, env_nodes = health_inputs(t)
    environments = t.nation.selectExpr("cast(n_nationkey as bigint) AS environment_id")
    found = runs.environment_health(environments, env_nodes, rs, results, c.edges(t), AS_OF)
    return found.select(
        "environment_id", "nodes", "failed_nodes", "never_run", "stale", "failed_runs", "orphans", "score", F.array_join("reasons", ",").alias("reasons")
    )


def status_events(t):
    return t.events.selectExpr(
        "user_id AS run_id",
        "ts",
        "event_id",
        "CASE event_type WHEN 'signup' THEN 'waitingToRun' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'odd' END AS status",
    )


STATUS_SQL = """CASE event_type WHEN 'signup' THEN 'waitingToRun' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'odd' END"""


@query(
    "e11_latest_run_status",
    f"""SELECT run_id, status, status IN ('completed', 'failed', 'canceled') AS terminal FROM (SELECT user_id AS run_id, ts, event_id, {STATUS_SQL} AS status FROM events)
        WHERE status <> 'odd' QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, event_id) = 1""",
)
def e11_latest_run_status(t):
    return runs.latest_run_status(status_events(t))[0].select("run_id", "status", "terminal")


@query("e11_rejected_status", "SELECT event_id FROM events WHERE event_type = 'click'")
def e11_rejected_status(t):
    return runs.latest_run_status(status_events(t))[1].select("event_id")


@query(
    "t4_severity_sort",
    NODES_EDGES + JOINS_SQL + LAYERED + f"({R2}) UNION ALL ({R8})",
)
def t4_severity_sort(t):
    found = review.missing_join_condition(c.nodes(t), c.edges(t), join_conditions(t)).unionByName(review.type_mismatch(c.nodes(t), c.edges(t)))
    return sorting.severity_sort(found)
