"""Review rules over a whole catalogue. Every rule returns severity, category, node_id, message.

Common inputs: ``nodes`` (workspace_id, node_id, name, node_type), ``edges`` (src, dst), ``columns``
(node_id, column_id, name, transform), ``joins`` (node_id, join_condition), ``refs`` (src_node,
src_column, dst_node, dst_column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import rules
from millrace.functions.names import base_type, non_blank, norm
from millrace.functions.spread import spread
from millrace.operators import graph
from millrace.operators.profile import detect_methodology
from millrace.operators.sets import union_all
from millrace.sources.scratch import Scratch

# Thresholds.
FAN_OUT = 10
DEEP_CHAIN = 8
UNUSED_RATIO = 0.5
UNUSED_COUNT = 5


def _finding(df: DataFrame, severity: str, category: str, message: Column) -> DataFrame:
    return df.select(F.lit(severity).alias("severity"), F.lit(category).alias("category"), "node_id", message.alias("message"))


def _text(*parts: object) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


# ---- what is known of each node, made once for all rules -------------------------------------------


def _degrees(edges: DataFrame) -> DataFrame:
    end = lambda e, succs, preds: F.struct(F.col(e).alias("node_id"), F.lit(succs).alias("succs"), F.lit(preds).alias("preds"))
    ends = edges.select(F.inline(F.array(end("src", 1, 0), end("dst", 0, 1))))
    return ends.groupBy("node_id").agg(F.sum("succs").alias("succs"), F.sum("preds").alias("preds"))


def _column_counts(columns: DataFrame, refs: DataFrame | None) -> DataFrame:
    """Per node: n columns, whether all pass through, and how many no successor refers to by name."""
    through = rules.is_passthrough(F.col("transform"), F.col("name")) if "transform" in columns.columns else F.lit(None).cast("boolean")
    own = columns.select("node_id", "column_id", norm("name").alias("key"), through.alias("passes"))
    unused = F.lit(None).cast("long")
    if refs is not None:
        used = refs.select(F.col("src_node").alias("node_id"), F.col("src_column").alias("column_id")).distinct().join(spread(own), ["node_id", "column_id"])
        own = own.join(spread(used.select("node_id", "key").distinct().withColumn("used", F.lit(1))), ["node_id", "key"], "left")
        unused = F.count_if(F.col("used").isNull())
    return own.groupBy("node_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and("passes").alias("all_pass"), unused.alias("unused"))


def facts(nodes: DataFrame, edges: DataFrame | None = None, columns: DataFrame | None = None, joins: DataFrame | None = None, refs: DataFrame | None = None, methodology: bool = False) -> DataFrame:
    """One row per node with what the rules ask of the inputs given. Nodes known by their columns alone have no ``is_node``."""
    known = [c for c in ("workspace_id", "name", "node_type") if c in nodes.columns]
    out = nodes.select("node_id", *known, F.lit(True).alias("is_node"))
    if {"name", "node_type"} <= set(known):
        out = out.withColumn("layer", rules.layer(F.col("name"), F.col("node_type")))
    if methodology:
        kimball = detect_methodology(nodes).filter("methodology = 'kimball'").select("workspace_id", F.lit(True).alias("kimball"))
        out = out.join(kimball, "workspace_id", "left")
    if edges is not None:
        out = out.join(spread(_degrees(edges)), "node_id", "left").fillna(0, ["succs", "preds"])
    if joins is not None:
        out = out.join(spread(joins.filter(non_blank("join_condition")).select("node_id").distinct().withColumn("joined", F.lit(True))), "node_id", "left")
    if columns is not None:
        out = out.join(spread(_column_counts(columns, refs)), "node_id", "full")
    return out


def _passes() -> tuple:
    hit = F.col("is_node") & (F.col("preds") == 1) & F.col("all_pass") & F.col("joined").isNull()
    return hit, "warning", "redundant_passthrough", _text("all ", F.col("n"), " columns pass through from one predecessor")


def _unjoined() -> tuple:
    hit = F.col("is_node") & (F.col("preds") >= 2) & F.col("joined").isNull()
    return hit, "critical", "missing_join_condition", _text(F.col("preds"), " predecessors but no join condition")


def _fans_out() -> tuple:
    return F.col("is_node") & (F.col("succs") > FAN_OUT), "suggestion", "fan_out_risk", _text(F.col("succs"), " direct dependents")


def _orphaned() -> tuple:
    return F.col("is_node") & (F.col("preds") + F.col("succs") == 0), "warning", "orphan_node", _text("no predecessors and no dependents")


def _mixed_case() -> tuple:
    name = F.col("name")
    hit = F.col("is_node") & name.rlike("[a-z]") & name.rlike("[A-Z]") & ~F.contains(name, F.lit("_"))
    return hit, "suggestion", "naming_inconsistency", _text("mixed case without underscore")


def _unprefixed() -> tuple:
    hit = F.col("kimball") & (F.col("layer") == "mart") & ~F.col("name").rlike("(?i)^(DIM_|DIMENSION_|FACT_|FCT_)")
    return hit, "suggestion", "naming_inconsistency", _text("mart node without DIM_ or FACT_ prefix")


def _wide_view() -> tuple:
    return (F.lower(base_type(F.col("node_type"))) == "view") & (F.col("preds") >= 2), "warning", "type_mismatch", _text("view with several predecessors")


def _early() -> tuple:
    kind = base_type(F.col("node_type"))
    return kind.isin("Dimension", "Fact") & F.col("layer").isin("bronze", "staging"), "warning", "type_mismatch", _text(kind, " in layer ", F.col("layer"))


def _unused() -> tuple:
    unused, n = F.col("unused"), F.col("n")
    hit = (unused < n) & (unused > UNUSED_COUNT) & (unused / n > UNUSED_RATIO)
    return hit, "suggestion", "unused_columns", _text(unused, " of ", n, " columns unused")


def _found(known: DataFrame, *checks: tuple) -> DataFrame:
    """The findings of some rules, in one pass over the facts."""
    rows = [F.when(hit, F.struct(F.lit(severity).alias("severity"), F.lit(category).alias("category"), message.alias("message"))) for hit, severity, category, message in checks]
    return known.select("node_id", F.inline(F.array_compact(F.array(*rows)))).select("severity", "category", "node_id", "message")


# ---- the rules -----------------------------------------------------------------------------------


def redundant_passthrough(nodes: DataFrame, edges: DataFrame, columns: DataFrame, joins: DataFrame) -> DataFrame:
    """One predecessor, at least one column, all passed through, no join condition."""
    return _found(facts(nodes, edges, columns, joins), _passes())


def missing_join_condition(nodes: DataFrame, edges: DataFrame, joins: DataFrame) -> DataFrame:
    """Two predecessors or more and a blank join condition."""
    return _found(facts(nodes, edges, joins=joins), _unjoined())


def layer_violation(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """An edge that skips a layer; one finding per edge."""
    return _skipped(facts(nodes), edges)


def _skipped(known: DataFrame, edges: DataFrame) -> DataFrame:
    layered = known.where("is_node").select("node_id", "name", "layer", rules.layer_rank(F.col("layer")).alias("rank"))
    down = layered.filter("rank > 0").select(F.col("node_id").alias("dst"), F.col("layer").alias("d_layer"), F.col("rank").alias("d_rank"))
    up = layered.filter("rank >= 0").select(F.col("node_id").alias("src"), "name", F.col("layer").alias("s_layer"), F.col("rank").alias("s_rank"))
    hit = edges.join(spread(down), "dst").join(spread(up), "src").filter("d_rank - s_rank > 1").withColumnRenamed("dst", "node_id")
    message = _text(F.col("d_layer"), " node reads ", F.col("name"), " in ", F.col("s_layer"))
    return _finding(hit, "suggestion", "layer_violation", message)


def fan_out_risk(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return _found(facts(nodes, edges), _fans_out())


def orphan_node(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return _found(facts(nodes, edges), _orphaned())


def deep_chain(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    hit = graph.chain_depth(nodes, edges).filter(F.col("chain_depth") >= DEEP_CHAIN)
    return _finding(hit, "suggestion", "deep_chain", _text("end of a chain of ", F.col("chain_depth"), " hops"))


def naming_inconsistency(nodes: DataFrame) -> DataFrame:
    """Mixed case without underscore; a mart node of a Kimball workspace without its prefix."""
    return _found(facts(nodes, methodology=True), _mixed_case(), _unprefixed())


def type_mismatch(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """A view over several sources; a dimension or fact in an early layer."""
    return _found(facts(nodes, edges), _wide_view(), _early())


def unused_columns(columns: DataFrame, refs: DataFrame) -> DataFrame:
    """Nodes more than half of whose columns, and more than five, no successor refers to by name.

    A reference counts for the node it points at; a node nobody refers to is left alone.
    """
    return _found(_column_counts(columns, refs), _unused())


def review(
    nodes: DataFrame,
    edges: DataFrame,
    columns: DataFrame,
    joins: DataFrame,
    refs: DataFrame,
    scope: DataFrame | None = None,
) -> DataFrame:
    """All findings of all rules; ``scope`` (node_id) narrows nodes, edges and columns first."""
    if scope is not None:
        inside = scope.select("node_id").distinct()
        nodes = nodes.join(inside, "node_id", "left_semi")
        columns = columns.join(inside, "node_id", "left_semi")
        edges = edges.join(inside.withColumnRenamed("node_id", "dst"), "dst", "left_semi").select("src", "dst")
        refs = refs.join(inside.withColumnRenamed("node_id", "dst_node"), "dst_node", "left_semi")
    # written, since the layers of the edges' ends are read from it too
    known = Scratch(nodes.sparkSession, "review").write(facts(nodes, edges, columns, joins, refs, methodology=True), "facts")
    checks = [_passes(), _unjoined(), _fans_out(), _orphaned(), _mixed_case(), _unprefixed(), _wide_view(), _early(), _unused()]
    return union_all([_found(known, *checks), _skipped(known, edges), deep_chain(nodes, edges)])


def severity_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severity", "category").agg(F.count(F.lit(1)).alias("n"))
