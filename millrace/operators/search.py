"""Finding nodes by their text and finding type variants by their features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators import textindex

FIELDS = ["name", "nodeType", "sql", "description", "config", "columnName", "columnDataType"]
SNIPPET_SIDE = 60


def snippet(text: Column, query: str | Column, at: Column | None = None, length: Column | None = None) -> Column:
    """The hit with 60 characters on each side; an ellipsis marks a cut. ``at`` and ``length`` of the text, if they are known."""
    query = F.lit(query) if isinstance(query, str) else query
    at = F.instr(F.lower(text), F.lower(query)) if at is None else at
    length = F.length(text) if length is None else length
    start = F.greatest(at - SNIPPET_SIDE, F.lit(1))
    end = F.least(at - 1 + F.length(query) + SNIPPET_SIDE, length)
    body = F.substring(text, start, end - start + 1)
    head = F.when(start > 1, "…").otherwise("")
    tail = F.when(end < length, "…").otherwise("")
    return F.concat(head, body, tail)


def _cells(wanted: list[str]) -> tuple[list[Column], list[Column]]:
    """The searched fields of a node and of a column, as structs with their texts."""
    sources = {"name": "name", "nodeType": "node_type", "sql": "sql", "description": "description", "config": "config"}
    node_cells = [
        F.struct(
            F.lit(FIELDS.index(f)).alias("field_order"),
            F.lit(0).alias("ordinal"),
            F.lit(f).alias("field"),
            F.lit(None).cast("string").alias("column_name"),
            F.col(src).alias("text"),
            F.lit(f in ("name", "nodeType")).alias("whole"),
        )
        for f, src in sources.items()
        if f in wanted
    ]
    column_cells = [
        F.struct(
            F.lit(FIELDS.index(f)).alias("field_order"),
            F.col("ordinal").cast("int").alias("ordinal"),
            F.lit(f).alias("field"),
            F.col("name").alias("column_name"),
            F.col(src).alias("text"),
            F.lit(True).alias("whole"),
        )
        for f, src in {"columnName": "name", "columnDataType": "data_type"}.items()
        if f in wanted
    ]
    return node_cells, column_cells


def search_content(
    nodes: DataFrame,
    columns: DataFrame,
    query: str,
    fields: list[str] | None = None,
    node_type: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Literal, case-insensitive substring search; one row per match, all of them.

    ``nodes``: node_id, name, node_type, sql, description, config. ``columns``: node_id, ordinal,
    name, data_type. ``limit``, if given, cuts the list of nodes, in id order.
    """
    if not query:
        raise ValueError("the search text must not be empty")
    wanted = fields or FIELDS
    if node_type:
        nodes = nodes.filter(F.lower("node_type") == node_type.lower())
    node_cells, column_cells = _cells(wanted)
    hit = F.instr(F.lower("text"), query.lower()) > 0
    parts = []
    if node_cells:
        parts.append(nodes.select("node_id", F.inline(F.array(*node_cells))).filter(hit))
    if column_cells:
        found = columns.select("node_id", F.inline(F.array(*column_cells))).filter(hit)
        parts.append(found.join(nodes.select("node_id"), "node_id", "left_semi"))
    matches = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if limit is not None:
        matches = matches.join(matches.select("node_id").distinct().orderBy("node_id").limit(limit), "node_id", "left_semi")
    text = F.when(F.col("whole"), F.col("text")).otherwise(snippet(F.col("text"), query))
    return matches.select("node_id", "field", "column_name", text.alias("snippet"))


def index_content(nodes: DataFrame, columns: DataFrame, folder: str) -> None:
    """Store an index of what ``search_content`` searches, for ``search_indexed``."""
    node_cells, column_cells = _cells(FIELDS)
    own = nodes.select("node_id", F.inline(F.array(*node_cells)))
    others = columns.select("node_id", F.inline(F.array(*column_cells))).join(nodes.select("node_id"), "node_id", "left_semi")
    textindex.build(own.unionByName(others).select("node_id", "field", "column_name", "whole", "text"), folder)


def search_indexed(spark: SparkSession, folder: str, queries: DataFrame) -> DataFrame:
    """What ``search_content`` finds for every text of ``queries(query_id, query)``, in one job and from the index alone."""
    found = textindex.search(spark, folder, queries)
    text = F.when(F.col("whole"), F.col("text")).otherwise(snippet(F.col("text"), F.col("query"), F.col("at"), F.col("length")))
    return found.select("query_id", "node_id", "field", "column_name", text.alias("snippet"))


def search_variants(
    variants: DataFrame,
    family: str | None = None,
    package: str | None = None,
    primitive: str | None = None,
    status: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Variants that meet every given condition; with ``limit`` the first ones in key order."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")

    def holds(array: str, value: str) -> Column:
        return F.exists(array, lambda x: F.lower(x) == value.strip().lower())

    if family and family.strip():
        variants = variants.filter(F.lower("family") == family.strip().lower())
    if package and package.strip():
        variants = variants.filter(holds("packages", package))
    if primitive and primitive.strip():
        variants = variants.filter(holds("primitives", primitive))
    if status:
        variants = variants.filter(F.col("support_status") == status)
    return variants if limit is None else variants.orderBy("variant_key").limit(limit)
