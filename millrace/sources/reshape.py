"""Node documents between the service form and the on-disk form, for a whole corpus at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _refs_to_disk(refs: Column) -> Column:
    return F.transform(
        refs,
        lambda r: F.struct(
            r["nodeID"].alias("stepCounter"),
            r["columnID"].alias("columnCounter"),
            r["columnName"].alias("columnName"),
        ),
    )


def _refs_to_service(refs: Column) -> Column:
    return F.transform(
        refs,
        lambda r: F.struct(
            r["stepCounter"].alias("nodeID"),
            r["columnCounter"].alias("columnID"),
            r["columnName"].alias("columnName"),
        ),
    )


def to_disk(nodes: DataFrame) -> DataFrame:
    """Service form to on-disk form: columns nest under ``operation.metadata``, ids become counters.

    Expects id, name, nodeType, description, database, schema, locationName, config (map) and
    columns (array of name, dataType, description, nullable, columnID, sources).
    """
    node_id = F.col("id")

    def column(c: Column) -> Column:
        sources = F.transform(
            c["sources"],
            lambda s: F.struct(
                F.coalesce(s["transform"], F.lit("")).alias("transform"),
                _refs_to_disk(s["columnReferences"]).alias("columnReferences"),
            ),
        )
        return F.struct(
            c["name"].alias("name"),
            c["dataType"].alias("dataType"),
            F.coalesce(c["description"], F.lit("")).alias("description"),
            F.coalesce(c["nullable"], F.lit(True)).alias("nullable"),
            F.struct(c["columnID"].alias("columnCounter"), node_id.alias("stepCounter")).alias("columnReference"),
            sources.alias("sourceColumnReferences"),
        )

    operation = F.struct(
        F.coalesce("description", F.lit("")).alias("description"),
        F.col("nodeType"),
        F.coalesce("database", F.lit("")).alias("database"),
        F.col("schema"),
        F.col("locationName"),
        F.coalesce("isMultisource", F.lit(False)).alias("isMultisource"),
        F.coalesce("config", F.create_map().cast("map<string,string>")).alias("config"),
        F.struct(
            F.transform("columns", column).alias("columns"),
            F.array().cast("array<string>").alias("appliedNodeTests"),
        ).alias("metadata"),
        F.lit(True).alias("deployEnabled"),
    )
    return nodes.select(F.lit(1).alias("fileVersion"), "id", "name", operation.alias("operation"))


def to_service(nodes: DataFrame) -> DataFrame:
    """On-disk form back to the service form; disk-only fields are dropped."""

    def column(c: Column) -> Column:
        sources = F.transform(
            c["sourceColumnReferences"],
            lambda s: F.struct(
                F.coalesce(s["transform"], F.lit("")).alias("transform"),
                _refs_to_service(s["columnReferences"]).alias("columnReferences"),
            ),
        )
        return F.struct(
            c["name"].alias("name"),
            c["dataType"].alias("dataType"),
            F.coalesce(c["description"], F.lit("")).alias("description"),
            F.coalesce(c["nullable"], F.lit(True)).alias("nullable"),
            c["columnReference"]["columnCounter"].alias("columnID"),
            sources.alias("sources"),
        )

    top = ["description", "nodeType", "database", "schema", "locationName", "isMultisource", "config"]
    return nodes.select(
        "id",
        "name",
        *[F.col(f"operation.{c}").alias(c) for c in top],
        F.transform("operation.metadata.columns", column).alias("columns"),
    )


def reshape_nodes(nodes: DataFrame, direction: str) -> DataFrame:
    if direction not in ("to_disk", "to_service"):
        raise ValueError("direction is to_disk or to_service")
    return to_disk(nodes) if direction == "to_disk" else to_service(nodes)
