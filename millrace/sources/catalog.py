"""Catalogue documents to tables, and the plain listings over those tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

REFERENCE = T.StructType(
    [
        T.StructField("nodeID", T.StringType()),
        T.StructField("sourceNodeID", T.StringType()),
        T.StructField("columnID", T.StringType()),
        T.StructField("sourceColumnID", T.StringType()),
        T.StructField("columnName", T.StringType()),
    ]
)
COLUMN_SOURCE = T.StructType(
    [
        T.StructField("transform", T.StringType()),
        T.StructField("columnReferences", T.ArrayType(REFERENCE)),
    ]
)
COLUMN = T.StructType(
    [
        T.StructField("columnID", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("dataType", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("nullable", T.BooleanType()),
        T.StructField("transform", T.StringType()),
        T.StructField("isBusinessKey", T.BooleanType()),
        T.StructField("isChangeTracking", T.BooleanType()),
        T.StructField("sources", T.ArrayType(COLUMN_SOURCE)),
    ]
)
MAPPING = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("aliases", T.MapType(T.StringType(), T.StringType())),
        # A dependency is either a bare node id or an object; both arrive as text.
        T.StructField("dependencies", T.ArrayType(T.StringType())),
        T.StructField("join", T.StructType([T.StructField("joinCondition", T.StringType())])),
        T.StructField("query", T.StringType()),
    ]
)
NODE = T.StructType(
    [
        T.StructField("workspaceID", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("nodeType", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("locationName", T.StringType()),
        T.StructField("materializationType", T.StringType()),
        T.StructField("config", T.StringType()),
        T.StructField("predecessorNodeIDs", T.ArrayType(T.StringType())),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("description", T.StringType()),
                    T.StructField("columns", T.ArrayType(COLUMN)),
                    T.StructField("sourceMapping", T.ArrayType(MAPPING)),
                ]
            ),
        ),
    ]
)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Node documents from NDJSON files, with an explicit schema and the raw line kept."""
    return parse_nodes(spark.read.text(path).withColumnRenamed("value", "raw"), "raw")


def parse_nodes(df: DataFrame, json_column: str) -> DataFrame:
    """Parse node documents; a record without id, name or type is dropped.

    ``mappedSources`` are the node ids that a source mapping lists which is one object instead of a list of mappings.
    """
    doc = F.from_json(F.col(json_column), NODE)
    listed = F.from_json(F.get_json_object("raw", "$.metadata.sourceMapping.sources"), "array<struct<nodeID:string>>")
    mapped = F.when(F.col("doc.metadata.sourceMapping").isNull(), F.filter(listed["nodeID"], lambda i: i.isNotNull()))
    out = df.select(F.col(json_column).alias("raw"), doc.alias("doc")).select("raw", "doc.*", mapped.alias("mappedSources"))
    return out.filter((F.col("id") != "") & (F.col("name") != "") & (F.col("nodeType") != ""))


def node_columns(nodes: DataFrame) -> DataFrame:
    """One row per usable column: it needs an id (``columnID``, else ``id``) and a name."""
    exploded = nodes.select(
        "workspaceID", F.col("id").alias("node_id"), F.posexplode("metadata.columns").alias("ordinal", "c")
    )
    return exploded.select(
        "workspaceID",
        "node_id",
        "ordinal",
        F.coalesce("c.columnID", "c.id").alias("column_id"),
        F.col("c.name").alias("name"),
        F.col("c.dataType").alias("data_type"),
        F.col("c.transform").alias("transform"),
        F.col("c.description").alias("description"),
        F.col("c.nullable").alias("nullable"),
        F.col("c.isBusinessKey").alias("is_business_key"),
        F.col("c.isChangeTracking").alias("is_change_tracking"),
        F.col("c.sources").alias("sources"),
    ).filter((F.col("column_id") != "") & (F.col("name") != ""))


def column_refs(columns: DataFrame) -> DataFrame:
    """Upstream references of every column; incomplete references are dropped."""
    refs = columns.select(
        "workspaceID", "node_id", "column_id", F.explode(F.flatten("sources.columnReferences")).alias("r")
    )
    return refs.select(
        "workspaceID",
        F.coalesce("r.nodeID", "r.sourceNodeID").alias("src_node"),
        F.coalesce("r.columnID", "r.sourceColumnID").alias("src_column"),
        F.col("node_id").alias("dst_node"),
        F.col("column_id").alias("dst_column"),
    ).filter((F.col("src_node") != "") & (F.col("src_column") != ""))


def scan_nodes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, node_columns, column_refs) of a folder of node documents."""
    nodes = read_nodes(spark, path)
    columns = node_columns(nodes)
    return nodes, columns, column_refs(columns)


def list_entities(
    df: DataFrame,
    order_by: str,
    direction: str = "asc",
    starting_from: object = None,
    limit: int = 100,
) -> DataFrame:
    """One keyset page of any catalogue table: rows after the cursor, in order."""
    c = F.col(order_by)
    if starting_from is not None:
        df = df.filter(c > F.lit(starting_from) if direction == "asc" else c < F.lit(starting_from))
    return df.orderBy(c.asc() if direction == "asc" else c.desc()).limit(limit)


def get_entity(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def scan_runs(
    runs: DataFrame,
    run_type: str | None = None,
    run_status: str | None = None,
    environment_id: object = None,
) -> DataFrame:
    """Every given filter must hold; they are pushed to the file scan."""
    wanted = {"run_type": run_type, "status": run_status, "environment_id": environment_id}
    for name, value in wanted.items():
        if value is not None:
            runs = runs.filter(F.col(name) == F.lit(value))
    return runs


def with_details(heads: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Every head with its details, one row per detail; a head without any keeps one row.

    Rows, not lists, and an inner join plus the heads without details instead of an outer join: so a
    head with a large share of all details is split by skew handling, and a small table of heads can be
    broadcast.
    """
    alone = heads.join(details.select(key).distinct(), key, "left_anti")
    return heads.join(details, key).unionByName(alone, allowMissingColumns=True)


def run_details(runs: DataFrame, run_nodes: DataFrame) -> DataFrame:
    """Run metadata with its results."""
    return with_details(runs, run_nodes, "run_id")


def environment_overview(environments: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every environment with its deployed nodes."""
    return with_details(environments, nodes, "environment_id")


def user_role_report(
    roles: DataFrame, scopes: list[str], project_id: object = None, environment_id: object = None
) -> DataFrame:
    """One row per user with the roles held in each scope, joined by commas."""
    if project_id is not None:
        roles = roles.filter((F.col("scope") != "project") | (F.col("scope_id") == F.lit(project_id)))
    if environment_id is not None:
        roles = roles.filter((F.col("scope") != "environment") | (F.col("scope_id") == F.lit(environment_id)))
    held = roles.select("user_id", "scope", "role").distinct()
    listed = F.array_join(F.sort_array(F.collect_set("role")), ",")
    wide = held.groupBy("user_id").pivot("scope", scopes).agg(listed)
    return wide.withColumns({s: F.nullif(F.col(s), F.lit("")) for s in scopes})
