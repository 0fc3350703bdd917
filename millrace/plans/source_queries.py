"""Catalogue scans, snapshots, listings, redaction and reshaping over the supplied tables."""

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from millrace.plans import catalogue as c
from millrace.plans.catalogue import with_sql
from millrace.plans.registry import query
from millrace.sources import catalog, reshape, secrets, snapshots
from millrace.sources.scratch import Scratch


def node_documents(t: c.Tables) -> DataFrame:
    """One JSON document per node, in the service form; a node has at most eight columns."""
    cols = c.node_columns(t)
    refs = c.column_refs(t).groupBy(F.col("dst_node").alias("node_id"), F.col("dst_column").alias("column_id")).agg(
        F.sort_array(
            F.collect_set(F.struct(F.col("src_node").cast("string").alias("nodeID"), F.col("src_column").cast("string").alias("columnID")))
        ).alias("r")
    )
    column = F.struct(
        F.col("ordinal"),
        F.col("column_id").cast("string").alias("columnID"),
        F.col("name"),
        F.col("data_type").alias("dataType"),
        F.col("description"),
        F.col("transform"),
        F.array(F.struct(F.coalesce("transform", F.lit("")).alias("transform"), F.col("r").alias("columnReferences"))).alias("sources"),
    )
    per_node = cols.join(refs, ["node_id", "column_id"], "left").groupBy("node_id").agg(F.sort_array(F.collect_list(column)).alias("columns"))
    ups = c.edges(t).groupBy(F.col("dst").alias("node_id")).agg(F.sort_array(F.collect_set("src")).alias("ups"))
    aliases = F.map_from_entries(F.transform("ups", lambda u: F.struct(F.concat(F.lit("A"), u), u.cast("string"))))
    doc = F.struct(
        F.lit("0").alias("workspaceID"),
        F.col("node_id").cast("string").alias("id"),
        F.when(F.col("node_id") % 97 != 5, F.col("name")).alias("name"),
        F.col("node_type").alias("nodeType"),
        F.col("location").alias("locationName"),
        F.when(F.col("node_id") % 2 == 0, F.transform("ups", lambda u: u.cast("string"))).alias("predecessorNodeIDs"),
        F.struct(
            F.col("columns"),
            F.array(F.struct(F.when(F.col("node_id") % 3 != 0, aliases).alias("aliases"), F.when(F.col("node_id") % 3 == 0, F.transform("ups", lambda u: u.cast("string"))).alias("dependencies"))).alias("sourceMapping"),
        ).alias("metadata"),
    )
    return c.nodes(t).join(per_node, "node_id").join(ups, "node_id", "left").select(F.to_json(doc).alias("raw"))


@query(
    "s1_scan_nodes",
    with_sql("node_columns")
    + """SELECT CAST(node_id AS VARCHAR) AS node_id, CAST(column_id AS VARCHAR) AS column_id, ordinal, name, data_type, transform
         FROM node_columns WHERE node_id % 97 <> 5""",
)
def s1_scan_nodes(t):
    nodes = catalog.parse_nodes(node_documents(t), "raw")
    return catalog.node_columns(nodes).select("node_id", "column_id", "ordinal", "name", "data_type", "transform")


@query(
    "s1_scan_column_refs",
    with_sql("column_refs")
    + """SELECT CAST(src_node AS VARCHAR) AS src_node, CAST(src_column AS VARCHAR) AS src_column,
         CAST(dst_node AS VARCHAR) AS dst_node, CAST(dst_column AS VARCHAR) AS dst_column
         FROM column_refs WHERE dst_node % 97 <> 5""",
)
def s1_scan_column_refs(t):
    nodes = catalog.parse_nodes(node_documents(t), "raw")
    return catalog.column_refs(catalog.node_columns(nodes)).drop("workspaceID")


@query("s2_s3_snapshot", with_sql("nodes") + "SELECT node_id, name, node_type, location FROM nodes")
def s2_s3_snapshot(t):
    folder = Scratch(t.spark, "snapshot").path
    rows = c.nodes(t).select("node_id", "name", "node_type", "location")
    snapshots.publish_snapshot(rows.limit(0), folder, datetime(2024, 1, 1, 10, 0))
    snapshots.publish_snapshot(rows, folder, datetime(2024, 1, 1, 11, 50))
    return snapshots.load_snapshot(t.spark, folder, as_of=datetime(2024, 1, 1, 12, 0), ttl_seconds=1800)


@query(
    "s4_list_entities",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey < 5000 ORDER BY o_orderkey DESC LIMIT 250",
)
def s4_list_entities(t):
    return catalog.list_entities(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", "desc", 5000, 250)


@query(
    "s5_scan_runs",
    with_sql("runs") + "SELECT run_id, start_time FROM runs WHERE run_type = 'deploy' AND status = 'failed' AND environment_id = 2",
)
def s5_scan_runs(t):
    return catalog.scan_runs(c.runs(t), "deploy", "failed", 2).select("run_id", "start_time")


@query(
    "s6_run_details",
    with_sql("runs", "run_nodes")
    + """SELECT r.run_id, r.status, r.start_time, n.node_id, n.status AS node_status FROM runs r LEFT JOIN run_nodes n ON r.run_id = n.run_id""",
)
def s6_run_details(t):
    results = c.run_nodes(t).select("run_id", "node_id", F.col("status").alias("node_status"))
    return catalog.run_details(c.runs(t).select("run_id", "status", "start_time"), results)


@query(
    "s7_environment_overview",
    with_sql("nodes")
    + """SELECT CAST(n_nationkey AS BIGINT) AS environment_id, n_name, node_id, name
         FROM nation LEFT JOIN nodes ON environment_id = n_nationkey""",
)
def s7_environment_overview(t):
    environments = t.nation.select(F.col("n_nationkey").cast("long").alias("environment_id"), "n_name")
    return catalog.environment_overview(environments, c.nodes(t).select("environment_id", "node_id", "name"))


@query(
    "s8_drop_credentials",
    """SELECT c_custkey, '{"name":"' || c_name || '","links":[{"id":' || c_nationkey || '}]}' AS profile FROM customer""",
)
def s8_drop_credentials(t):
    profile = F.struct(
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("accessToken"),
        F.array(F.struct(F.col("c_nationkey").alias("id"), F.col("c_name").alias("gitToken"))).alias("links"),
    )
    rows = t.customer.select("c_custkey", profile.alias("profile"), F.col("c_name").alias("snowflakePassword"))
    return secrets.drop_credential_fields(rows).select("c_custkey", F.to_json("profile").alias("profile"))


@query(
    "s9_redact_sensitive",
    """SELECT event_id, CASE event_id % 8
         WHEN 0 THEN '{"api_key":"<redacted>","n":' || user_id || '}'
         WHEN 1 THEN '{"checks":[{"name":"access-token","detail":""}],"n":' || user_id || '}'
         WHEN 2 THEN '{"name":"Refresh_Token","more":{"a":[1.50,{"b":"}"}]},"detail":"<redacted>"}'
         WHEN 3 THEN '{"detail" : "<redacted>", "name" : "PAT"}'
         WHEN 4 THEN '{"outer":{"PASSWORD": "<redacted>","n":1e2,"cut off'
         WHEN 5 THEN repeat('{"a":[', 10) || '{"detail":"<redacted>","b":' || repeat('{"c":[', 10) || '{"detail":"' || event_type || '"}' || repeat(']}', 10) || ',"name":"secret"}' || repeat(']}', 10)
         WHEN 6 THEN '{"name":"token","v":[' || repeat('1,', 200 * CAST(event_id % 11 AS INTEGER)) || user_id || '],"detail":"<redacted>"}'
         ELSE '{"name":"token count","detail":"' || event_type || '","text":"\\"token\\":\\"x\\""}' END AS doc,
       event_id % 8 NOT IN (1, 7) AS did_redact FROM events""",
)
def s9_redact_sensitive(t):
    """Keys in several spellings, the pair of name and detail in both orders and at any depth, long lists, broken JSON, and what must stay."""
    doc = r"""CASE event_id % 8
         WHEN 0 THEN concat('{"api_key":"', event_type, '","n":', user_id, '}')
         WHEN 1 THEN concat('{"checks":[{"name":"access-token","detail":""}],"n":', user_id, '}')
         WHEN 2 THEN concat('{"name":"Refresh_Token","more":{"a":[1.50,{"b":"}"}]},"detail":"', event_type, '"}')
         WHEN 3 THEN concat('{"detail" : "', event_type, '", "name" : "PAT"}')
         WHEN 4 THEN concat('{"outer":{"PASSWORD": "', event_type, '\\"","n":1e2,"cut off')
         WHEN 5 THEN concat(repeat('{"a":[', 10), '{"detail":"', user_id, '","b":', repeat('{"c":[', 10), '{"detail":"', event_type, '"}', repeat(']}', 10), ',"name":"secret"}', repeat(']}', 10))
         WHEN 6 THEN concat('{"name":"token","v":[', repeat('1,', 200 * cast(event_id % 11 as int)), user_id, '],"detail":"', event_type, '"}')
         ELSE concat('{"name":"token count","detail":"', event_type, '","text":"\\"token\\":\\"x\\""}') END AS doc"""
    return secrets.redact_sensitive(t.events.selectExpr("event_id", doc), "doc")


def service_nodes(t: c.Tables) -> DataFrame:
    cols = c.node_columns(t).groupBy("node_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("ordinal"),
                    F.col("name"),
                    F.col("data_type").alias("dataType"),
                    F.col("description"),
                    F.lit(None).cast("boolean").alias("nullable"),
                    F.col("column_id").cast("string").alias("columnID"),
                    F.array(
                        F.struct(
                            F.col("transform"),
                            F.array(
                                F.struct(
                                    (F.col("node_id") - 1).cast("string").alias("nodeID"),
                                    F.lit("c").alias("columnID"),
                                    F.col("name").alias("columnName"),
                                )
                            ).alias("columnReferences"),
                        )
                    ).alias("sources"),
                )
            )
        ).alias("columns")
    )
    return c.nodes(t).join(cols, "node_id").select(
        F.col("node_id").cast("string").alias("id"),
        "name",
        "description",
        F.col("node_type").alias("nodeType"),
        F.lit(None).cast("string").alias("database"),
        F.lit("S").alias("schema"),
        F.col("location").alias("locationName"),
        F.lit(None).cast("boolean").alias("isMultisource"),
        F.lit(None).cast("map<string,string>").alias("config"),
        "columns",
    )


@query(
    "s10_reshape_to_disk",
    with_sql("node_columns", "nodes")
    + """SELECT CAST(node_id AS VARCHAR) AS id, coalesce(n.description, '') AS node_description, CAST(c.column_id AS VARCHAR) AS column_counter,
         CAST(node_id AS VARCHAR) AS step_counter, coalesce(c.description, '') AS description, TRUE AS nullable,
         CAST(node_id - 1 AS VARCHAR) AS source_step, coalesce(transform, '') AS source_transform, TRUE AS deploy_enabled
         FROM node_columns c JOIN nodes n USING (node_id)""",
)
def s10_reshape_to_disk(t):
    disk = reshape.reshape_nodes(service_nodes(t), "to_disk")
    return disk.select("id", "operation", F.explode("operation.metadata.columns").alias("c")).select(
        "id",
        F.col("operation.description").alias("node_description"),
        F.col("c.columnReference.columnCounter").alias("column_counter"),
        F.col("c.columnReference.stepCounter").alias("step_counter"),
        F.col("c.description").alias("description"),
        F.col("c.nullable").alias("nullable"),
        F.col("c.sourceColumnReferences")[0]["columnReferences"][0]["stepCounter"].alias("source_step"),
        F.col("c.sourceColumnReferences")[0]["transform"].alias("source_transform"),
        F.col("operation.deployEnabled").alias("deploy_enabled"),
    )


@query(
    "s10_reshape_round_trip",
    with_sql("node_columns", "nodes")
    + """SELECT CAST(node_id AS VARCHAR) AS id, n.name, node_type, location, c.name AS column_name, CAST(column_id AS VARCHAR) AS column_id,
         CAST(node_id - 1 AS VARCHAR) AS source_node FROM node_columns c JOIN nodes n USING (node_id)""",
)
def s10_reshape_round_trip(t):
    back = reshape.reshape_nodes(reshape.reshape_nodes(service_nodes(t), "to_disk"), "to_service")
    return back.select("id", "name", "nodeType", "locationName", F.explode("columns").alias("c")).select(
        "id",
        "name",
        F.col("nodeType").alias("node_type"),
        F.col("locationName").alias("location"),
        F.col("c.name").alias("column_name"),
        F.col("c.columnID").alias("column_id"),
        F.col("c.sources")[0]["columnReferences"][0]["nodeID"].alias("source_node"),
    )


@query(
    "s11_user_roles",
    with_sql("roles")
    + """SELECT user_id, string_agg(DISTINCT role, ',' ORDER BY role) FILTER (scope = 'org') AS org,
         string_agg(DISTINCT role, ',' ORDER BY role) FILTER (scope = 'project') AS project,
         string_agg(DISTINCT role, ',' ORDER BY role) FILTER (scope = 'environment') AS environment
         FROM roles WHERE scope <> 'project' OR scope_id = 7 GROUP BY user_id""",
)
def s11_user_roles(t):
    return catalog.user_role_report(c.roles(t), ["org", "project", "environment"], project_id=7)
