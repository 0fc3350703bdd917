"""What a workspace holds: types, packages, layers, method, documentation, type variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import rules
from millrace.functions.names import non_blank, package_of


# The setting kinds a variant may use and still count as supported.
SUPPORTED_PRIMITIVES = [
    "dropdownSelector",
    "label",
    "Label",
    "materializationSelector",
    "multisourceToggle",
    "overrideSQLToggle",
    "textBox",
    "toggleButton",
]


def node_type_inventory(nodes: DataFrame) -> DataFrame:
    """Count of nodes per type within each workspace, with the workspace total."""
    counts = nodes.groupBy("workspace_id", F.coalesce("node_type", F.lit("unknown")).alias("node_type")).agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = counts.groupBy("workspace_id").agg(F.sum("n").alias("total"))
    return counts.join(totals, "workspace_id")


def package_usage(nodes: DataFrame, enabled: DataFrame, definitions: DataFrame) -> DataFrame:
    """Per enabled (alias, id): use count, and whether the id is defined once, never or several times."""
    used = nodes.groupBy(F.col("node_type").alias("full_type")).agg(F.count(F.lit(1)).alias("used"))
    defs = definitions.groupBy("id").agg(F.count(F.lit(1)).alias("n_defs"))
    rows = enabled.select("alias", "id").distinct().withColumn("full_type", F.concat_ws(":::", "alias", "id"))
    n = F.coalesce("n_defs", F.lit(0))
    return rows.join(used, "full_type", "left").join(defs, "id", "left").select(
        "alias",
        "id",
        F.coalesce("used", F.lit(0)).alias("used"),
        F.when(n == 0, "missing").when(n == 1, "defined").otherwise("ambiguous").alias("definition"),
    )


def detect_packages(nodes: DataFrame) -> DataFrame:
    """Sorted packages and built-in types per workspace; types are made distinct before gathering."""
    types = nodes.select("workspace_id", "node_type").distinct()
    package = package_of("node_type")
    return types.groupBy("workspace_id").agg(
        F.sort_array(F.collect_set(package)).alias("packages"),
        F.sort_array(F.collect_set(F.when(package.isNull(), F.col("node_type")))).alias("built_in_types"),
    )


def layer_counts(nodes: DataFrame) -> DataFrame:
    """(workspace, layer, type) counts, from which the layer reports are made."""
    layered = nodes.withColumn("layer", rules.layer(F.col("name"), F.col("node_type")))
    return layered.groupBy("workspace_id", "layer", "node_type").agg(F.count(F.lit(1)).alias("n"))


def layer_summary(nodes: DataFrame) -> DataFrame:
    return layer_counts(nodes).groupBy("workspace_id", "layer").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_set("node_type")).alias("node_types")
    )


def detect_methodology(nodes: DataFrame) -> DataFrame:
    """Modelling style per workspace, in fixed order of evidence."""
    name, upper, kind = F.col("name"), F.upper("name"), F.col("node_type")

    def typed(t: str) -> Column:
        return (kind == t) | F.endswith(kind, F.lit(f":::{t}"))

    signs = nodes.groupBy("workspace_id").agg(
        F.count_if(upper.rlike("^HUB_|_HUB$")).alias("hub"),
        F.count_if(upper.rlike("^SAT_|_SAT$")).alias("sat"),
        F.count_if(name.rlike("(?i)^DIM_|^DIMENSION_") | typed("Dimension")).alias("dim"),
        F.count_if(name.rlike("(?i)^FACT_|^FCT_") | typed("Fact")).alias("fact"),
        F.count_if(name.rlike("(?i)^stg_")).alias("stg"),
        F.count_if(name.rlike("(?i)^int_")).alias("int"),
    )
    style = (
        F.when((F.col("hub") >= 1) & (F.col("sat") >= 1), "data-vault")
        .when((F.col("dim") >= 1) & (F.col("fact") >= 1), "kimball")
        .when((F.col("stg") >= 1) & (F.col("int") >= 1), "dbt-style")
        .otherwise("mixed")
    )
    return signs.select("workspace_id", style.alias("methodology"))


def workspace_profile(nodes: DataFrame) -> DataFrame:
    """Node count, style, preferred package and recommended type per layer, one row per workspace.

    A type is recommended by preference: packaged and named as the fallback, built in and so named,
    any packaged one, the first of the layer; an empty layer gives the fallback itself.
    """
    counts = layer_counts(nodes)
    package = package_of("node_type")
    base = counts.groupBy("workspace_id").agg(
        F.sum("n").alias("node_count"),
        F.min(F.when(package == "base-nodes", 0).when(package.isNotNull(), 1)).alias("__rank"),
        F.min(package).alias("__first"),
        *[
            _preferred(layer, fallback).alias(out)
            for out, layer, fallback in (
                ("staging_type", "staging", "Stage"),
                ("transform_type", "intermediate", "View"),
                ("dimension_type", "mart", "Dimension"),
                ("fact_type", "mart", "Fact"),
            )
        ],
    )
    preferred = F.when(F.col("__rank") == 0, "base-nodes").otherwise(F.col("__first"))
    fallbacks = {"staging_type": "Stage", "transform_type": "View", "dimension_type": "Dimension", "fact_type": "Fact"}
    filled = base.withColumn("default_package", preferred).withColumns(
        {
            c: F.coalesce(f"{c}.t", F.when(preferred.isNotNull(), F.concat_ws(":::", preferred, F.lit(f))).otherwise(F.lit(f)))
            for c, f in fallbacks.items()
        }
    )
    return filled.drop("__rank", "__first").join(detect_methodology(nodes), "workspace_id")


def _preferred(layer: str, fallback: str) -> Column:
    kind = F.col("node_type")
    rank = (
        F.when(F.endswith(kind, F.lit(f":::{fallback}")), 0)
        .when(kind == fallback, 1)
        .when(F.contains(kind, F.lit(":::")), 2)
        .otherwise(3)
    )
    return F.min(F.when(F.col("layer") == layer, F.struct(rank.alias("r"), kind.alias("t"))))


def documentation_audit(nodes: DataFrame, columns: DataFrame) -> DataFrame:
    """Documented share of nodes and columns per workspace; percent to 2 decimals, 0 when empty.

    ``nodes``: workspace_id, description, meta_description. ``columns``: workspace_id, description.
    """
    n = nodes.groupBy("workspace_id").agg(
        F.count(F.lit(1)).alias("total_nodes"),
        F.count_if(non_blank("description") | non_blank("meta_description")).alias("documented_nodes"),
    )
    c = columns.groupBy("workspace_id").agg(
        F.count(F.lit(1)).alias("total_columns"), F.count_if(non_blank("description")).alias("documented_columns")
    )
    both = n.join(c, "workspace_id", "left").fillna(0, ["total_columns", "documented_columns"])

    def percent(part: str, whole: str) -> Column:
        share = F.round(F.col(part) / F.col(whole) * 10000) / 100
        return F.when(F.col(whole) > 0, share).otherwise(0.0)

    return both.withColumns(
        {
            "node_percent": percent("documented_nodes", "total_nodes"),
            "column_percent": percent("documented_columns", "total_columns"),
        }
    )


def undocumented_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.filter(~(non_blank("description") | non_blank("meta_description")))


def undocumented_columns(columns: DataFrame) -> DataFrame:
    """All columns without description."""
    return columns.filter(~non_blank("description"))


def variant_dedup(definitions: DataFrame, supported: list[str] | None = None) -> DataFrame:
    """Variants of node types: equal family and equal texts are one variant.

    ``definitions``: family_dir, package, definition_text, create_text, run_text, primitives (null
    when the settings could not be read). The set of a variant's primitives is part of its text.
    """
    allowed = F.array(*[F.lit(p) for p in (supported or SUPPORTED_PRIMITIVES)])
    fam = F.regexp_replace("family_dir", r"-\d+$", "")
    key = F.concat_ws("|", fam, F.sha2("definition_text", 256), F.sha2("create_text", 256), F.sha2("run_text", 256))
    keyed = definitions.withColumns({"family": fam, "variant_key": key})
    per_package = keyed.groupBy("variant_key", "family", "package").agg(
        F.count(F.lit(1)).alias("n"), F.max("primitives").alias("primitives")
    )
    extra = F.array_sort(F.array_except("primitives", allowed))
    return (
        per_package.groupBy("variant_key", "family")
        .agg(
            F.sum("n").alias("occurrences"),
            F.sort_array(F.collect_set("package")).alias("packages"),
            F.max("primitives").alias("primitives"),
        )
        .withColumn("unsupported", F.coalesce(extra, F.array().cast("array<string>")))
        .withColumn(
            "support_status",
            F.when(F.col("primitives").isNull(), "parse_error").when(F.size("unsupported") == 0, "supported").otherwise("partial"),
        )
    )


def variant_summary(variants: DataFrame) -> DataFrame:
    """One row of totals by support status."""
    status = F.col("support_status")
    return variants.agg(
        F.count(F.lit(1)).alias("variants"),
        F.countDistinct("family").alias("families"),
        F.sum("occurrences").alias("definitions"),
        F.count_if(status == "supported").alias("supported"),
        F.count_if(status == "partial").alias("partial"),
        F.count_if(status == "parse_error").alias("parse_error"),
    )


def top_families(variants: DataFrame, limit: int | None = None) -> DataFrame:
    """Variants in each family; with ``limit`` the families with most, ties by name."""
    counts = variants.groupBy("family").agg(F.count(F.lit(1)).alias("n"))
    return counts if limit is None else counts.orderBy(F.desc("n"), F.asc("family")).limit(limit)
