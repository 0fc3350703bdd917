"""What a catalogue's nodes and columns are: types, roles, families, layers, load settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import rules
from millrace.functions.names import base_type
from millrace.functions.spread import spread


def infer_types(columns: DataFrame) -> DataFrame:
    """Add ``inferred_type`` from the text of ``transform``; null where no rule applies."""
    return columns.withColumn("inferred_type", rules.infer_type(F.col("transform")))


def flag_passthrough(columns: DataFrame) -> DataFrame:
    return columns.withColumn("is_passthrough", rules.is_passthrough(F.col("transform"), F.col("name")))


def infer_column_roles(columns: DataFrame) -> DataFrame:
    """Roles by name pattern; a node with marked columns keeps its marks instead of guesses.

    The marks per node come from one aggregate joined back, so a wide node stays spread out.
    """
    name, text = F.col("name"), F.coalesce("transform", F.lit(""))
    marked_key, marked_track = (F.coalesce(c, F.lit(False)) for c in ("is_business_key", "is_change_tracking"))
    key_like = name.rlike(rules.KEY_NAME)
    track_like = (
        ~key_like & ~name.rlike(rules.SYSTEM_NAME) & ~text.rlike(rules.AGGREGATE_PATTERN) & ~marked_key & (name != "")
    )
    marks = columns.groupBy("node_id").agg(
        F.bool_or(marked_key).alias("__any_key"), F.bool_or(marked_track).alias("__any_track")
    )
    return (
        columns.join(spread(marks), "node_id")
        .withColumns(
            {
                "is_timestamp": name.rlike(rules.TIMESTAMP_NAME),
                "is_date": name.rlike(rules.DATE_NAME),
                "business_key": F.when(F.col("__any_key"), marked_key).otherwise(key_like),
                "change_tracking": F.when(F.col("__any_track"), marked_track).otherwise(track_like),
            }
        )
        .drop("__any_key", "__any_track")
    )


def detect_scd2_nodes(columns: DataFrame) -> DataFrame:
    """Nodes that carry a start date, an end date and a current flag."""
    name = F.col("name")
    return columns.groupBy("node_id").agg(
        (
            F.bool_or(name.rlike(rules.START_NAME))
            & F.bool_or(name.rlike(rules.END_NAME))
            & F.bool_or(name.rlike(rules.CURRENT_NAME))
        ).alias("is_scd2")
    )


def node_context(nodes: DataFrame, columns: DataFrame, edges: DataFrame) -> DataFrame:
    """Per node: source count, aggregates, time columns, history pattern, materialization."""
    name, text = F.col("name"), F.coalesce("transform", F.lit(""))
    facts = columns.groupBy("node_id").agg(
        F.bool_or(text.rlike(rules.AGGREGATE_PATTERN)).alias("has_aggregates"),
        F.bool_or(name.rlike(rules.TIMESTAMP_NAME) | name.rlike(rules.DATE_NAME)).alias("has_time"),
        (
            F.bool_or(name.rlike(rules.START_NAME))
            & F.bool_or(name.rlike(rules.END_NAME))
            & F.bool_or(name.rlike(rules.CURRENT_NAME))
        ).alias("has_history"),
        F.bool_or(name.rlike(rules.KEY_NAME)).alias("has_key_names"),
        F.bool_or(F.coalesce("is_business_key", F.lit(False))).alias("has_key_marks"),
    )
    sources = edges.groupBy(F.col("dst").alias("node_id")).agg(F.count(F.lit(1)).alias("sources"))
    flags = ["has_aggregates", "has_time", "has_history", "has_key_names", "has_key_marks"]
    is_view = F.contains(F.lower(F.coalesce("materialization", F.lit(""))), F.lit("view"))
    return (
        nodes.join(facts, "node_id", "left")
        .join(sources, "node_id", "left")
        .withColumns({c: F.coalesce(c, F.lit(False)) for c in flags})
        .withColumns({"sources": F.coalesce("sources", F.lit(0)), "stored_as": F.when(is_view, "view").otherwise("table")})
    )


def suggest_load_config(context: DataFrame) -> DataFrame:
    """Settings that follow from ``node_context``; null means no opinion."""
    agg, many = F.col("has_aggregates"), F.col("sources") > 1
    table, view = F.col("stored_as") == "table", F.col("stored_as") == "view"
    return context.withColumns(
        {
            "insert_strategy": F.when(many & agg, "UNION").when(many, "UNION ALL"),
            "select_distinct": F.when(agg | (view & ~agg), F.lit(False)),
            "truncate_before": F.when(table, F.lit(False)),
            "check_history_settings": F.col("has_history"),
            "lacks_audit_columns": table & ~F.col("has_time"),
        }
    )


def suggestion_map(suggested: DataFrame) -> DataFrame:
    """The suggestions as a ``suggestions`` map of setting name to text."""
    return suggested.withColumn(
        "suggestions",
        F.map_filter(
            F.create_map(
                F.lit("insertStrategy"),
                F.col("insert_strategy"),
                F.lit("selectDistinct"),
                F.col("select_distinct").cast("string"),
                F.lit("truncateBefore"),
                F.col("truncate_before").cast("string"),
            ),
            lambda k, v: v.isNotNull(),
        ),
    )


SEMANTIC_FAMILIES = ["persistent-stage", "dimension", "fact", "hub", "satellite", "link"]


def complete_config(nodes: DataFrame, definitions: DataFrame) -> DataFrame:
    """Fill each node's settings from its type definition.

    ``nodes``: node_id, node_type, config map, suggestions map, has_key_names, has_key_marks.
    ``definitions``: one row per setting of a type: node_type, item, kind, required, default_value.
    Existing values stay; defaults fill gaps; a suggestion beats both for settings the type offers
    as optional. A type has a handful of settings, so they travel as one small map per type.
    """
    is_selector = F.col("kind") == "columnSelector"
    plain = ~is_selector
    needed = plain & F.coalesce("required", F.lit(False))
    fallback = F.col("default_value")

    def items(condition: Column) -> Column:
        return F.array_sort(F.collect_set(F.when(condition, F.col("item"))))

    def defaults(condition: Column) -> Column:
        pairs = F.collect_list(F.when(condition, F.struct("item", "default_value")))
        return F.map_from_entries(pairs)

    per_type = definitions.groupBy("node_type").agg(
        items(needed).alias("required_items"),
        items(plain & ~needed).alias("optional_items"),
        defaults(plain & fallback.isNotNull()).alias("defaults"),
        F.max(is_selector & (F.col("item") == "isBusinessKey")).alias("wants_keys"),
        F.max(is_selector & F.coalesce("required", F.lit(False))).alias("needs_keys"),
    )
    config = F.coalesce("config", F.create_map().cast("map<string,string>"))
    offered = F.map_filter("suggestions", lambda k, v: F.array_contains(F.col("optional_items"), k))
    gaps = F.map_filter("defaults", lambda k, v: ~F.map_contains_key(config, k))
    # Later maps win; each one is cut down to keys the next does not hold, as keys must be unique.
    base = F.map_concat(config, gaps)
    applied = F.map_concat(F.map_filter(base, lambda k, v: ~F.map_contains_key(offered, k)), offered)
    missing = F.filter("required_items", lambda i: ~F.map_contains_key(F.col("applied"), i))
    no_keys = ~F.col("has_key_names") & ~F.col("has_key_marks")
    semantic = rules.family(F.col("node_type")).isin(*SEMANTIC_FAMILIES)
    return (
        nodes.join(per_type, "node_type", "inner")
        .withColumn("applied", applied)
        .withColumn(
            "missing_required",
            F.concat(missing, F.when(F.col("needs_keys") & no_keys, F.array(F.lit("columnSelector:isBusinessKey"))).otherwise(F.array().cast("array<string>"))),
        )
        .withColumn("lacks_business_key", semantic & F.col("wants_keys") & no_keys)
        .withColumn(
            "status",
            F.when(F.size("missing_required") > 0, "incomplete")
            .when(F.col("lacks_business_key"), "needs_attention")
            .otherwise("complete"),
        )
        .select("node_id", "node_type", "applied", "missing_required", "lacks_business_key", "status")
    )


def classify_node_family(nodes: DataFrame, signal: str = "node_type") -> DataFrame:
    return nodes.withColumn("family", rules.family(F.col(signal)))


def infer_layer(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("layer", rules.layer(F.col("name"), F.col("node_type")))


def check_materialization(nodes: DataFrame) -> DataFrame:
    """Nodes typed as a view but stored as a table."""
    kind = F.lower(F.trim(F.regexp_replace("node_type", ".*:::", "")))
    return nodes.filter((kind == "view") & (F.lower("materialization") == "table"))


def suggest_names(nodes: DataFrame, family_signal: str = "node_type", source_name: str = "name") -> DataFrame:
    """Family prefix plus the source's name without its own prefix."""
    prefix = rules.first_match(
        [(rules.family(F.col(family_signal)) == k, v) for k, v in rules.FAMILY_PREFIXES.items()], "NODE"
    )
    bare = F.regexp_replace(F.coalesce(source_name, F.lit("NEW_PIPELINE")), rules.KNOWN_NAME_PREFIX, "")
    joined = F.upper(F.concat_ws("_", prefix, bare))
    return nodes.withColumn("suggested_name", F.regexp_replace(joined, "__+", "_"))


def bare_type(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("base_type", base_type(F.col("node_type")))
