"""Run results and environment health, for all runs and environments at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.rules import first_match
from millrace.operators.windows import latest_per_key

# ---- fixed values ----
TERMINAL = ["completed", "failed", "canceled"]
KNOWN_STATUSES = ["waitingToRun", "running", *TERMINAL]
BUCKETS = {
    "succeeded": ["completed", "success", "succeeded"],
    "failed": ["failed", "error", "failure"],
    "skipped": ["skipped", "excluded"],
    "canceled": ["canceled"],
}
STATUS_KEYS = ["status", "runStatus", "nodeStatus"]
ERROR_KEYS = ["error", "errorMessage", "message", "failureMessage", "runError", "detail"]
ERROR_PATTERNS = [
    ("sql_error", "syntax", r"syntax error"),
    ("sql_error", "unexpected_token", r"unexpected '([^']+)'"),
    ("sql_error", "invalid_identifier", r"invalid identifier"),
    ("sql_error", "ambiguous_column", r"ambiguous column"),
    ("sql_error", "missing_punctuation", r"missing (comma|semicolon|parenthesis|bracket)"),
    ("sql_error", "unexpected_end", r"unexpected end of"),
    ("reference_error", "object_missing", r"object '([^']+)' does not exist"),
    ("reference_error", "table_missing", r"table '([^']+)' does not exist"),
    ("reference_error", "schema_missing", r"schema '([^']+)' does not exist"),
    ("reference_error", "database_missing", r"database '([^']+)' does not exist"),
    ("reference_error", "view_missing", r"view '([^']+)' does not exist"),
    ("reference_error", "unresolved_reference", r"could not resolve"),
    ("permission_error", "privileges", r"insufficient privileges"),
    ("permission_error", "access_denied", r"access denied"),
    ("permission_error", "not_authorized", r"not authorized"),
    ("permission_error", "warehouse_unavailable", r"warehouse '([^']+)' .*(suspended|does not exist)"),
    ("permission_error", "role_unavailable", r"role '([^']+)' .*(does not exist|is not authorized)"),
    ("permission_error", "authentication", r"authentication"),
    ("data_type_error", "cast", r"cannot cast"),
    ("data_type_error", "numeric_value", r"numeric value '([^']+)' is not recognized"),
    ("data_type_error", "date_value", r"date '([^']+)' is not recognized"),
    ("data_type_error", "invalid_type", r"invalid.*type"),
    ("data_type_error", "conversion", r"conversion"),
    ("timeout", "timeout", r"timeout"),
    ("timeout", "time_exceeded", r"exceeded.*time"),
    ("timeout", "resource_limit", r"resource.*limit"),
    ("configuration_error", "materialization", r"materialization.*type"),
    ("configuration_error", "config_missing", r"config.*missing"),
    ("configuration_error", "location_missing", r"location.*not.*found"),
    ("configuration_error", "duplicate_column", r"duplicate.*column"),
]
CATEGORIES = [
    "permission_error",
    "reference_error",
    "missing_object",
    "sql_error",
    "data_type_error",
    "timeout",
    "configuration_error",
    "unknown",
]
HEALTH_HOURS, STALE_DAYS, CRITICAL_RUNS = 24, 7, 3

# What to do about each pattern.
FIXES = {
    "syntax": "check the SQL of the transforms and the join condition",
    "unexpected_token": "look for a stray token in the transforms",
    "invalid_identifier": "look for a misspelt column or table",
    "ambiguous_column": "put the table alias before the column",
    "missing_punctuation": "add the missing punctuation",
    "unexpected_end": "close open parentheses and quotes",
    "object_missing": "deploy the node that makes this object",
    "table_missing": "deploy the source table or correct its name",
    "schema_missing": "check the storage location's schema",
    "database_missing": "check the storage mappings of the environment",
    "view_missing": "deploy the source view first",
    "unresolved_reference": "check dependencies and deployment order",
    "privileges": "grant the role what it lacks or use another one",
    "access_denied": "check the role's rights on the target",
    "not_authorized": "check the credentials and role of the environment",
    "warehouse_unavailable": "resume the warehouse or choose another",
    "role_unavailable": "check the role set for the environment",
    "authentication": "check user, key and account",
    "cast": "check column types and casts",
    "numeric_value": "clean non-numeric source values",
    "date_value": "check the date format that is parsed",
    "invalid_type": "make the transform's types agree",
    "conversion": "match the source format to the target type",
    "timeout": "filter earlier, simplify, or use more compute",
    "time_exceeded": "simplify the query or use more compute",
    "resource_limit": "use more compute or split the step",
    "materialization": "check the node's materialization",
    "config_missing": "complete the node's settings",
    "location_missing": "use a defined storage location",
    "duplicate_column": "rename or remove repeated columns",
    "object_absent": "check that the source nodes are deployed and located",
    "read_message": "read the message and check settings, transforms and dependencies",
}


def normalise_run_results(raw: DataFrame, json_column: str = "results") -> DataFrame:
    """One row per node result of (run_id, results text).

    The text is an array, or an object holding one under ``data`` or ``results``. Status and error come
    from the first key that holds text, the error also from a nested object.
    """
    doc = F.try_parse_json(F.col(json_column))

    def items(path: str) -> Column:
        return F.try_variant_get(F.col("doc"), path, "array<variant>")

    # An object never casts to an array, so each path is null unless it really is one.
    rows = raw.select("run_id", doc.alias("doc")).select(
        "run_id", F.explode(F.coalesce(items("$"), items("$.data"), items("$.results"))).alias("v")
    )

    def text(path: str) -> Column:
        value = F.try_variant_get(F.col("v"), path, "variant")
        return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(F.col("v"), path, "string"))

    def filled(path: str) -> Column:
        return F.when(text(path) != "", text(path))

    rows = rows.filter(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    return rows.select(
        "run_id",
        F.coalesce(text("$.nodeID"), F.lit("unknown")).alias("node_id"),
        text("$.nodeName").alias("node_name"),
        text("$.nodeType").alias("node_type"),
        F.coalesce(*[text(f"$.{k}") for k in STATUS_KEYS], F.lit("unknown")).alias("status"),
        F.coalesce(*[filled(f"$.{k}") for k in ERROR_KEYS], text("$.error.message"), text("$.error.detail")).alias("error"),
    )


def status_bucket(status: Column) -> Column:
    return first_match([(F.lower(status).isin(*values), name) for name, values in BUCKETS.items()], "other")


def bucket_status(run_nodes: DataFrame) -> DataFrame:
    return run_nodes.withColumn("bucket", status_bucket(F.col("status")))


def error_category(error: Column) -> Column:
    rules = [(error.rlike(f"(?i){p}"), c) for c, _, p in ERROR_PATTERNS]
    return first_match([*rules, (error.rlike("(?i)does not exist"), "missing_object")], "unknown")


def classify_errors(run_nodes: DataFrame) -> DataFrame:
    """Category (the first pattern that matches) and fixes (all that match) of each failed result."""
    error = F.col("error")
    failed = run_nodes.filter(status_bucket(F.col("status")) == "failed")
    hits = F.array_compact(F.array(*[F.when(error.rlike(f"(?i){p}"), F.lit(FIXES[k])) for _, k, p in ERROR_PATTERNS]))
    absent = F.when(error.rlike("(?i)does not exist"), F.array(F.lit(FIXES["object_absent"])))
    fallback = F.coalesce(absent, F.array(F.lit(FIXES["read_message"])))
    has_text = F.coalesce(error != "", F.lit(False))
    return failed.withColumns(
        {
            "category": F.when(has_text, error_category(error)).otherwise("unknown"),
            "fixes": F.when(has_text, F.when(F.size(hits) > 0, hits).otherwise(fallback)).otherwise(F.array().cast("array<string>")),
        }
    )


def diagnose_runs(runs: DataFrame, run_nodes: DataFrame) -> DataFrame:
    """Per run: bucket counts, failures per category, recommendations in fixed order, over-half flag.

    Results are counted per (run, bucket, category) in one map-side aggregate.
    """
    bucket = status_bucket(F.col("status"))
    has_text = F.coalesce(F.col("error") != "", F.lit(False))
    category = F.when(bucket == "failed", F.when(has_text, error_category(F.col("error"))).otherwise("unknown"))
    tagged = run_nodes.select("run_id", bucket.alias("bucket"), category.alias("category"))
    counts = tagged.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("bucket") == b).alias(b) for b in [*BUCKETS, "other"]],
        *[F.count_if(F.col("category") == c).alias(f"n_{c}") for c in CATEGORIES],
    )
    filled = ["total", *BUCKETS, "other", *[f"n_{c}" for c in CATEGORIES]]
    out = runs.select("run_id", F.col("status").alias("run_status")).join(counts, "run_id", "left").fillna(0, filled)
    n = {c: F.col(f"n_{c}") for c in CATEGORIES}
    over_half = (F.col("total") > 0) & (F.col("failed") / F.col("total") > 0.5)
    advice = F.array_compact(
        F.array(
            F.when(n["permission_error"] > 0, F.lit("fix_permissions")),
            F.when(n["reference_error"] + n["missing_object"] > 0, F.lit("deploy_missing_objects")),
            F.when(n["sql_error"] > 0, F.lit("fix_sql")),
            F.when(n["data_type_error"] > 0, F.lit("fix_types")),
            F.when(n["timeout"] > 0, F.lit("reduce_work_or_scale_up")),
            F.when(n["configuration_error"] > 0, F.lit("fix_settings")),
            F.when(n["unknown"] > 0, F.lit("read_full_errors")),
            F.when((F.col("failed") > 0) & (n["sql_error"] == 0) & (n["configuration_error"] == 0), F.lit("retry_failed_nodes")),
            F.when(over_half, F.lit("suspect_systemic_cause")),
        )
    )
    quiet = F.col("failed") == 0
    recommendations = (
        F.when(F.col("run_status") == "canceled", F.array(F.lit("retry_if_unintended")))
        .when(quiet & (F.col("run_status") == "completed"), F.array(F.lit("nothing_to_do")))
        .when(quiet & (F.col("run_status") == "failed"), F.array(F.lit("suspect_system_failure")))
        .otherwise(advice)
    )
    return out.withColumns({"over_half_failed": over_half, "recommendations": recommendations})


# ---- environment health ----------------------------------------------------------------------


def attribute_runs(runs: DataFrame, run_nodes: DataFrame, env_nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(explicit node runs, runs that cover their whole environment).

    A finished run with a time counts. It covers the nodes it lists; if it lists none, is not scoped by
    job or selector, and its node count equals the environment's, it covers them all. Such a run stays
    one row here: spelling it out would give one row per run and node.
    """
    done = runs.filter(F.col("status").isin(*TERMINAL)).withColumn("run_time", F.coalesce("end_time", "start_time"))
    done = done.filter("run_time IS NOT NULL")
    listed = run_nodes.select("run_id", "node_id").distinct()
    cols = ["environment_id", "run_id", "status", "run_time"]
    explicit = done.join(listed, "run_id").select(*cols, "node_id")
    sizes = env_nodes.groupBy("environment_id").agg(F.count(F.lit(1)).alias("n"))
    whole = (
        done.filter("job_id IS NULL AND nodes_in_run IS NOT NULL")
        .join(sizes, "environment_id")
        .filter("nodes_in_run = n")
        .join(listed.select("run_id").distinct(), "run_id", "left_anti")
        .select(*cols)
    )
    return explicit, whole


def node_last_status(runs: DataFrame, run_nodes: DataFrame, env_nodes: DataFrame) -> DataFrame:
    """passed / failed / never_run and the time, per (environment, node); canceled runs are ignored.

    The newest run decides, the highest run id among equal times. Both kinds of run are reduced to one
    row per node or environment before they meet the nodes.
    """
    live = runs.filter(F.col("status") != "canceled")
    explicit, whole = attribute_runs(live, run_nodes, env_nodes)
    last = F.max(F.struct("run_time", "run_id", "status"))
    by_node = explicit.groupBy("environment_id", "node_id").agg(last.alias("a"))
    by_env = whole.groupBy("environment_id").agg(last.alias("b"))
    out = env_nodes.join(by_node, ["environment_id", "node_id"], "left").join(by_env, "environment_id", "left")
    best = F.greatest("a", "b")
    return out.withColumn("last", best).select(
        *env_nodes.columns,
        F.when(F.col("last").isNull(), "never_run").when(F.col("last.status") == "completed", "passed").otherwise("failed").alias("last_status"),
        F.col("last.run_time").alias("last_time"),
    )


def failed_runs(runs: DataFrame, as_of: str, hours: int = HEALTH_HOURS) -> DataFrame:
    """Failed runs that started within ``hours`` before ``as_of``."""
    cutoff = F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL '{hours}' HOUR")
    return runs.filter((F.col("status") == "failed") & (F.col("start_time") >= cutoff))


def stale_nodes(last_status: DataFrame, as_of: str, days: int = STALE_DAYS) -> DataFrame:
    """Nodes never run, or last run more than ``days`` ago, with whole days since."""
    now = F.expr(f"TIMESTAMP_NTZ '{as_of}'")
    cutoff = F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL '{days}' DAY")
    seconds = F.timestamp_diff("SECOND", F.col("last_time"), now)
    stale = last_status.filter((F.col("last_status") == "never_run") | (F.col("last_time") < cutoff))
    return stale.withColumn("days_since", F.floor(seconds / 86400))


def dependency_health(env_nodes: DataFrame, edges: DataFrame, has_upstream: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(orphans, edge counts per environment).

    An edge counts if both ends are in the same environment. A node is no orphan if something in the
    environment reads it or if it has any predecessor, inside or not (``has_upstream``: node_id).
    """
    at = env_nodes.select("environment_id", "node_id")
    inside = (
        edges.select("src", "dst")
        .distinct()
        .join(at.withColumnRenamed("node_id", "dst"), "dst")
        .join(at.withColumnRenamed("node_id", "src"), ["environment_id", "src"], "left_semi")
    )
    fed = has_upstream if has_upstream is not None else edges.select(F.col("dst").alias("node_id"))
    read = inside.select("environment_id", F.col("src").alias("node_id")).distinct()
    orphans = env_nodes.join(read, ["environment_id", "node_id"], "left_anti").join(fed.distinct(), "node_id", "left_anti")
    return orphans, inside.groupBy("environment_id").agg(F.count(F.lit(1)).alias("edges"))


def environment_health(
    environments: DataFrame, env_nodes: DataFrame, runs: DataFrame, run_nodes: DataFrame, edges: DataFrame, as_of: str
) -> DataFrame:
    """Score and reason codes per environment; one aggregate per metric, joined at the end."""
    status = node_last_status(runs, run_nodes, env_nodes.select("environment_id", "node_id"))
    cutoff = F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL '{STALE_DAYS}' DAY")
    per_env = status.groupBy("environment_id").agg(
        F.count(F.lit(1)).alias("nodes"),
        F.count_if(F.col("last_status") == "failed").alias("failed_nodes"),
        F.count_if(F.col("last_status") == "never_run").alias("never_run"),
        F.count_if((F.col("last_status") == "never_run") | (F.col("last_time") < cutoff)).alias("stale"),
    )
    recent = failed_runs(runs, as_of).groupBy("environment_id").agg(F.count(F.lit(1)).alias("failed_runs"))
    orphans, links = dependency_health(env_nodes.select("environment_id", "node_id"), edges)
    alone = orphans.groupBy("environment_id").agg(F.count(F.lit(1)).alias("orphans"))
    out = environments.select("environment_id").distinct()
    for part in (per_env, recent, alone, links):
        out = out.join(part, "environment_id", "left")
    metrics = ["nodes", "failed_nodes", "never_run", "stale", "failed_runs", "orphans", "edges"]
    out = out.fillna(0, metrics)
    c = {m: F.col(m) for m in metrics}
    critical = (c["failed_runs"] >= CRITICAL_RUNS) | (c["failed_nodes"] > c["nodes"] * 0.5)
    warning = (c["failed_runs"] > 0) | (c["stale"] > 0) | (c["orphans"] > 0) | (c["never_run"] > 0)
    reasons = F.array_compact(
        F.array(*[F.when(c[m] > 0, F.lit(m)) for m in ("failed_runs", "failed_nodes", "stale", "orphans", "never_run")])
    )
    empty = c["nodes"] == 0
    return out.withColumns(
        {
            "score": F.when(empty, "warning").when(critical, "critical").when(warning, "warning").otherwise("healthy"),
            "reasons": F.when(empty, F.array(F.lit("no_nodes"))).when(F.size(reasons) == 0, F.array(F.lit("healthy"))).otherwise(reasons),
        }
    )


def latest_run_status(status_events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(current state per run with a terminal flag, events whose status is unknown)."""
    known = F.col("status").isin(*KNOWN_STATUSES)
    good = status_events.filter(known)
    tie = "event_id" if "event_id" in status_events.columns else None
    current = latest_per_key(good, ["run_id"], "ts", tie)
    rejected = status_events.filter(~F.coalesce(known, F.lit(False)))
    return current.withColumn("terminal", F.col("status").isin(*TERMINAL)), rejected
