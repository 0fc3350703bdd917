"""Comparing schema versions and stored SQL across a whole catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.names import norm, norm_expression, squeeze
from millrace.functions.spread import spread
from millrace.operators.graph import source_names
from millrace.operators.joins import predecessor_coverage
from millrace.sources.scratch import Scratch

# ---- column versions -----------------------------------------------------------------------


def _by_name(columns: DataFrame) -> DataFrame:
    """Last spelling of a repeated name wins."""
    row = F.struct(*[F.col(c) for c in columns.columns])
    return columns.groupBy("node_id", norm("name").alias("key")).agg(F.max_by(row, "ordinal").alias("r"))


def is_null_placeholder(expression: Column) -> Column:
    return F.upper(norm_expression(expression)) == "NULL"


def diff_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    """(node_id, before_key, after_key, change) with change one of unchanged, type_changed,
    expression_changed, renamed, removed, added; a column may have two rows.

    Both: node_id, ordinal, name, data_type, expression (null in ``after`` for a definition without
    expressions). Names match first. What is left over is a rename if exactly one removed and one added
    column of the node share an expression, or stand at the same position with the same type.
    """
    b = _by_name(before).select("node_id", "key", F.col("r").alias("b"))
    a = _by_name(after).select("node_id", "key", F.col("r").alias("a"))
    # Read five times below, so written once.
    both = Scratch(before.sparkSession, "versions").write(b.join(spread(a), ["node_id", "key"], "full"), "matched")
    old_expr, new_expr = F.coalesce("b.expression", F.lit("")), F.col("a.expression")
    retyped = (F.coalesce("a.data_type", F.lit("")) != "") & ~norm("a.data_type").eqNullSafe(norm("b.data_type"))
    blank = (old_expr == "") & ((new_expr == "") | is_null_placeholder(new_expr))
    rewritten = new_expr.isNotNull() & ~blank & (norm_expression(new_expr) != norm_expression(old_expr))
    matched = both.filter("a IS NOT NULL AND b IS NOT NULL").select(
        "node_id", "key", retyped.alias("retyped"), rewritten.alias("rewritten")
    )
    change = F.array_compact(
        F.array(
            F.when(F.col("retyped"), F.lit("type_changed")),
            F.when(F.col("rewritten"), F.lit("expression_changed")),
            F.when(~F.col("retyped") & ~F.col("rewritten"), F.lit("unchanged")),
        )
    )
    same = matched.select("node_id", F.col("key").alias("before_key"), F.col("key").alias("after_key"), F.explode(change).alias("change"))

    removed = both.filter("a IS NULL").select(
        "node_id",
        F.col("key").alias("before_key"),
        F.col("b.ordinal").alias("ordinal"),
        norm(F.coalesce("b.data_type", F.lit(""))).alias("b_type"),
        norm_expression(F.coalesce("b.expression", F.lit(""))).alias("expr"),
    )
    added = both.filter("b IS NULL").select(
        "node_id",
        F.col("key").alias("after_key"),
        F.col("a.ordinal").alias("ordinal"),
        norm(F.coalesce("a.data_type", F.lit(""))).alias("a_type"),
        norm_expression(F.coalesce("a.expression", F.lit(""))).alias("expr"),
    )

    def single(df: DataFrame, key: str, kind: str) -> DataFrame:
        lone = df.filter("expr <> ''").groupBy("node_id", "expr").agg(
            F.count(F.lit(1)).alias("n"), F.min(key).alias(key), F.min(kind).alias(kind)
        )
        return lone.filter("n = 1").drop("n")

    by_expr = single(removed, "before_key", "b_type").join(spread(single(added, "after_key", "a_type")), ["node_id", "expr"])
    by_expr = by_expr.select(
        "node_id", "before_key", "after_key", ((F.col("a_type") != "") & (F.col("a_type") != F.col("b_type"))).alias("retyped")
    )
    rest_removed = removed.join(spread(by_expr), ["node_id", "before_key"], "left_anti")
    rest_added = added.join(spread(by_expr), ["node_id", "after_key"], "left_anti")
    by_place = (
        rest_removed.join(spread(rest_added.drop("expr")), ["node_id", "ordinal"])
        .filter("a_type <> '' AND a_type = b_type")
        .select("node_id", "before_key", "after_key", F.lit(False).alias("retyped"))
    )
    renames = by_expr.unionByName(by_place)
    named = F.array_compact(F.array(F.lit("renamed"), F.when(F.col("retyped"), F.lit("type_changed"))))
    moved = renames.select("node_id", "before_key", "after_key", F.explode(named).alias("change"))
    gone = rest_removed.join(spread(by_place), ["node_id", "before_key"], "left_anti").select(
        "node_id", "before_key", F.lit(None).cast("string").alias("after_key"), F.lit("removed").alias("change")
    )
    new = rest_added.join(spread(by_place), ["node_id", "after_key"], "left_anti").select(
        "node_id", F.lit(None).cast("string").alias("before_key"), "after_key", F.lit("added").alias("change")
    )
    return same.unionByName(moved).unionByName(gone).unionByName(new)


def merge_schema_versions(before: DataFrame, after: DataFrame, changes: DataFrame) -> DataFrame:
    """The new version in its own order: surviving columns keep id and description, added ones get new.

    A rename whose old row is missing from ``before`` fails the job rather than losing the column.
    """
    link = changes.filter("after_key IS NOT NULL").groupBy("node_id", "after_key").agg(
        F.max("before_key").alias("before_key"),
        F.bool_or(F.col("change") == "renamed").alias("renamed"),
        F.bool_or(F.col("change") == "added").alias("added"),
        F.bool_or(F.col("change") == "expression_changed").alias("rewritten"),
    )
    b = _by_name(before).select("node_id", F.col("key").alias("before_key"), F.col("r").alias("b"))
    rows = (
        after.withColumn("after_key", norm("name")).join(link, ["node_id", "after_key"]).join(b, ["node_id", "before_key"], "left")
    )
    lost = F.col("b").isNull() & ~F.col("added")
    fresh = F.concat(F.lit("new-"), F.md5(F.concat_ws("|", F.col("node_id").cast("string"), "after_key")))
    kept_id = F.when(lost, F.raise_error(F.lit("a matched column has no row in the old version")).cast("string"))
    empty_type = F.coalesce("data_type", F.lit("")) == ""
    return rows.select(
        "node_id",
        "ordinal",
        F.coalesce(kept_id, F.col("b.column_id").cast("string"), fresh).alias("column_id"),
        "name",
        F.when(empty_type, F.col("b.data_type")).otherwise(F.col("data_type")).alias("data_type"),
        F.when(F.col("added") | F.col("rewritten"), F.coalesce("expression", F.lit(""))).otherwise(F.col("b.expression")).alias("expression"),
        F.coalesce("b.description", F.lit("")).alias("description"),
        F.when(F.col("added"), "added").when(F.col("renamed"), "renamed").otherwise("kept").alias("origin"),
    )


# ---- stored SQL ------------------------------------------------------------------------------

IDENT = r"\"[A-Za-z_][\w$]*\""
NAME = r"\"([A-Za-z_][\w$]*)\""
# Characters that stand for what a mask hides: a bracket with all in it, a quoted name, a literal.
INNER, QUOTED, LITERAL = "\x01", "\x02", "\x03"
_PIECES = r"(?s)(--[^\n]*|/\*.*?\*/|'(?:[^']|'')*'|\"[^\"]*\"|`[^`]*`|[^-/'\"`]+|.)"
_BRACKETS = r"(?s)(\([^()]*\)|[^()]+|[()])"


def _fill(piece: Column, with_: str) -> Column:
    return F.repeat(F.lit(with_), F.length(piece))


def _pieces(sql: Column, change) -> Column:
    return F.array_join(F.transform(F.regexp_extract_all(sql, F.lit(_PIECES), F.lit(1)), change), "")


def _is_comment(piece: Column) -> Column:
    return piece.startswith("--") | piece.startswith("/*")


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are made once for each row. As a row of its own, a text is not made again by each expression
    and filter that reads it, as the optimizer would have it for a plain column."""
    made = F.inline(F.array(F.struct(*[v.alias(n) for n, v in columns.items()])))
    return df.select("*", made)


def strip_comments(sql: Column) -> Column:
    """Without comments; what looks like one inside quotes stays."""
    return _pieces(sql, lambda t: F.when(_is_comment(t), "").otherwise(t))


def masked(sql: Column, names: bool = True) -> Column:
    """The text at the same length with comments blank and literals hidden.

    Quoted names stay if ``names`` is set and they hold no keyword, bracket or comma; else they are hidden too.
    """
    kept = r"(?is)^(?!.*\b(?:from|join|group|order|limit|offset|having|qualify)\b)[^(),;]*$" if names else "^$"
    return _pieces(
        sql,
        lambda t: F.when(_is_comment(t), _fill(t, " "))
        .when(t.startswith("'") & (F.length(t) > 1), _fill(t, LITERAL))
        .when((t.startswith('"') | t.startswith("`")) & (F.length(t) > 1) & ~t.rlike(kept), _fill(t, QUOTED))
        .otherwise(t),
    )


def flat(sql: Column, names: bool = True) -> Column:
    """The masked text at the same length with every bracket and all in it hidden, at any depth.

    The innermost brackets are hidden again and again; a bracket that is left over has no partner.
    """
    text = masked(sql, names)
    hide = lambda m: F.array_join(
        F.transform(F.regexp_extract_all(m, F.lit(_BRACKETS), F.lit(1)), lambda t: F.when(t.startswith("(") & t.endswith(")"), _fill(t, INNER)).otherwise(t)), ""
    )
    count = F.size(F.split(text, r"\(")) - 1
    rounds = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rounds, text, lambda m, _: F.when(F.contains(m, F.lit("(")), hide(m)).otherwise(m))


def top_level(sql: Column) -> Column:
    """Masked text with everything in brackets taken out, at any depth."""
    return F.regexp_replace(F.regexp_replace(flat(sql), f"{INNER}+", "()"), f"{LITERAL}+", "''")


def balanced(mask: Column) -> Column:
    return ~F.coalesce(mask, F.lit("")).rlike("[()]")


def from_block(sql: Column, mask: Column) -> Column:
    """FROM, JOIN and WHERE of a statement's outer query; empty when it has none.

    ``mask`` is ``flat(sql, names=False)``: keywords inside brackets, literals and quoted names do not end it.
    """
    start = F.regexp_instr(mask, F.lit(r"(?i)\bfrom\b"))
    behind = F.substring(mask, start, F.length(mask))
    end = F.regexp_instr(behind, F.lit(r"(?i)\b(?:group|order|limit|having|qualify)\b|;"))
    size = F.when(end > 0, end - 1).otherwise(F.length(behind))
    return strip_comments(F.when(start > 0, F.substring(sql, start, size)).when(sql.isNotNull(), ""))


def as_refs(block: Column) -> Column:
    """Write table names the way ref() calls do, so that both spellings compare equal."""
    three = F.regexp_replace(block, rf"{IDENT}\s*\.\s*{NAME}\s*\.\s*{NAME}", "{{ ref('$1', '$2') }}")
    return F.regexp_replace(three, rf"(?i)(\bFROM|\bJOIN|,)\s*{NAME}\s*\.\s*{NAME}(?!\s*\.)", "$1 {{ ref('$2', '$3') }}")


def normal_form(block: Column) -> Column:
    """Comments out, whitespace collapsed, text outside identifier quotes lower-cased."""
    flat = norm_expression(strip_comments(block))
    pieces = F.regexp_extract_all(flat, F.lit(r"(\"[^\"]*\"|`[^`]*`|\[[^\]]*\]|[^\"`\[]+|.)"), F.lit(1))
    quoted = lambda p: p.rlike(r"^(\".*\"|`.*`|\[.*\])$")
    return F.array_join(F.transform(pieces, lambda p: F.when(quoted(p), p).otherwise(F.lower(p))), "")


def diff_sources(corpus: DataFrame, before: str = "before_sql", after: str = "after_sql") -> DataFrame:
    """Per statement: identical, new_source, removed_source, where_or_join_edit or unsupported.

    ``before`` is the stored FROM / JOIN / WHERE text or a whole statement, ``after`` the edited one.
    """
    # A column of its own for each mask, so that it is made once.
    texts = corpus.select("node_id", F.col(before).alias("__before"), F.col(after).alias("__sql"))
    texts = _once(texts, __mb=flat(F.col("__before"), False), __ma=flat(F.col("__sql"), False))
    b, a = from_block(F.col("__before"), F.col("__mb")), from_block(F.col("__sql"), F.col("__ma"))

    def keys(block: Column) -> Column:
        pairs = source_names(block)
        return F.array_distinct(F.transform(pairs, lambda s: F.concat_ws("::", F.upper(s["location"]), F.upper(s["name"]))))

    rows = _once(_once(texts, __b=b, __a=a), b_keys=keys(F.col("__b")), a_keys=keys(F.col("__a")))
    rows = rows.withColumns(
        {"added": F.sort_array(F.array_except("a_keys", "b_keys")), "removed": F.sort_array(F.array_except("b_keys", "a_keys"))}
    )
    verdict = (
        F.when(strip_comments(F.col("__sql")).rlike(r"(?is)^\s*with\b") | ~balanced(F.col("__ma")) | ~balanced(F.col("__mb")), "unsupported")
        .when(F.col("__a") == "", "identical")
        .when(F.size("added") > 0, "new_source")
        .when(F.size("removed") > 0, "removed_source")
        .when(normal_form(as_refs(F.col("__a"))) == normal_form(as_refs(F.col("__b"))), "identical")
        .otherwise("where_or_join_edit")
    )
    return rows.select("node_id", verdict.alias("verdict"), "added", "removed")


PLAIN_REF = (
    r"^(?:\"[^\"]+\"|`[^`]+`|\[[^\]]+\]|[A-Za-z_][\w$]*)"
    r"(?:\s*\.\s*(?:\"[^\"]+\"|`[^`]+`|\[[^\]]+\]|[A-Za-z_][\w$]*))*$"
)


def order_items(sql: Column, top: Column | None = None) -> Column:
    """Plain ORDER BY columns as (name, direction); other expressions are left out. ``top``: ``top_level(sql)`` if it is at hand."""
    clause = F.regexp_extract(top_level(sql) if top is None else top, r"(?is)\border\s+by\s+(.*?)(?=\blimit\b|\boffset\b|;|$)", 1)
    bare = F.transform(F.split(clause, ","), lambda i: F.regexp_replace(F.trim(i), r"(?i)\s+nulls\s+(first|last)\s*$", ""))
    direction = lambda i: F.when(i.rlike(r"(?i)\sdesc$"), "desc").otherwise("asc")
    named = F.transform(
        bare, lambda i: F.struct(F.trim(F.regexp_replace(i, r"(?i)\s+(asc|desc)$", "")).alias("e"), direction(i).alias("d"))
    )
    plain = F.filter(named, lambda i: i["e"].rlike(PLAIN_REF))
    last = lambda e: F.regexp_extract(e, r"(\"[^\"]*\"|`[^`]*`|\[[^\]]*\]|[\w$]+)$", 1)
    return F.transform(
        plain, lambda i: F.struct(F.upper(F.regexp_replace(last(i["e"]), r"^[\"`\[]|[\"`\]]$", "")).alias("name"), i["d"].alias("direction"))
    )


def limit_value(sql: Column, top: Column | None = None) -> Column:
    """The number of a plain trailing LIMIT, -1 for an offset or range form, null for none."""
    top = top_level(sql) if top is None else top
    tail = F.regexp_extract(top, r"(?is)\blimit\s+(\d+)\s*([^;]*)", 1)
    rest = F.trim(F.regexp_extract(top, r"(?is)\blimit\s+(\d+)\s*([^;]*)", 2))
    return F.when(tail == "", None).when(rest == "", tail.cast("int")).when(rest.rlike(r"(?i)^,\s*\d+|^offset\b"), -1)


def diff_tail(corpus: DataFrame) -> DataFrame:
    """GROUP BY, ORDER BY and LIMIT of an edited statement against the stored settings.

    Input: node_id, sql, group_by_all, order_by (booleans), order_items (array of name, direction),
    join_condition (holds the stored LIMIT).
    """
    sql, top, old_top = F.col("sql"), F.col("__top"), F.col("__old_top")
    tops = _once(corpus, __top=top_level(sql), __old_top=top_level(F.col("join_condition")))
    old_limit = limit_value(F.col("join_condition"), old_top)
    rows = _once(
        tops,
        __grouped=top.rlike(r"(?i)\bgroup\s+by\b"),
        __ordered=top.rlike(r"(?i)\border\s+by\b"),
        __items=order_items(sql, top),
        __limit=limit_value(sql, top),
        __old_limit=F.when(old_limit >= 0, old_limit),
    )
    had_group, had_order = F.coalesce("group_by_all", F.lit(False)), F.coalesce("order_by", F.lit(False))
    has_items = F.size("__items") > 0
    group_change = F.when(F.col("__grouped") == had_group, "identical").when(F.col("__grouped"), "added").otherwise("removed")
    order_change = (
        F.when(F.col("__ordered") & ~has_items, "identical")
        .when(~has_items & ~had_order, "identical")
        .when(~has_items, "removed")
        .when(~had_order, "added")
        .when(F.col("__items") == F.col("order_items"), "identical")
        .otherwise("changed")
    )
    new, old = F.col("__limit"), F.col("__old_limit")
    limit_change = (
        F.when(new == -1, "unsupported").when(new.eqNullSafe(old), "identical").when(new.isNull(), "removed").when(old.isNull(), "added").otherwise("changed")
    )
    return rows.select(
        "node_id",
        group_change.alias("group_by"),
        order_change.alias("order_by"),
        limit_change.alias("limit_change"),
        (limit_change.isin("added", "changed") & (had_group | had_order)).alias("limit_misplaced"),
    )


def lint_sql(corpus: DataFrame, sql: str = "sql") -> DataFrame:
    """Double-quoted ref() is an error; UNION ALL outside comments a warning. One row per issue."""
    text = F.col(sql)
    issues = F.array_compact(
        F.array(
            F.when(text.rlike(r"\bref\s*\(\s*\""), F.struct(F.lit("error").alias("level"), F.lit("SQL_DOUBLE_QUOTED_REF").alias("code"))),
            F.when(
                strip_comments(text).rlike(r"(?i)\bUNION\s+ALL\b"),
                F.struct(F.lit("warning").alias("level"), F.lit("SQL_LITERAL_UNION_ALL").alias("code")),
            ),
        )
    )
    return corpus.select("node_id", F.inline(issues))


def lint_selectors(jobs: DataFrame) -> DataFrame:
    """Selectors that put ``||`` inside one pair of braces, outside quotes."""
    sides = F.array(
        F.struct(F.lit("include").alias("side"), F.col("include_selector").alias("selector")),
        F.struct(F.lit("exclude").alias("side"), F.col("exclude_selector").alias("selector")),
    )
    bare = F.regexp_replace("selector", r"\"[^\"]*\"|'[^']*'", "")
    rows = jobs.select("job_id", F.inline(sides)).filter(bare.rlike(r"\{[^{}]*\|\|[^{}]*\}"))
    return rows.select("job_id", "side", F.lit("error").alias("level"), F.lit("SELECTOR_COMBINED_OR").alias("code"))


def validate_expected(
    saved: dict[str, DataFrame], expected: dict[str, DataFrame]
) -> DataFrame:
    """Does each saved node hold what was planned? Four flags per node.

    Both hold ``columns`` (node_id, ordinal, name), ``dependencies`` (node_id, location, name) and
    ``joins`` (node_id, join_condition); ``saved`` also ``refs`` (src_node, dst_node) and ``expected``
    also ``predecessors`` (node_id, pred_id). Lists compare row by row, never as gathered arrays.
    """

    def side(df: DataFrame, key: list[Column], flag: str) -> DataFrame:
        return df.select("node_id", *key).distinct().withColumn(flag, F.lit(True))

    def equal(left: DataFrame, right: DataFrame, key: list[Column], names: list[str], out: str) -> DataFrame:
        both = side(left, key, "__l").join(side(right, key, "__r"), ["node_id", *names], "full")
        return both.groupBy("node_id").agg(F.bool_and(F.col("__l").isNotNull() & F.col("__r").isNotNull()).alias(out))

    cols = equal(saved["columns"], expected["columns"], [F.col("ordinal"), norm("name").alias("key")], ["ordinal", "key"], "columns_ok")
    deps = equal(
        saved["dependencies"],
        expected["dependencies"],
        [norm(F.coalesce("location", F.lit(""))).alias("loc"), norm("name").alias("key")],
        ["loc", "key"],
        "dependencies_ok",
    )
    s = saved["joins"].select("node_id", squeeze(F.coalesce("join_condition", F.lit(""))).alias("s"))
    e = expected["joins"].select("node_id", squeeze(F.coalesce("join_condition", F.lit(""))).alias("e"))
    text = e.join(s, "node_id", "left").select("node_id", (F.coalesce("s", F.lit("")) == F.col("e")).alias("join_ok"))
    cover = predecessor_coverage(saved["refs"], expected["predecessors"]).groupBy("node_id").agg(
        F.bool_and("referenced").alias("coverage_ok")
    )
    out = text
    for part in (cols, deps, cover):
        out = out.join(part, "node_id", "left")
    return out.fillna(True, ["columns_ok", "dependencies_ok", "coverage_ok"])


# ---- statement profile -----------------------------------------------------------------------

CTE = rf"(?is)(?:\bWITH\s+(?:RECURSIVE\s+)?|{INNER}\s*,\s*)(\w+)\s+AS\s*(?={INNER})"


def _kind(grouped: Column, joined: Column) -> Column:
    return F.when(grouped, "aggregation").when(joined, "multiSource").otherwise("staging")


def cte_profile(corpus: DataFrame, sql: str = "sql") -> DataFrame:
    """One row per CTE: its position, what it does, and which other CTEs it names."""
    rows = _once(corpus.select("node_id", F.col(sql).alias("sql")), text=masked(F.col("sql"))).filter(F.col("text").rlike(r"(?is)^\s*WITH\b"))
    rows = _once(rows.select("node_id", "sql", "text"), mask=flat(F.col("sql"))).drop("sql")
    rows = _once(rows, names=F.transform(F.regexp_extract_all("mask", F.lit(CTE), F.lit(1)), F.upper))
    rows = rows.select("*", F.posexplode("names").alias("position", "cte"))
    # The mask is as long as the text, so that a place found in one holds in the other.
    whole = F.concat(F.lit(r"(?is)\b"), "cte", F.lit(rf"\s+AS\s*{INNER}+"))
    rows = rows.withColumn("body", F.substring("text", F.regexp_instr("mask", whole), F.length(F.regexp_extract_all("mask", whole, F.lit(0))[0])))
    rows = _once(rows.withColumnRenamed("body", "whole"), body=F.regexp_extract("whole", r"(?is)\bAS\s*(\(.*)$", 1))
    words = F.transform(F.regexp_extract_all("body", F.lit(r"(\w+)"), F.lit(1)), F.upper)
    used = F.sort_array(F.array_except(F.array_intersect("names", words), F.array("cte")))
    joined, grouped = F.col("body").rlike(r"(?i)\bJOIN\b"), F.col("body").rlike(r"(?i)\bGROUP\s+BY\b")
    return rows.select(
        "node_id", "position", "cte", joined.alias("has_join"), grouped.alias("has_group_by"), _kind(grouped, joined).alias("kind"), used.alias("depends_on")
    )


def sql_profile(corpus: DataFrame, sql: str = "sql") -> DataFrame:
    """Headline facts of each statement's outer query: sources, join, grouping, number of CTEs."""
    text, mask, top = masked(F.col(sql)), flat(F.col(sql)), top_level(F.col(sql))
    from_part = F.regexp_extract(top, r"(?is)\bfrom\b(.*?)(?=\bwhere\b|\bgroup\b|\border\b|\blimit\b|\bhaving\b|\bqualify\b|\bunion\b|;|$)", 1)
    # Braces of ref() hold a comma of their own once parentheses are gone: {{ ref() }} has none left.
    sources = F.size(F.split(from_part, r"(?i)\bjoin\b|,"))
    is_cte = text.rlike(r"(?is)^\s*WITH\b")
    joined, grouped = F.col("sources") > 1, F.col("has_group_by")
    rows = corpus.select(
        "node_id",
        F.when(F.trim(from_part) == "", 0).otherwise(sources).alias("sources"),
        top.rlike(r"(?i)\bgroup\s+by\b").alias("has_group_by"),
        F.when(is_cte, F.size(F.regexp_extract_all(mask, F.lit(CTE), F.lit(1)))).otherwise(0).alias("ctes"),
    )
    return rows.select("node_id", "sources", joined.alias("has_join"), "has_group_by", "ctes", _kind(grouped, joined).alias("kind"))
