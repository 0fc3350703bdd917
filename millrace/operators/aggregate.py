"""Grouping: joins turned into aggregations, and the aggregates whose exact form needs care."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import rules
from millrace.functions.ordered import running_total
from millrace.operators.joins import join_on_common


def join_to_aggregation(
    dfs: dict[str, DataFrame],
    group_by: list[str],
    aggs: dict[str, str],
    how: str = "inner",
    overrides: dict[tuple[str, str], list[tuple[str, str]]] | None = None,
) -> DataFrame:
    """Join on common columns, then group.

    A group column is named after its last path segment and marked as business key, an aggregate
    as change-tracked, both in the column metadata. Window functions are refused.
    """
    bad = [n for n, e in aggs.items() if re.search(rules.WINDOW_PATTERN, e)]
    if bad:
        raise ValueError(f"window functions cannot be grouped: {', '.join(bad)}")
    joined = join_on_common(dfs, how, overrides) if len(dfs) > 1 else next(iter(dfs.values()))
    keys = [F.expr(_unqualified(g, dfs)).alias(_last_segment(g), metadata={"isBusinessKey": True}) for g in group_by]
    measures = [F.expr(e).alias(n, metadata={"isChangeTracking": True}) for n, e in aggs.items()]
    return joined.groupBy(*keys).agg(*measures)


def _last_segment(path: str) -> str:
    return path.split(".")[-1].strip('"`')


def _unqualified(path: str, dfs: dict[str, DataFrame]) -> str:
    head, _, tail = path.partition(".")
    return f"`{_last_segment(tail)}`" if tail and head.strip('"`') in dfs else path


def analyze_group_by(columns: DataFrame, strict: bool = True) -> DataFrame:
    """Per column of a node: aggregate, window or group column, and what that means for the node.

    Output rows, not lists: node_id, name, transform, kind, has_aggregates, has_window, valid,
    needs_group_by.
    """
    text = F.coalesce("transform", F.lit(""))
    kind = (
        F.when(rules.is_aggregate(text, strict), "aggregate").when(rules.is_window(text, strict), "window").otherwise("group")
    )
    rows = columns.withColumn("kind", kind)
    facts = rows.groupBy("node_id").agg(
        F.bool_or(F.col("kind") != "group").alias("has_aggregates"),
        F.bool_or(F.col("kind") == "window").alias("has_window"),
        F.bool_or(F.col("kind") == "group").alias("__groups"),
    )
    return rows.join(facts, "node_id").select(
        "node_id",
        "name",
        "transform",
        "kind",
        "has_aggregates",
        "has_window",
        (~F.col("has_window")).alias("valid"),
        (F.col("has_aggregates") & F.col("__groups")).alias("needs_group_by"),
    )


def group_by_all(df: DataFrame, aggs: dict[str, str], others: list[str]) -> DataFrame:
    """GROUP BY ALL: every selected column that is no aggregate is a key."""
    items = [*others, *[f"{e} AS {n}" for n, e in aggs.items()]]
    return df.sparkSession.sql(f"SELECT {', '.join(items)} FROM {{source}} GROUP BY ALL", source=df)


def global_aggregate(df: DataFrame, aggs: dict[str, str]) -> DataFrame:
    return df.agg(*[F.expr(e).alias(n) for n, e in aggs.items()])


def distinct_list(df: DataFrame, keys: list[str], value: str, name: str, separator: str | None = None) -> DataFrame:
    """LISTAGG / ARRAY_AGG of the distinct values of a key, sorted.

    Values are made distinct before they are gathered, so a list is as long as the vocabulary of the
    column, not as the group.
    """
    found = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    listed = F.sort_array(F.collect_set(value))
    return found.groupBy(*keys).agg((F.array_join(listed, separator) if separator is not None else listed).alias(name))


def ordered_list(df: DataFrame, keys: list[str], value: str, order: str, tie: str, name: str, separator: str | None = None) -> DataFrame:
    """LISTAGG / ARRAY_AGG of all values of a key, repeats too, by ``order`` and then ``tie``.

    A list is as long as its group, as its definition has it; where groups are large and only the values
    matter, ``distinct_list`` stays small. Null values are left out, as both functions do.
    """
    rows = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("o"), F.col(tie).alias("t"), F.col(value).alias("v")))))
    listed = F.transform(rows, lambda r: r["v"])
    return df.groupBy(*keys).agg((F.array_join(listed, separator) if separator is not None else listed).alias(name))


def exact_mode(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Most frequent value per key, lowest on a tie; counted per (key, value) first."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    first = F.min(F.struct((-F.col("__n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(first["v"].alias(name))


def exact_median(df: DataFrame, keys: list[str], value: str, name: str, **options: int) -> DataFrame:
    """Exact median per key from the running count of its distinct values.

    The built-in median keeps all the distinct values of a group in one task; here the counts of a hot
    key stay spread over ordered buckets.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    upto = running_total(counts, keys, value, None, F.col("__n"), "__upto", **options)
    total = counts.groupBy(*keys).agg(F.sum("__n").alias("__total"))
    right = total.select(*[F.col(k).alias(f"__{k}") for k in keys], "__total")
    rows = upto.join(right, [upto[k].eqNullSafe(right[f"__{k}"]) for k in keys])
    low, high = F.floor((F.col("__total") + 1) / 2), F.floor((F.col("__total") + 2) / 2)
    start = F.col("__upto") - F.col("__n")

    def at(position: Column) -> Column:
        return F.max(F.when((position > start) & (position <= F.col("__upto")), F.col(value)))

    return rows.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias(name))


def sketch_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Approximate distinct counts by two sketches; both merge map-side."""
    return df.groupBy(*keys).agg(
        F.approx_count_distinct(value).alias("approx_count"),
        F.hll_sketch_estimate(F.hll_sketch_agg(value)).alias("hll_count"),
    )


def select_distinct(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()
