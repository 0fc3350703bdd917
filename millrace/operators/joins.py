"""Joining frames on the columns they share, and judging joins before running them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.names import norm
from millrace.functions.spread import spread

JOIN_TYPES = ("inner", "left", "right", "full")


# ---- over a catalogue ---------------------------------------------------------------------


def key_holders(columns: DataFrame) -> DataFrame:
    """Which predecessor of a node holds which normalised column name; first spelling wins.

    Input: node_id, pos (order of the predecessor), pred_id, ordinal, name.
    """
    return columns.groupBy("node_id", "pos", "pred_id", norm("name").alias("key")).agg(
        F.min_by("name", "ordinal").alias("name")
    )


def suggest_joins(columns: DataFrame) -> DataFrame:
    """For every predecessor of a node, the earliest one before it that shares columns, and which.

    This is the pair a left-to-right join chain uses. It is found from the first holder of every
    name, so the work and the output grow with the columns, not with pairs of predecessors; the
    shared columns of any other pair come from ``common_columns``.
    """
    holders = key_holders(columns)
    first = holders.groupBy("node_id", "key").agg(F.min("pos").alias("first_pos"))
    partner = (
        holders.join(spread(first), ["node_id", "key"])
        .filter(F.col("first_pos") < F.col("pos"))
        .groupBy("node_id", "pos")
        .agg(F.min("first_pos").alias("left_pos"))
        .select("node_id", "left_pos", F.col("pos").alias("right_pos"))
    )
    return common_columns(holders, partner)


def common_columns(holders: DataFrame, pairs: DataFrame) -> DataFrame:
    """Shared columns of the given (node_id, left_pos, right_pos) pairs."""
    left = holders.select(
        "node_id", F.col("pos").alias("left_pos"), F.col("pred_id").alias("left_id"), "key", F.col("name").alias("left_name")
    )
    right = holders.select(
        "node_id", F.col("pos").alias("right_pos"), F.col("pred_id").alias("right_id"), "key", F.col("name").alias("right_name")
    )
    return pairs.join(spread(right), ["node_id", "right_pos"]).join(spread(left), ["node_id", "left_pos", "key"]).select(
        "node_id", "left_pos", "right_pos", "left_id", "right_id", "key", "left_name", "right_name"
    )


def predecessor_coverage(refs: DataFrame, expected: DataFrame) -> DataFrame:
    """Is every expected predecessor (node_id, pred_id) used by at least one column reference?"""
    used = refs.select(F.col("dst_node").alias("node_id"), F.col("src_node").alias("pred_id")).distinct()
    flagged = expected.distinct().join(used.withColumn("referenced", F.lit(True)), ["node_id", "pred_id"], "left")
    flagged = flagged.withColumn("referenced", F.coalesce("referenced", F.lit(False)))
    whole = flagged.groupBy("node_id").agg(F.bool_and("referenced").alias("all_represented"))
    return flagged.join(whole, "node_id")


# ---- over data -----------------------------------------------------------------------------


@dataclass
class JoinStep:
    right: str
    left: str
    keys: list[tuple[str, str]] = field(default_factory=list)


def plan_join_chain(
    columns: dict[str, list[str]], overrides: dict[tuple[str, str], list[tuple[str, str]]] | None = None
) -> list[JoinStep]:
    """Pick, for each source after the first, an earlier source and the keys between them.

    Overrides for a pair replace its common columns. A source that shares nothing with the first
    one is tried against later ones; if none fits, this fails by name rather than joining on nothing.
    """
    overrides = overrides or {}
    names = list(columns)
    by_key = {n: {} for n in names}
    for n in names:
        for c in columns[n]:
            by_key[n].setdefault(c.strip().upper(), c)
    steps, joined, waiting = [], names[:1], names[1:]
    while waiting:
        for right in waiting:
            step = _step(right, joined, by_key, overrides)
            if step:
                break
        else:
            raise ValueError(f"no join keys found for: {', '.join(waiting)}; give overrides")
        steps.append(step)
        joined.append(step.right)
        waiting.remove(step.right)
    return steps


def _step(right, joined, by_key, overrides):
    for left in joined:
        keys = overrides.get((left, right))
        if not keys:
            keys = [(by_key[left][k], by_key[right][k]) for k in sorted(by_key[left].keys() & by_key[right].keys())]
        if keys:
            return JoinStep(right, left, keys)
    return None


def join_on_common(
    dfs: dict[str, DataFrame],
    how: str = "inner",
    overrides: dict[tuple[str, str], list[tuple[str, str]]] | None = None,
) -> DataFrame:
    """Join a chain of frames left to right on their common columns.

    A key of the same name appears once (the first non-null side); any other repeated name is
    prefixed with its source.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"how must be one of {', '.join(JOIN_TYPES)}")
    steps = plan_join_chain({n: df.columns for n, df in dfs.items()}, overrides)
    order = [next(iter(dfs)), *[s.right for s in steps]]
    out = dfs[order[0]].alias(order[0])
    merged: dict[tuple[str, str], tuple[str, str]] = {}
    for s in steps:
        on = reduce(Column.__and__, [F.col(f"{s.left}.{a}") == F.col(f"{s.right}.{b}") for a, b in s.keys])
        out = out.join(dfs[s.right].alias(s.right), on, how)
        for a, b in s.keys:
            if a.strip().upper() == b.strip().upper():
                merged[(s.right, b)] = merged.get((s.left, a), (s.left, a))
    picked: dict[str, Column] = {}
    shared: dict[tuple[str, str], list[Column]] = {}
    for (src, c), home in merged.items():
        shared.setdefault(home, []).append(F.col(f"{src}.{c}"))
    for src in order:
        for c in dfs[src].columns:
            if (src, c) in merged:
                continue
            same = shared.get((src, c), [])
            value = F.coalesce(F.col(f"{src}.{c}"), *same) if same and how != "inner" else F.col(f"{src}.{c}")
            taken = {p.upper() for p in picked}
            picked[c if c.upper() not in taken else f"{src}_{c}"] = value
    return out.select(*[v.alias(n) for n, v in picked.items()])


def join_bare(dfs: dict[str, DataFrame], how: str = "inner") -> DataFrame:
    """As ``join_on_common`` without overrides; it fails when two frames share no column."""
    return join_on_common(dfs, how)


def equi_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Join on named pairs, keeping both sides' columns."""
    return left.join(right, reduce(Column.__and__, [left[a] == right[b] for a, b in keys]), how)


def join_using(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    return left.join(right, columns, how)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all columns of the same name; fails when there are none."""
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("a natural join needs a common column")
    return left.join(right, common, how)


def comma_join(dfs: dict[str, DataFrame], pairs: list[tuple[str, str]], where: str | None = None) -> DataFrame:
    """FROM a, b, c WHERE a.x = b.y AND ...: ``pairs`` are the equalities as ``alias.column`` text.

    Every source must be tied to the ones before it; a list without keys would be a product.
    """
    names = list(dfs)
    out, seen = dfs[names[0]].alias(names[0]), {names[0]}
    for n in names[1:]:
        seen.add(n)
        usable = [(a, b) for a, b in pairs if n in (_owner(a), _owner(b)) and {_owner(a), _owner(b)} <= seen]
        if not usable:
            raise ValueError(f"no equality ties {n} to the sources before it")
        out = out.join(dfs[n].alias(n), reduce(Column.__and__, [F.col(a) == F.col(b) for a, b in usable]))
    return out.filter(where) if where else out


def _owner(qualified: str) -> str:
    return qualified.split(".", 1)[0]


def lateral_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """``right`` may use ``F.col(..).outer()`` to see the current left row."""
    return left.lateralJoin(right, how=how)


def theta_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], condition: str, how: str = "inner") -> DataFrame:
    """Equal keys plus any further condition; the keys keep it a hash or merge join."""
    on = reduce(Column.__and__, [left[a] == right[b] for a, b in keys]) & F.expr(condition)
    return left.join(right, on, how)


def join_cardinality(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """One row: is each side unique on the keys, and how many rows would an inner join give?

    Only per-key counts are joined, so the join's own fan-out is never produced.
    """
    names = [f"k{i}" for i in range(len(keys))]
    known = F.expr(" AND ".join(f"{n} IS NOT NULL" for n in names))
    lc = left.groupBy(*[F.col(a).alias(n) for (a, _), n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("l")).filter(known)
    rc = right.groupBy(*[F.col(b).alias(n) for (_, b), n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("r")).filter(known)
    return lc.join(rc, names, "full").agg(
        (F.coalesce(F.max("l"), F.lit(0)) <= 1).alias("left_unique"),
        (F.coalesce(F.max("r"), F.lit(0)) <= 1).alias("right_unique"),
        F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).cast("long").alias("predicted_rows"),
        F.coalesce(F.sum("l"), F.lit(0)).cast("long").alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).cast("long").alias("right_rows"),
    )
