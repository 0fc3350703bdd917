"""A statement's CTEs as separate steps, run in dependency order, each one stored or a view."""

from __future__ import annotations

import re
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.load import materialise
from millrace.sources.scratch import Scratch


def step_order(steps: dict[str, str]) -> list[str]:
    """Names in dependency order; a step depends on every other step its text names."""
    uses = {
        name: {o for o in steps if o != name and re.search(rf"\b{re.escape(o)}\b", sql, re.IGNORECASE)}
        for name, sql in steps.items()
    }
    return list(TopologicalSorter(uses).static_order())


def step_kind(sql: str) -> str:
    if re.search(r"\bGROUP\s+BY\b", sql, re.IGNORECASE):
        return "aggregation"
    return "multiSource" if re.search(r"\bJOIN\b", sql, re.IGNORECASE) else "staging"


def run_steps(
    spark: SparkSession, steps: dict[str, str], sources: dict[str, DataFrame], store: list[str] | None = None
) -> dict[str, DataFrame]:
    """Every step as a frame. Steps refer to sources and to each other as ``{name}``.

    A step named in ``store`` is written and read back; the others stay views that Catalyst inlines.
    """
    known, scratch = dict(sources), Scratch(spark, "steps")
    for name in step_order(steps):
        used = {n: known[n] for n in known if "{" + n + "}" in steps[name]}
        df = spark.sql(steps[name], **used)
        known[name] = materialise(df, f"{scratch.path}/{name}") if store and name in store else df
    return {name: known[name] for name in steps}
