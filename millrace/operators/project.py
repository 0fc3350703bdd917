"""Projection and filter: staging, wildcards, conforming to a target schema."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.dialect import spark_type
from millrace.functions.names import norm


def stage(df: DataFrame, columns: dict[str, str | None] | None = None, where: str | None = None) -> DataFrame:
    """Project, rename, cast and compute; a column without an expression passes through."""
    df = add_where(df, where)
    if columns is None:
        return df
    return df.select(*[(F.expr(e) if e else F.col(name)).alias(name) for name, e in columns.items()])


def clean_condition(condition: str | None) -> str:
    """Unescape quotes and take off a leading WHERE."""
    text = (condition or "").replace('\\"', '"')
    return re.sub(r"^\s*WHERE\s+", "", text, flags=re.IGNORECASE).strip()


def add_where(df: DataFrame, condition: str | None) -> DataFrame:
    """AND one more condition onto the frame; blank text changes nothing."""
    text = clean_condition(condition)
    return df.filter(text) if text else df


def expand_wildcard(sources: dict[str, DataFrame], joined: DataFrame, item: str = "*") -> DataFrame:
    """``*`` needs exactly one source; ``alias.*`` gives that source's columns in catalogue order."""
    if item == "*":
        if len(sources) != 1:
            raise ValueError("a bare * is only allowed with one source; use alias.*")
        (alias,) = sources
    else:
        alias = item.removesuffix(".*")
        if alias not in sources:
            raise ValueError(f"no source is called {alias}")
    return joined.select(*[F.col(f"{alias}.{c}") for c in sources[alias].columns])


@dataclass(frozen=True)
class Target:
    name: str
    data_type: str
    expression: str | None = None


def conform_to_schema(df: DataFrame, target: list[Target]) -> tuple[DataFrame, DataFrame]:
    """Bring a frame into a target schema and report what that took.

    Target order; names match trimmed and case-insensitively; values are cast without failing. A
    target column the source lacks takes its expression, else null and ``needs_transform``.
    """
    have = {f.name.strip().upper(): f for f in df.schema.fields}
    picked, report = [], []
    for t in target:
        kind = spark_type(t.data_type)
        found = have.get(t.name.strip().upper())
        if t.expression:
            value = F.expr(t.expression)
        elif found is not None:
            value = F.col(f"`{found.name}`")
        else:
            value = F.lit(None)
        picked.append(value.try_cast(kind).alias(t.name))
        before = found.dataType.simpleString() if found else None
        changed = found is not None and before != kind
        state = "matched" if found else "added"
        report.append((t.name, state, before, kind, changed, found is None and not t.expression))
    wanted = {t.name.strip().upper() for t in target}
    report += [
        (f.name, "dropped", f.dataType.simpleString(), None, False, False)
        for key, f in have.items()
        if key not in wanted
    ]
    fields = "name string, state string, from_type string, to_type string, type_changed boolean, needs_transform boolean"
    return df.select(*picked), df.sparkSession.createDataFrame(report, fields)


def conform_catalogue(source: DataFrame, target: DataFrame) -> DataFrame:
    """The same report for a whole catalogue: two column lists keyed by node, compared as sets.

    Both frames hold node_id, name, data_type; the target also a nullable transform.
    """
    s = source.select("node_id", norm("name").alias("key"), F.col("name").alias("s_name"), norm("data_type").alias("s_type"))
    t = target.select(
        "node_id", norm("name").alias("key"), F.col("name").alias("t_name"), norm("data_type").alias("t_type"), "transform"
    )
    both = s.join(t, ["node_id", "key"], "full")
    state = (
        F.when(F.col("s_name").isNull(), "added").when(F.col("t_name").isNull(), "dropped").otherwise("matched")
    )
    return both.select(
        "node_id",
        F.coalesce("t_name", "s_name").alias("name"),
        state.alias("state"),
        F.col("s_type").alias("from_type"),
        F.col("t_type").alias("to_type"),
        ((state == "matched") & (F.col("s_type") != F.col("t_type"))).alias("type_changed"),
        ((state == "added") & F.col("transform").isNull()).alias("needs_transform"),
    )


def add_column(df: DataFrame, name: str, expression: str | Column) -> DataFrame:
    return df.withColumn(name, F.expr(expression) if isinstance(expression, str) else expression)


def drop_column(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return df.drop(*names)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)
