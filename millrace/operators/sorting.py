"""Order, limit, top-k."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.rules import first_match

PLAIN_COLUMN = re.compile(r'^\s*(?:"[^"]+"|`[^`]+`|\w+)(?:\s*\.\s*(?:"[^"]+"|`[^`]+`|\w+))*\s*$')
SEVERITIES = {"critical": 0, "warning": 1, "suggestion": 2}


def order_by(df: DataFrame, items: list[tuple[str, str]]) -> DataFrame:
    """Sort by plain columns, each ``asc`` or ``desc``; an expression is refused by name."""
    bad = [c for c, _ in items if not PLAIN_COLUMN.match(c)]
    if bad:
        raise ValueError(f"only plain columns can be ordered by: {', '.join(bad)}")
    return df.orderBy(*[F.desc(c) if d.lower() == "desc" else F.asc(c) for c, d in items])


def limit(df: DataFrame, n: int, offset: int = 0) -> DataFrame:
    return (df.offset(offset) if offset else df).limit(n)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Each partition keeps k rows, one task merges them: never a full sort."""
    return df.orderBy(*order).limit(k)


def severity_rank(severity: Column) -> Column:
    return first_match([(severity == s, F.lit(r)) for s, r in SEVERITIES.items()])


def severity_sort(findings: DataFrame) -> DataFrame:
    return findings.orderBy(severity_rank(F.col("severity")), "category", "node_id")
