"""Set operations and multi-source loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(dfs: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def union_distinct(dfs: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    return union_all(dfs, allow_missing).distinct()


def insert_sequential(dfs: list[DataFrame], target: str) -> None:
    """Append each source to the target in turn; a failure keeps what was loaded before it."""
    for df in dfs:
        df.write.mode("append").parquet(target)


def truncate_and_insert(df: DataFrame, target: str) -> None:
    """Full reload. The frame must not read from ``target``."""
    df.write.mode("overwrite").parquet(target)


def intersect(left: DataFrame, right: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    return left.intersectAll(right) if keep_duplicates else left.intersect(right)


def except_(left: DataFrame, right: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    return left.exceptAll(right) if keep_duplicates else left.subtract(right)
