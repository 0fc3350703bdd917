"""Connected components of a table of links, in joins over the links alone.

Rounds of two steps: every node hands its larger neighbours to its smallest one, then its smaller ones. Each round
is a written table, so nothing is kept in memory and lost executors only repeat a round. The links never reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.sources.scratch import Scratch


def _print(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(id, component) of every node of ``links(a, b)`` but the smallest ones; component is the smallest id reachable.

    Nodes that are their own component's smallest are left out, as are links from a node to itself or with a null.
    """
    big, small = F.greatest("a", "b"), F.least("a", "b")
    e = scratch.write(links.where("a <> b").select(big.alias("u"), small.alias("v")).distinct(), f"{name}-0")
    state, step = _print(e), 0
    while state[0]:
        step += 1
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = scratch.write(near.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{step}")
        state, before = _print(e), state
        if state == before:
            break
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
