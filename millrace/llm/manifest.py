r"""A Merkle manifest of a dataset, with a proof for every row.

A leaf is the SHA-256 of a row's fields, each written as its length and value. The rows of a group (the source) form a tree over
their ids in order, of ``FANOUT`` nodes to a parent, and the groups' roots, in order of their names, form one more tree.

A row's place in its tree is found without sorting ids: the ids of each group are merged into bitmaps of ``2**LOW_BITS`` ids, without
the empty bytes at either end; a directory holds how many rows stand before each bitmap; and a row's place is the
directory's number plus the population count of the bits before its own. The directory is summed in levels of
``2**STEP_BITS`` bitmaps, so no task sums over a whole group.

Trees are reduced ``LEVELS`` levels at a time: the nodes of a block are put into an array by their slot, and the block's
root goes up. On the way down each block is joined with the siblings above its root; a block is bounded, so no tree is gathered.
Proof and folded root are hashed there, and only digests leave the task.

Defined cases: a null field is hashed as ``-``; rows without a source are a group of their own, before all others. Rows without id come
first in their group. Rows that share an id follow each other in order of their leaves, and of equal leaves in any
order: each is a leaf of its own. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions import ordered
from millrace.llm import ranks
from millrace.sources.scratch import Scratch

FANOUT = 3
LOW_BITS = 15
STEP_BITS = 12
LEVELS = 8
#: Stands for the id of rows without one: before every id there is.
NO_ID = -(1 << 63)

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(values: list[Column]) -> Column:
    """Lower-case hex SHA-256 of fields in a form that tells them apart."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def depth(n: int) -> int:
    """The levels above n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


# places


def _directory(index: DataFrame, scratch: Scratch) -> DataFrame:
    """``index(grp, hi, n)`` with the rows of the group before each hi."""
    least, most = index.agg(F.min("hi"), F.max("hi")).first()
    levels = [index.select("grp", "hi", "n")]
    while least is not None and (least >> (STEP_BITS * len(levels))) != (most >> (STEP_BITS * len(levels))):
        up = levels[-1].groupBy("grp", F.shiftright("hi", STEP_BITS).alias("hi")).agg(F.sum("n").alias("n"))
        levels.append(scratch.write(up, f"sums-{len(levels)}"))
    above = None
    for level in reversed(levels):
        upper = F.shiftright("hi", STEP_BITS)
        inside = F.sum("n").over(Window.partitionBy("grp", upper).orderBy("hi").rowsBetween(Window.unboundedPreceding, -1))
        found = level.select("grp", "hi", upper.alias("up"), F.coalesce(inside, F.lit(0)).alias("inside"))
        if above is None:
            above = found.select("grp", "hi", F.col("inside").alias("before"))
        else:
            over = above.select(F.col("grp").alias("g"), F.col("hi").alias("up"), "before")
            above = found.join(over, F.col("grp").eqNullSafe(F.col("g")) & (found["up"] == over["up"])).select("grp", "hi", (F.col("before") + F.col("inside")).alias("before"))
    return above


def places(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows(grp, id, leaf, row)``, a written table, with pos: the row's place in its group, from 0."""
    # counted from the least id there can be, so that no number is negative
    hi = F.shiftright("id", LOW_BITS) + F.lit(1 << (63 - LOW_BITS))
    low = F.col("id").bitwiseAND((1 << LOW_BITS) - 1)
    rows = rows.withColumns({"hi": hi, "low": low})
    merged = rows.groupBy("grp", "hi").agg(F.bitmap_construct_agg("low").alias("all"), F.count("*").alias("n"), F.min("low").alias("least"), F.max("low").alias("most"))
    # without the empty bytes at both ends, and from which byte on
    first = (F.col("least") / 8).cast("int")
    bits = F.substring("all", first + 1, (F.col("most") / 8).cast("int") - first + 1)
    index = scratch.write(merged.select("grp", "hi", bits.alias("bits"), first.alias("first"), "n", F.bitmap_count("all").alias("ids")), "index")
    before = _directory(index, scratch).select(F.col("grp").alias("g"), F.col("hi").alias("h"), "before")

    doubled = index.where("n > ids").select("grp", "hi")
    repeated = None
    if not doubled.isEmpty():
        counts = _semi(rows, doubled, ["grp", "hi"]).groupBy("grp", "hi", "low", "id").agg(F.count("*").alias("n")).where("n > 1")
        repeated = scratch.write(counts.withColumn("more", F.col("n") - 1), "repeated")
        # no more than a bitmap has bits
        more = repeated.groupBy("grp", "hi").agg(F.collect_list(F.struct("low", "more")).alias("more"))
    else:
        more = index.limit(0).select("grp", "hi", F.array(F.struct(F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("more"))).alias("more"))
    more = more.select(F.col("grp").alias("g2"), F.col("hi").alias("h2"), "more")
    directory = index.join(before, F.col("grp").eqNullSafe(F.col("g")) & (F.col("hi") == F.col("h"))).drop("g", "h")
    directory = directory.join(more, F.col("grp").eqNullSafe(F.col("g2")) & (F.col("hi") == F.col("h2")), "left")
    directory = scratch.write(directory.select(F.col("grp").alias("g"), F.col("hi").alias("h"), "bits", "first", "before", "more"), "directory")

    def ranked(some: DataFrame) -> DataFrame:
        """The place of the first row of each id."""
        at = (F.col("low") / 8).cast("int") - F.col("first")
        byte = F.conv(F.hex(F.substring("bits", at + 1, F.lit(1))), 16, 10).cast("int")
        below = byte.bitwiseAND(F.expr("shiftleft(1, cast(low % 8 as int)) - 1"))
        bits = F.bitmap_count(F.substring("bits", F.lit(1), at)) + F.bit_count(below)
        extra = F.aggregate(F.filter("more", lambda x: x["low"] < F.col("low")), F.lit(0).cast("long"), lambda s, x: s + x["more"])
        found = some.join(directory, F.col("grp").eqNullSafe(F.col("g")) & (F.col("hi") == F.col("h")))
        return found.withColumn("pos", F.col("before") + bits + F.coalesce(extra, F.lit(0))).select(*some.columns, "pos")

    if repeated is None:
        return ranked(rows).drop("hi", "low")
    single = ranked(_semi(rows, repeated, ["grp", "id"], "left_anti")).drop("hi", "low")
    starts = scratch.write(ranked(repeated.select("grp", "id", "hi", "low")).select(F.col("grp").alias("g"), F.col("id").alias("i"), F.col("pos").alias("start")), "starts")
    same = ordered.numbered(_semi(rows, repeated, ["grp", "id"]), ["grp", "id"], "leaf", "row", "nth")
    same = same.join(starts, F.col("grp").eqNullSafe(F.col("g")) & (F.col("id") == F.col("i")))
    same = same.withColumn("pos", F.col("start") + F.col("nth") - 1)
    return single.unionByName(same.select(single.columns))


def _semi(rows: DataFrame, keys: DataFrame, names: list[str], how: str = "left_semi") -> DataFrame:
    other = keys.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(names)])
    on = None
    for i, k in enumerate(names):
        same = F.col(k).eqNullSafe(F.col(f"k{i}"))
        on = same if on is None else on & same
    return rows.join(other, on, how)


# trees


def parent(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


class Block:
    """The levels of one block, from its nodes put into their slots up to its root."""

    def __init__(self, nodes: pa.Table, levels: int):
        self.size = FANOUT**levels
        slots = [""] * nodes.num_rows
        for at, h in zip(nodes.column("pos").to_pylist(), nodes.column("hash").to_pylist(), strict=True):
            slots[at % self.size] = h
        self.levels = [slots]
        for _ in range(min(levels, depth(nodes.column("n")[0].as_py()))):
            slots = [parent(slots[i : i + FANOUT]) for i in range(0, len(slots), FANOUT)]
            self.levels.append(slots)

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, pos: int) -> Iterator[tuple[str, str]]:
        """(the nodes of the run left of a node, those right of it), level by level up to the block's root."""
        at = pos % self.size
        for nodes in self.levels[:-1]:
            run = at - at % FANOUT
            yield "".join(nodes[run:at]), "".join(nodes[at + 1 : run + FANOUT])
            at //= FANOUT


_PAIRS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_SIDES = "array<struct<left string, right string>>"


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / FANOUT**levels))


def reduced(nodes: DataFrame, most: int, levels: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """Tables (tree, pos, hash, n), from the nodes up to the one root of every tree; no tree has more than ``most`` nodes."""
    size = FANOUT**levels

    def up(table: pa.Table) -> pa.Table:
        n = table.column("n")[0].as_py()
        return pa.table({"tree": table.column("tree")[:1], "pos": table.column("block")[:1], "hash": [Block(table, levels).root], "n": [-(-n // size)]})

    out = [nodes]
    while len(out) == 1 or most > 1:
        above = _blocks(out[-1].select("tree", "pos", "hash", "n"), levels).groupBy("tree", "block").applyInArrow(up, "tree long, pos long, hash string, n long")
        out.append(scratch.write(above, f"{name}-{len(out)}"))
        most = -(-most // size)
    return out


def descended(stage: DataFrame, above: DataFrame, levels: int, found: Callable, shape: str) -> DataFrame:
    """What ``found`` makes of the nodes of each block and the siblings of each, up to the root.

    ``above(tree, pos, subroot, sides)`` has the siblings of the nodes one stage higher.
    """

    def down(nodes: pa.Table, upper: pa.Table) -> pa.Table:
        block = Block(nodes, levels)
        rest = [(s["left"], s["right"]) for s in upper.column("sides")[0].as_py()]
        return found(nodes, upper.column("subroot")[0].as_py(), [[*block.siblings(at), *rest] for at in nodes.column("pos").to_pylist()])

    upper = above.select("tree", F.col("pos").alias("block"), "subroot", "sides").groupBy("tree", "block")
    return _blocks(stage, levels).groupBy("tree", "block").cogroup(upper).applyInArrow(down, shape)


def _with_sides(nodes: pa.Table, subroot: str, sides: list) -> pa.Table:
    pairs = pa.array([[{"left": a, "right": b} for a, b in s] for s in sides], _PAIRS)
    return pa.table({"tree": nodes.column("tree"), "pos": nodes.column("pos"), "subroot": pa.array([subroot] * len(sides), pa.string()), "hash": nodes.column("hash"), "sides": pairs})


def _proved(nodes: pa.Table, subroot: str, sides: list) -> pa.Table:
    proofs_, folded = [], []
    for leaf, other, own in zip(nodes.column("hash").to_pylist(), nodes.column("tampered").to_pylist(), sides, strict=True):
        proofs_.append(sha256("".join(a + b for a, b in own).encode()).hexdigest())
        h = leaf if other is None else other
        for a, b in own:
            h = parent([a, h, b])
        folded.append(h)
    names = ["id", "leaf", "subroot", "proof_sha256", "folded_root"]
    return pa.table([nodes.column("id"), nodes.column("hash"), *[pa.array(x, pa.string()) for x in ([subroot] * len(sides), proofs_, folded)]], names)


def proofs(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group: str = "source",
    tampered: dict[str, Column] | None = None, when: Column | None = None, levels: int = LEVELS,
) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``tampered`` gives other values of some fields, for rows where ``when`` holds: these rows are folded from the leaf they
    would have then, along the siblings in the untampered trees.
    """
    scratch = Scratch(docs.sparkSession, "manifest")
    given = {c: F.col(f"`{c}`") for c in fields}
    id_ = F.col(f"`{id_col}`").cast("long")
    changed = F.when(when, digest(list((given | tampered).values()))) if tampered and when is not None else F.lit(None).cast("string")
    rows = docs.select(
        F.col(f"`{group}`").alias("grp"), id_.alias("real_id"), F.coalesce(id_, F.lit(NO_ID)).alias("id"),
        digest(list(given.values())).alias("leaf"), changed.alias("tampered"), F.monotonically_increasing_id().alias("row"),
    )
    rows = scratch.write(rows, "rows")
    # a tree's number is the place of its group among the names: null first, text by bytes
    groups = ranks.placed(rows.groupBy("grp").agg(F.count("*").alias("n")), [F.col("grp").asc_nulls_first()], "tree", scratch, "groups")
    groups = scratch.write(groups.withColumnRenamed("grp", "g"), "trees")
    trees, most = groups.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()

    leaves = places(rows, scratch).join(groups, F.col("grp").eqNullSafe(F.col("g")))
    leaves = scratch.write(leaves.select("tree", "pos", F.col("leaf").alias("hash"), "n", F.col("real_id").alias("id"), "tampered"), "leaves")
    stages = reduced(leaves, most, levels, scratch, "nodes")
    subroots = stages[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "hash", F.lit(trees).cast("long").alias("n"))
    top = reduced(scratch.write(subroots, "subroots"), trees, levels, scratch, "top")
    root = next(iter(top[-1].take(1)), {"hash": None})["hash"]

    shape = f"tree long, pos long, subroot string, hash string, sides {_SIDES}"
    sides = top[-1].select("tree", "pos", F.lit("").alias("subroot"), F.array().cast(_SIDES).alias("sides"))
    for k, stage in enumerate(reversed(top[:-1])):
        sides = scratch.write(descended(stage, sides, levels, _with_sides, shape), f"top-sides-{k}")
    sides = sides.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("hash").alias("subroot"), "sides")
    for k, stage in enumerate(reversed(stages[1:-1])):
        sides = scratch.write(descended(stage, sides, levels, _with_sides, shape), f"sides-{k}")
    found = descended(stages[0], sides, levels, _proved, "id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    return found.select(F.col("id").alias(id_col), "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
