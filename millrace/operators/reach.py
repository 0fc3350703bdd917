"""Searching a graph that lies in files which every task maps into its memory.

Vertices are numbered without gaps in their order. ``first`` and ``degree`` say which stretch of ``targets`` holds where a vertex
leads. What is returned for a vertex lies in slices, by number. The files are written by tasks, each its own stretch, in the shared
folder; a task keeps a byte for each vertex and what the root at hand reaches, and searches one root after the other. Rows
are never shuffled for a reached pair.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from millrace.functions.spread import spread
from millrace.sources.scratch import Scratch

#: Edges of a graph that is searched in its files: about 4 bytes for each, and 12 and what is returned for each vertex.
MOST_EDGES = 100_000_000
#: Edges followed at once, and pairs held before they are returned.
AT_ONCE = 1_000_000
HELD = 200_000


def spans(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All places of the stretches of n that begin at lo."""
    ends = np.cumsum(n, dtype=np.int64)
    return np.repeat(lo - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


def cuts(n: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs that sum to at most ``most``, or hold one value only. Runs of nothing are left out."""
    ends = np.cumsum(n, dtype=np.int64)
    lo, done = 0, 0
    while lo < len(n) and done < ends[-1]:
        hi = max(int(np.searchsorted(ends, done + most, "right")), lo + 1)
        if ends[hi - 1] > done:
            yield lo, hi
        lo, done = hi, int(ends[hi - 1])


class Graph:
    """Where the files are, and the numbers of the slices. A task opens it."""

    def __init__(self, folder: str, bases: list[int], size: int, edges: int, labelled: bool):
        self.folder, self.bases, self.size, self.edges, self.labelled = folder, bases, size, edges, labelled

    def file(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def mapped(self, name: str, kind: str, length: int) -> np.ndarray:
        return np.memmap(self.file(name), kind, "r", shape=(length,)) if length else np.zeros(0, kind)

    def open(self) -> Graph:
        self.first, self.degree = self.mapped("first", "<i8", self.size), self.mapped("degree", "<i4", self.size)
        self.targets = self.mapped("targets", "<i4", self.edges)
        if self.labelled:
            self.label_first, self.label_count = self.mapped("label_first", "<i8", self.size), self.mapped("label_count", "<i4", self.size)
        self.seen, self.slices = np.zeros(self.size, bool), {}
        return self

    def labels(self, part: int) -> pa.Table | None:
        """What is returned for the vertices of a slice."""
        if part not in self.slices:
            name = self.file(f"labels-{part}")
            self.slices[part] = pa.ipc.open_file(pa.memory_map(name)).read_all() if os.path.exists(name) else None
        return self.slices[part]

    def reached(self, front: np.ndarray, max_depth: int | None) -> Iterator[tuple[int, np.ndarray]]:
        """(depth, numbers) of what one root's starts reach, nearest first; -1 stands for a null vertex, which is never known."""
        seen, touched, depth = self.seen, [front], 0
        seen[front] = True
        while len(front) and (max_depth is None or depth < max_depth):
            depth += 1
            n = self.degree[front]
            fresh, lost = [], False
            for lo, hi in cuts(n, AT_ONCE):
                to = self.targets[spans(self.first[front[lo:hi]], n[lo:hi])]
                if (to < 0).any():
                    lost, to = True, to[to >= 0]
                to = to[~seen[to]]
                if len(to):
                    to.sort()
                    to = to[np.concatenate([[True], to[1:] != to[:-1]])]
                    seen[to] = True
                    fresh.append(to)
                    yield depth, to
            if lost:
                yield depth, np.array([-1], np.int32)
            front = np.concatenate(fresh) if fresh else np.zeros(0, np.int32)
            touched += fresh
        if sum(map(len, touched)) * 8 > len(seen):
            seen.fill(False)
        else:
            for found in touched:
                seen[found] = False

    def rows(self, roots: list[pa.Array], found: list[tuple[int, int, np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
        """Rows of ``found(place of the root, depth, numbers)``, by slices of the vertices."""
        numbers = np.concatenate([f[2] for f in found])
        size = [len(f[2]) for f in found]
        of, depth = np.repeat(np.array([f[0] for f in found], np.int64), size), np.repeat(np.array([f[1] for f in found], np.int32), size)
        order = np.argsort(numbers)
        numbers, of, depth = numbers[order].astype(np.int64), of[order], depth[order]
        bounds = np.searchsorted(numbers, [*self.bases, self.size])
        own = pa.concat_arrays(roots)

        def batch(labels: list[pa.Array], of: np.ndarray, depth: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([own.take(pa.array(of)), *labels, pa.array(depth)], names)

        if bounds[0] and not self.labelled:
            yield batch([pa.nulls(int(bounds[0]), k) for k in self.labels(0).schema.types], of[: bounds[0]], depth[: bounds[0]])
        for part, base in enumerate(self.bases):
            lo, hi = int(bounds[part]), int(bounds[part + 1])
            if lo == hi or (table := self.labels(part)) is None:
                continue
            at, o, d = numbers[lo:hi], of[lo:hi], depth[lo:hi]
            if self.labelled:
                n = self.label_count[at]
                at, o, d = spans(self.label_first[at], n), np.repeat(o, n), np.repeat(d, n)
            else:
                at = at - base
            for begin in range(0, len(at), HELD):
                some = slice(begin, begin + HELD)
                taken = pa.array(at[some])
                yield batch([c.chunk(0).take(taken) for c in table.columns], o[some], d[some])


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of equal keys."""
    at = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    return zip(at[:-1], at[1:], strict=True)


def _written(df: DataFrame, fn: Callable) -> None:
    """Run ``fn``, which writes files, over the batches of ``df``."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        fn(batches)
        return iter(())

    df.mapInArrow(run, "nothing int").count()


def _store_edges(numbered: DataFrame, graph: Graph, sizes: list[int], before: dict[int, int]) -> None:
    """``numbered(part, a, b)``: targets in order of a, and where those of each vertex are."""
    bases, file = graph.bases, graph.file

    def store(batches) -> None:
        targets, first, degree = (os.open(file(n), os.O_WRONLY) for n in ("targets", "first", "degree"))
        part, done, counts = None, 0, None

        def finish() -> None:
            if part is not None:
                os.pwrite(first, (before[part] + np.cumsum(counts) - counts).astype("<i8"), 8 * bases[part])
                os.pwrite(degree, counts.astype("<i4"), 4 * bases[part])

        for batch in batches:
            if not batch.num_rows:
                continue
            parts, a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for lo, hi in _runs(parts):
                if parts[lo] != part:
                    finish()
                    part, done = int(parts[lo]), 0
                    counts = np.zeros(sizes[part], np.int64)
                counts += np.bincount(a[lo:hi] - bases[part], minlength=sizes[part])
                os.pwrite(targets, b[lo:hi].astype("<i4"), 4 * (before[part] + done))
                done += hi - lo
        finish()
        for f in (targets, first, degree):
            os.close(f)

    _written(numbered.repartition("part").sortWithinPartitions("part", "a", "b"), store)


def _store_labels(labels: DataFrame, graph: Graph, sizes: list[int]) -> None:
    """``labels(part, number, ...)``: what is returned for the vertices of each slice, as one file."""
    bases, file, labelled = graph.bases, graph.file, graph.labelled

    def store(batches) -> None:
        part, held = None, []

        def finish() -> None:
            if part is None:
                return
            table = pa.Table.from_batches(held).combine_chunks()
            if labelled:
                counts = np.bincount(table.column(1).to_numpy() - bases[part], minlength=sizes[part])
                for name, kind, values in (("label_first", "<i8", np.cumsum(counts) - counts), ("label_count", "<i4", counts)):
                    at = os.open(file(name), os.O_WRONLY)
                    os.pwrite(at, values.astype(kind), int(kind[-1]) * bases[part])
                    os.close(at)
            name = f"{file(f'labels-{part}')}"
            own = f"{name}.{uuid.uuid4().hex}"
            table = table.drop_columns(["part", "number"])
            with pa.OSFile(own, "wb") as out, pa.ipc.new_file(out, table.schema) as w:
                w.write_table(table)
            os.replace(own, name)

        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi in _runs(parts):
                if parts[lo] != part:
                    finish()
                    part, held = int(parts[lo]), []
                held.append(batch.slice(lo, hi - lo))
        finish()

    _written(labels.repartition("part").sortWithinPartitions("part", "number"), store)


def _dense(number: str, places: list[int], values: list[int]) -> Column:
    """The value of the part in which a monotonically increasing id was made."""
    full = [0] * (max(places, default=0) + 1)
    for p, v in zip(places, values, strict=True):
        full[p] = v
    return F.get(F.lit(full).cast("array<bigint>"), F.shiftright(number, 33).cast("int"))


def search(step: DataFrame, starts: DataFrame, scratch: Scratch, folder: str, max_depth: int | None, label: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """(root, node, depth) of what the starts reach over the written ``step(node, next)``. ``folder`` is where the scratch folder is mounted.

    ``label`` is applied to vertices once, not to pairs; its other columns stand in place of node.
    """
    spark = step.sparkSession
    both = step.select("node").unionByName(step.select(F.col("next").alias("node"))).where("node IS NOT NULL").distinct()
    found = scratch.write(both.repartitionByRange("node").sortWithinPartitions("node").withColumn("number", F.monotonically_increasing_id()), "vertices")
    counted = sorted(tuple(r) for r in found.groupBy(F.shiftright("number", 33).cast("int")).count().collect())
    places, sizes = [c[0] for c in counted], [c[1] for c in counted]
    bases = [sum(sizes[:i]) for i in range(len(sizes))]
    dense = (_dense("number", places, bases) + F.col("number").bitwiseAND(F.lit((1 << 33) - 1))).cast("int")
    vertices = found.select("node", _dense("number", places, list(range(len(places)))).cast("int").alias("part"), dense.alias("number"))
    leads = vertices.select("node", "part", F.col("number").alias("a"))
    to = vertices.select(F.col("node").alias("next"), F.col("number").alias("b"))
    numbered = step.join(spread(leads), "node").join(spread(to), "next", "left").select("part", "a", F.coalesce("b", F.lit(-1)).alias("b"))
    numbered = scratch.write(numbered, "numbered")
    of_part = dict(tuple(r) for r in numbered.groupBy("part").count().collect())
    before = {p: sum(n for q, n in of_part.items() if q < p) for p in of_part}
    graph = Graph(f"{folder}/graph", bases, sum(sizes), sum(of_part.values()), label is not None)
    os.makedirs(graph.folder)
    for name, length in (("targets", 4 * graph.edges), ("first", 8 * graph.size), ("degree", 4 * graph.size), ("label_first", 8 * graph.size), ("label_count", 4 * graph.size)):
        with open(graph.file(name), "wb") as f:
            f.truncate(length)
    _store_edges(numbered, graph, sizes, before)
    known = vertices if label is None else label(vertices)
    others = [c for c in known.columns if c not in ("part", "number")]
    _store_labels(known.select("part", "number", *others), graph, sizes)
    kinds = [f for f in known.schema.fields if f.name in others]

    # A root's starts stand together; roots that lead nowhere have none.
    starts = scratch.write(starts.where("root IS NOT NULL").join(spread(vertices), "node").select("root", "number"), "starts_numbered")
    roots = scratch.write(starts.select("root").distinct().withColumn("group", F.monotonically_increasing_id()), "roots_numbered")
    tasks = max(1, min(4 * spark.sparkContext.defaultParallelism, roots.count()))
    dealt = starts.join(spread(roots), "root").select("root", "group", "number").repartition(tasks, "group").sortWithinPartitions("group")
    root = starts.schema["root"].dataType
    shape = T.StructType([T.StructField("root", root), *[T.StructField(f.name, f.dataType) for f in kinds], T.StructField("depth", T.IntegerType())])
    names = shape.names
    scratch.keep_only("graph", "starts_numbered", "roots_numbered")

    def run(batches) -> Iterator[pa.RecordBatch]:
        g, own, pairs, held = None, [], [], 0
        for value, numbers in _grouped(batches):
            g = g or graph.open()
            own.append(value)
            for depth, reached in g.reached(numbers, max_depth):
                pairs.append((len(own) - 1, depth, reached))
                held += len(reached)
                if held >= HELD:
                    yield from g.rows(own, pairs, names)
                    own, pairs, held = [value], [], 0
            if not pairs:
                own = []
        if pairs:
            yield from g.rows(own, pairs, names)

    at = known.columns.index("number")
    wanted = [c for c in known.columns[:at] if c != "part"] + ["root", "depth"] + [c for c in known.columns[at + 1 :] if c != "part"]
    return dealt.mapInArrow(run, shape).select(*(wanted if label else ["root", "node", "depth"]))


def _grouped(batches) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(root, numbers of its starts), also of starts that run over several batches."""
    group, value, held = None, None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        groups, numbers = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for lo, hi in _runs(groups):
            if groups[lo] != group:
                if held:
                    yield value, np.concatenate(held)
                group, value, held = groups[lo], batch.column(0).slice(lo, 1), []
            held.append(numbers[lo:hi])
    if held:
        yield value, np.concatenate(held)
