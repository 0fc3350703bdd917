"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length one and cut in halves; each half has a codebook of its own, so that the pairs of codewords form a
grid of cells. Every vector lies in the cell of its nearest codewords. To find its near neighbours, a vector
visits cells in ascending order of a lower bound of the distance to anything in them (multi-sequence traversal
over the two sorted lists of bounds) until the bound exceeds a reach. The bound is the distance to the planes
between codewords; it is the same game from either end of a pair, so only cells from its own on are visited.
Pairs in visited cells are verified in double precision.

The reach comes from the target recall: sample vectors are moved in random directions to exactly the least similarity, the
hardest pairs there are, and the reach is the quantile of the bounds at which they, or the similar pairs within the first
``PAIRED`` sample vectors, are met. With ``recall`` 1 it is the distance
that the similarity allows, and nothing is missed, whatever the codebooks.

The number of codewords follows from the number of different vectors, so that the vectors of a cell stay as many. Codebooks and reach are fitted on at most ``SAMPLE`` vectors, chosen by a hash of their id; all vectors are indexed. Equal vectors
count as one with a weight, so copies are never compared with each other. A cell is compared in blocks of at most ``BLOCK`` members and
``BLOCK`` visitors; a block returns sums for its visitors and a spanning forest of its links, never the pairs.

Defined cases: vectors that are null, zero or hold null or non-finite numbers link with nothing, nor do rows with a null
label; vectors of different length link with nothing, as they lie in grids of their own. Rows that share an id are one
vector each; a row without id has null for component_id and kept. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import textops
from millrace.llm.components import components
from millrace.sources.scratch import Scratch

SAMPLE = 10_000
#: Codewords of each half: as many as leave about ``OCCUPANCY`` vectors in a cell of the grid, within these bounds.
OCCUPANCY = 64
CODEWORDS = (16, 512)
RECALL = 0.999
#: Sample vectors that are compared with each other for the reach.
PAIRED = 2000
BLOCK = 2048
#: Added to the radius, for rounding in the bounds; verification decides.
SLACK = 1e-6


def unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale  # keeps the squares of very large and very small numbers finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def codebook(points: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    """k-means from evenly chosen points."""
    distinct = np.unique(points, axis=0)
    centers = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)]
    for _ in range(steps):
        near = distances(points, centers).argmin(axis=1)
        centers = np.array([points[near == c].mean(axis=0) if (near == c).any() else centers[c] for c in range(len(centers))])
    return np.unique(centers, axis=0)


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(axis=1)[None, :], 0)


def plane_bounds(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest codeword, least squared distance to anything in each codeword's cell) of every row."""
    d = distances(x, centers)
    between = np.sqrt(distances(centers, centers))
    out = np.zeros_like(d)
    for c in range(len(centers)):
        others = [o for o in range(len(centers)) if o != c]
        if others:
            out[:, c] = np.maximum(((d[:, [c]] - d[:, others]) / (2 * between[c, others])).max(axis=1), 0)
    return d.argmin(axis=1), out**2


def traversal(one: np.ndarray, two: np.ndarray, most: float) -> Iterator[tuple[int, int]]:
    """Cells of the grid in ascending order of one[i] + two[j], while the sum is at most ``most``."""
    a, b = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
    first, second = one[a].tolist(), two[b].tolist()
    open_ = [(first[0] + second[0], 0, 0)]
    while open_ and open_[0][0] <= most:
        _, i, j = heapq.heappop(open_)
        yield int(a[i]), int(b[j])
        if j + 1 < len(second):
            heapq.heappush(open_, (first[i] + second[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(first):
            heapq.heappush(open_, (first[i + 1] + second[0], i + 1, 0))


def reach_for(x: np.ndarray, one: np.ndarray, two: np.ndarray, cosine: float, recall: float) -> float:
    """The squared bound up to which cells are visited."""
    most = max(0.0, 2 - 2 * cosine)
    if recall >= 1 or not len(x):
        return most + SLACK
    away = np.random.default_rng(8).normal(size=x.shape)
    away = away - (away * x).sum(axis=1, keepdims=True) * x
    size = np.sqrt((away * away).sum(axis=1, keepdims=True))
    moved = cosine * x + np.sqrt(max(0.0, 1 - cosine**2)) * away / np.maximum(size, 1e-12)
    half, row = x.shape[1] // 2, np.arange(len(x))
    (_, b1), (_, b2) = plane_bounds(x[:, :half], one), plane_bounds(x[:, half:], two)
    met = b1[row, distances(moved[:, :half], one).argmin(axis=1)] + b2[row, distances(moved[:, half:], two).argmin(axis=1)]
    reach = float(np.quantile(met, recall))
    # pairs of the sample itself, whose directions the codebooks may have been fitted to
    few = x[:PAIRED]
    i, j = np.nonzero(np.triu(few @ few.T >= cosine, 1))
    if len(i):
        i, j = np.concatenate([i, j]), np.concatenate([j, i])
        met = b1[i, distances(few[:, :half], one).argmin(axis=1)[j]] + b2[i, distances(few[:, half:], two).argmin(axis=1)[j]]
        reach = max(reach, float(np.quantile(met, recall)))
    return min(most, reach) + SLACK


def codewords_for(n: int) -> int:
    """The grid grows with the vectors, so that a cell does not."""
    least, most = CODEWORDS
    return min(most, max(least, round((n / OCCUPANCY) ** 0.5)))


def fitted(vectors: DataFrame, codewords: int | None, cosine: float, recall: float) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Codebooks of both halves and the squared reach for each vector length, from a bounded sample."""
    n = vectors.count()
    codewords = codewords or codewords_for(n)
    share = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(n, 1)))
    rows = vectors.where(share).select("embedding").toPandas()["embedding"]
    books = {}
    for size in sorted({len(v) for v in rows}):
        x = unit(np.array([v for v in rows if len(v) == size], np.float64))
        one, two = codebook(x[:, : size // 2], codewords), codebook(x[:, size // 2 :], codewords)
        books[size] = (one, two, reach_for(x, one, two, cosine, recall))
    return books


def cells(vectors: DataFrame, books) -> DataFrame:
    """(rep, weight, label, size, cell, home, embedding): one row for each cell that a vector visits, its own included."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            vs = b.column(3).to_pylist()
            row, cell, home = [], [], []
            for size in {len(v) for v in vs}:
                at = [i for i, v in enumerate(vs) if len(v) == size]
                x = unit(np.array([vs[i] for i in at], np.float64))
                # a length that the sample lacks has one cell
                one, two, reach = shared.value.get(size, (np.zeros((1, size // 2)), np.zeros((1, size - size // 2)), 0.0))
                (h1, b1), (h2, b2) = plane_bounds(x[:, : size // 2], one), plane_bounds(x[:, size // 2 :], two)
                for k, i in enumerate(at):
                    own = int(h1[k]), int(h2[k])
                    seen = {c for c in traversal(b1[k], b2[k], reach) if c > own}
                    for c in [own, *sorted(seen)]:
                        row.append(i)
                        cell.append(c[0] * len(two) + c[1])
                        home.append(c == own)
            part = b.take(pa.array(row, pa.int64()))
            size = pa.array([len(vs[i]) for i in row], pa.int32())
            yield pa.RecordBatch.from_arrays([*part.columns[:3], size, pa.array(cell, pa.int32()), pa.array(home), part.column(3)], ["rep", "weight", "label", "size", "cell", "home", "embedding"])

    placed = vectors.select("rep", "weight", "label", "embedding")
    label = dict(placed.dtypes)["label"]
    return placed.mapInArrow(textops.tidy(run), f"rep long, weight long, label {label}, size int, cell int, home boolean, embedding {dict(placed.dtypes)['embedding']}")


def compared(visitors: pd.DataFrame, members: pd.DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(weight linked with each visitor, with each member, links as a forest of (a, b)) of one block.

    Vectors at home in the cell are visitors as well as members there and get their weight as visitors.
    """
    x, y = np.stack(visitors["embedding"].to_numpy()).astype(np.float64), np.stack(members["embedding"].to_numpy()).astype(np.float64)
    cos = unit(x) @ unit(y).T
    linked = cos >= least
    for i, j in np.argwhere(np.abs(cos - least) < 1e-12):  # the plain formula decides at the threshold
        linked[i, j] = float(x[i] @ y[j]) / (float(np.sqrt(x[i] @ x[i])) * float(np.sqrt(y[j] @ y[j]))) >= least
    v, m = visitors["rep"].to_numpy(), members["rep"].to_numpy()
    linked &= v[:, None] != m[None, :]
    weights = linked @ members["weight"].to_numpy().astype(np.float64)
    guests = ~visitors["home"].to_numpy(bool)
    back = visitors["weight"].to_numpy().astype(np.float64)[guests] @ linked[guests]
    far = np.int64(np.iinfo(np.int64).max)
    on_v, on_m = v.copy(), m.copy()
    rows, cols = linked.any(axis=1), linked.any(axis=0)
    while rows.any():
        new_v = np.minimum(on_v, np.where(linked, on_m[None, :], far).min(axis=1))
        new_m = np.minimum(on_m, np.where(linked, new_v[:, None], far).min(axis=0))
        if (new_v == on_v).all() and (new_m == on_m).all():
            break
        on_v, on_m = new_v, new_m
    forest = np.concatenate([np.stack([v[rows], on_v[rows]], axis=1), np.stack([m[cols], on_m[cols]], axis=1)])
    return weights.astype(np.int64), back.astype(np.int64), np.unique(forest[forest[:, 0] != forest[:, 1]], axis=0)


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    cosine: float = 0.98, codewords: int | None = None, recall: float = RECALL,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``."""
    scratch = Scratch(vectors.sparkSession, "multiindex")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("embedding"), F.col(label_col).alias("label"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    sound = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & fine, F.lit(False))
    classes = scratch.write(rows.where(sound).groupBy("label", "embedding").agg(F.min("id").alias("rep"), F.count("*").alias("weight")), "classes")

    placed = scratch.write(cells(classes, fitted(classes, codewords, cosine, recall)), "cells")
    where = ["label", "size", "cell"]
    parts = placed.groupBy(*where).agg(F.ceil(F.sum(F.col("home").cast("int")) / BLOCK).alias("m"), F.ceil(F.count("*") / BLOCK).alias("v")).where("m > 0")
    cut = placed.join(parts, where)
    visit = cut.select(*where, F.pmod(F.xxhash64("rep"), "v").alias("vb"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("mb"), F.lit(False).alias("member"), "home", "rep", "weight", "embedding")
    member = cut.where("home").select(*where, F.explode(F.sequence(F.lit(0).cast("long"), F.col("v") - 1)).alias("vb"), F.pmod(F.xxhash64("rep"), "m").alias("mb"), F.lit(True).alias("member"), "home", "rep", "weight", "embedding")

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        v, m = pdf[~pdf["member"]], pdf[pdf["member"]]
        if not len(v) or not len(m):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        weights, back, forest = compared(v, m, cosine)
        reps, weights = np.concatenate([v["rep"], m["rep"]]), np.concatenate([weights, back])
        some = weights > 0
        sums = pd.DataFrame({"a": reps[some], "b": reps[some], "n": weights[some]})
        return pd.concat([sums, pd.DataFrame({"a": forest[:, 0], "b": forest[:, 1], "n": 0})])

    found = visit.unionByName(member).groupBy(*where, "vb", "mb").applyInPandas(block, "a long, b long, n long")
    found = scratch.write(found, "found")
    counts = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    comps = components(found.where("n = 0").select("a", "b"), scratch).withColumnRenamed("id", "rep")
    labelled = classes.join(counts, "rep", "left").join(comps, "rep", "left")
    labelled = labelled.select("label", "embedding", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    out = rows.withColumn("key", F.when(sound, F.struct("label", "embedding"))).join(labelled.withColumn("key", F.struct("label", "embedding")).drop("label", "embedding"), "key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    result = out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))
    result = scratch.write(result, "result")
    scratch.keep_only("result")
    return result
