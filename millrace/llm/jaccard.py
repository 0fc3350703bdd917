"""Near-duplicate documents by the Jaccard similarity of their word shingles, through a count-vector R-tree.

Every text becomes the set of its distinct shingles of five words. The shingles are hashed into ``GROUPS`` groups, and the
number in each group is the document's point. Two sets share at most the sum of the smaller coordinates of their points;
that bound, taken over the boxes of an R-tree, over single points, and at last the shingles themselves decide.

Long texts have more groups, a power of two times ``GROUPS``, so that their points tell as much; points of different
length are compared after the longer one's groups are added up. Points of this many dimensions lie about equally far apart, so boxes of one tree over all documents would overlap nearly
everywhere. The forest therefore has one tree for every shingle that two documents must share to be similar at all: of
a set of n, similar sets hold one of its first n - ceil(0.8 n) + 1 shingles in any order fixed for all. The order puts
shingles found in many documents last, so that a common passage is no one's reason to meet.

Work follows the documents, not the pairs of a group:

* equal sets are one class, named by a digest of 64 bits, and go on as one set;
* the first set of a tree is compared with all others of it, which settles trees of two and most tight groups;
* only where trees of one first set still hold several components, they are built and searched, and only across
  components; links are found and joined where the points are, so what comes out is a forest and not the pairs. A tree
  of more than ``TILE`` points is searched in tiles, so no task holds a whole group;
* components come from joins over the links (``components``).

Defined cases: a null or empty text, or one of separators only, has an empty set and is its own component. With fewer
words than a shingle, the whole sequence is the one shingle. Rows that share an id are judged each by its own
text; a row without id has its set size and a null component. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import textops
from millrace.llm.components import components
from millrace.llm.sieve import sieve
from millrace.sources.scratch import Scratch

WORDS = 5
#: Groups of the shortest points, and the mean number in a group above which a set has twice as many.
GROUPS = 64
FULL = 4
#: Points in one search tile of an R-tree, and in one of its leaves.
TILE = 1024
LEAF = 32
#: A shingle is frequent if it stands in this share of all documents. It is counted in runs of texts that hold about
#: RUN shingles together, where at least three texts have it.
FREQUENT = 0.0005
RUN = 2_000_000


def shingle_sets(texts: pa.Array, k: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for w in textops.words(texts):
        h = w.hashes()
        all_grams = textops.grams(h, k)
        for a, b in zip(w.first[:-1], w.first[1:], strict=True):
            if b - a >= k:
                yield np.unique(all_grams[a : b - k + 1])
            elif b > a:
                yield np.array([textops.folded(h[a:b])], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(parts) if parts else [], kind))


def frequent_shingles(docs: DataFrame, scratch: Scratch) -> np.ndarray:
    """Sorted hashes of the shingles that stand in at least ``FREQUENT`` of all documents.

    At most (mean set size / FREQUENT) of them exist, whatever the number of documents. They only order the shingles.
    """

    def count(batches):
        for b in batches:
            part, held = [], 0
            for i, own in enumerate(shingle_sets(b.column(0)), 1):
                part.append(own)
                held += len(own)
                if held >= RUN or i == b.num_rows:
                    found, times = np.unique(np.concatenate(part), return_counts=True)
                    found, times = found[times >= 3], times[times >= 3]
                    rows = [np.append(signed(found), 0), np.append(times, 0), np.append(np.zeros(len(found), np.int64), len(part))]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["h", "times", "docs"])
                    part, held = [], 0

    seen = docs.select("text").mapInArrow(textops.tidy(count), "h long, times long, docs long")
    totals = scratch.write(seen.groupBy("h").agg(F.sum("times").alias("times"), F.sum("docs").alias("docs")), "frequent")
    n = totals.agg(F.sum("docs")).first()[0] or 0
    rows = totals.where(F.col("times") >= max(3, FREQUENT * n)).select("h").toPandas()["h"].to_numpy(np.int64)
    return np.sort(rows.view(np.uint64))


def prefix_size(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1


def point(m: np.ndarray) -> bytes:
    """The numbers of scrambled hashes in each group, as unsigned 16-bit integers."""
    groups = GROUPS
    while len(m) > FULL * groups:
        groups *= 2
    return np.bincount((m >> np.uint64(30)).astype(np.int64) % groups, minlength=groups).astype("<u2").tobytes()


def folded_to(raw: bytes, groups: int) -> np.ndarray:
    """A point with its groups added up to fewer; groups divides its length."""
    return np.frombuffer(raw, "<u2").reshape(-1, groups).sum(axis=0, dtype=np.int64)


def shared_at_most(a: bytes, b: bytes) -> int:
    """The bound on the overlap of two sets: the sum of the smaller coordinates."""
    groups = min(len(a), len(b)) // 2
    return int(np.minimum(folded_to(a, groups), folded_to(b, groups)).sum())


def digest(s: np.ndarray) -> np.uint64:
    """One number for a set of hashes."""
    m = textops.mixed(s ^ np.uint64(0x5851F42D4C957F2D))
    return textops.mixed(np.array([np.bitwise_xor.reduce(m), np.add.reduce(textops.mixed(m)), len(s)], np.uint64)).sum() if len(s) else np.uint64(0)


def signatures(docs: DataFrame, frequent, percent: int) -> DataFrame:
    """(id, n, node, keys, point): set size, digest, the shingles that similar sets meet in, and the point."""

    def sign(batches):
        common = frequent.value
        for b in batches:
            n, node, keys, points = [], [], [], []
            for s in shingle_sets(b.column(1)):
                n.append(len(s))
                node.append(digest(s))
                late = np.zeros(len(s), bool)
                if len(common):
                    late = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
                ordered = np.concatenate([s[~late], s[late]])
                keys.append(signed(ordered[: prefix_size(len(s), percent) if len(s) else 0]))
                points.append(point(textops.mixed(s)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(signed(np.array(node, np.uint64))), lists(keys, pa.int64()), pa.array(points, pa.binary())],
                ["id", "n", "node", "keys", "point"],
            )

    return docs.select("id", "text").mapInArrow(textops.tidy(sign), "id long, n long, node long, keys array<long>, point binary")


def needed(na, nb, percent: int):
    """The least overlap of two sets of these sizes that are similar."""
    return -(-percent * (na + nb) // (100 + percent))


def tree(points: np.ndarray) -> list[np.ndarray]:
    """Leaves of an R-tree by sort-tile packing: rows are halved along the coordinate that varies most."""
    leaves, open_ = [], [np.arange(len(points))]
    while open_:
        rows = open_.pop()
        if len(rows) <= LEAF:
            leaves.append(rows)
            continue
        axis = int(np.argmax(points[rows].var(axis=0)))
        rows = rows[np.argsort(points[rows, axis], kind="stable")]
        half = len(rows) // 2
        open_ += [rows[:half], rows[half:]]
    return leaves


def surviving(points_a, n_a, comp_a, points_b, n_b, comp_b, percent: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of different components whose sets may be similar by the bound; i < j within one tile."""
    la = tree(np.column_stack([points_a, n_a]))
    lb = la if same else tree(np.column_stack([points_b, n_b]))
    high_b = np.array([points_b[r].max(axis=0) for r in lb])
    least_b = np.array([n_b[r].min() for r in lb])
    one_b = np.array([comp_b[r[0]] if (comp_b[r] == comp_b[r[0]]).all() else -1 for r in lb])
    out_i, out_j = [], []
    for k, r in enumerate(la):
        shared = np.minimum(points_a[r].max(axis=0), high_b).sum(axis=1)
        go = shared >= needed(n_a[r].min(), least_b, percent)
        if (comp_a[r] == comp_a[r[0]]).all():
            go &= one_b != comp_a[r[0]]
        if same:
            go[:k] = False
        for q in np.flatnonzero(go):
            s = lb[q]
            both = np.minimum(points_a[r][:, None, :], points_b[s][None, :, :]).sum(axis=2)
            ok = (both >= needed(n_a[r][:, None], n_b[s][None, :], percent)) & (comp_a[r][:, None] != comp_b[s][None, :])
            i, j = np.nonzero(ok)
            out_i.append(r[i])
            out_j.append(s[j])
    if not out_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_j)


def tiles(rows: DataFrame) -> DataFrame:
    """``rows(center, rep, ...)`` dealt out to tiles (place, parts, lo, hi): small trees share one, large ones meet
    themselves part by part. ``own`` is the part of the row."""
    sizes = rows.groupBy("center").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts"))
    many = max(1, rows.count() // TILE)
    placed = rows.join(sizes, "center").withColumn("own", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    place = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("center"), F.lit(many))).otherwise(F.col("center"))
    return placed.withColumns({"place": place, "lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other")


def survivors(pdf: pd.DataFrame, percent: int) -> Iterator[tuple[int, int]]:
    """(i, j) of the rows of each tree in a tile that are in different components and may be similar by the bound."""
    raw, n, comp = pdf["point"].to_numpy(), pdf["n"].to_numpy(), pdf["comp"].to_numpy()
    lo, hi, own = pdf["lo"].iloc[0], pdf["hi"].iloc[0], pdf["own"].to_numpy()
    points = np.stack([folded_to(x, GROUPS) for x in raw])
    for rows in pdf.groupby("center", sort=False).indices.values():
        a, b = (rows, rows) if lo == hi else (rows[own[rows] == lo], rows[own[rows] == hi])
        if len(a) and len(b):
            i, j = surviving(points[a], n[a], comp[a], points[b], n[b], comp[b], percent, lo == hi)
            for x, y in zip(a[i], b[j], strict=True):
                if min(len(raw[x]), len(raw[y])) == 2 * GROUPS or shared_at_most(raw[x], raw[y]) >= needed(n[x], n[y], percent):
                    yield x, y


def links_across(postings: DataFrame, points: DataFrame, comps: DataFrame, sets, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): links enough to join the components that similar sets of one tree are still in.

    Trees with one center are searched as one: their sets are mostly the same ones. A first search, by points only, finds the sets
    that need to be looked at; a second one compares those, skips what is already joined, and returns a forest.
    """
    at = postings.join(comps, F.col("rep") == F.col("id"), "left").select("center", "rep", F.coalesce("component", "rep").alias("comp"))
    several = at.groupBy("center").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("m")).where("x < y and m > 2").select("center")
    apart = scratch.write(at.join(several, "center").join(points, "rep"), "apart")

    def look(pdf: pd.DataFrame) -> pd.DataFrame:
        both = {x for pair in survivors(pdf, percent) for x in pair}
        textops.give_back()
        return pdf.iloc[sorted(both)][["center", "rep"]]

    seen = tiles(apart).groupBy("place", "parts", "lo", "hi").applyInPandas(look, "center long, rep long").distinct()
    seen = scratch.write(seen, "seen")
    close = scratch.write(apart.join(seen, ["center", "rep"]).dropDuplicates(["center", "rep"]), "close")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        sets_, n, rep, root = pdf["hashes"].to_numpy(), pdf["n"].to_numpy(), pdf["rep"].to_numpy(), {}

        def find(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        comp, found = pdf["comp"].to_numpy(), []
        for x, y in survivors(pdf, percent):
            cx, cy = find(comp[x]), find(comp[y])
            if cx != cy and overlap(sets_[x], sets_[y]) >= needed(n[x], n[y], percent):
                root[max(cx, cy)] = min(cx, cy)
                found.append((rep[x], rep[y]))
        textops.give_back()
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    placed = tiles(close).join(sets(seen.select("rep").distinct()), "rep")
    return scratch.write(placed.groupBy("place", "parts", "lo", "hi").applyInPandas(compare, "a long, b long"), "links-1")


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """The number of equal entries of two arrays of distinct hashes, each in unsigned order."""
    a, b = np.asarray(a, np.int64).view(np.uint64), np.asarray(b, np.int64).view(np.uint64)
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def verified(pairs: DataFrame, sets, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Of pairs (a, b), those whose sets are similar: 100 |A and B| >= percent |A or B|. Only their texts are read."""
    pairs = scratch.write(pairs, f"{name}-pairs")
    own = scratch.write(sets(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()), f"{name}-sets")
    left, right = own.select(F.col("rep").alias("a"), F.col("hashes").alias("sa")), own.select(F.col("rep").alias("b"), F.col("hashes").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    ok = 100 * both >= percent * (F.size("sa") + F.size("sb") - both)
    return scratch.write(pairs.join(left, "a").join(right, "b").where(ok).select("a", "b"), name)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``; see the module for the cases."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, scratch))
    sigs = scratch.write(signatures(docs, frequent, percent), "signatures")
    sound = sigs.where("n > 0 and id is not null")

    # equal sets: the smallest id stands for all
    classes = scratch.write(sound.groupBy("node").agg(F.min("id").alias("first")), "classes")

    def sets(nodes: DataFrame) -> DataFrame:
        """(rep, hashes) of some nodes, from one text of each."""
        ids = nodes.join(classes, nodes.rep == classes.node).select(F.col("first").alias("id")).distinct()
        return set_table(docs.where(sieve(ids, "id")("id")).join(ids, "id", "left_semi")).join(nodes, "rep", "left_semi").dropDuplicates(["rep"])

    # trees of two or more points; those of one center are one from here on
    keyed = sound.select(F.col("node").alias("rep"), F.explode("keys").alias("key"))
    trees = keyed.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last")).where("center < last").select("key", "center")
    trees = scratch.write(trees, "trees")  # a join of two shuffled sides can split a large key
    postings = scratch.write(keyed.join(trees, "key").select("center", "rep").distinct(), "postings")
    met = postings.select("rep").distinct()
    points = sound.groupBy(F.col("node").alias("rep")).agg(F.first("n").alias("n"), F.first("point").alias("point")).join(met, "rep", "left_semi")
    points = scratch.write(points, "points")

    # the first point of each tree against the others
    star = postings.where("rep <> center").select(F.col("center").alias("a"), F.col("rep").alias("b"))
    links = verified(bounded(star, points, percent), sets, percent, scratch, "links-0")
    comps = components(links, scratch, "star")
    more = links_across(postings, points, comps, sets, percent, scratch)
    comps = components(links.unionByName(more), scratch, "all")

    # a component is named by the smallest id of its classes
    every = comps.unionByName(comps.select(F.col("component").alias("id"), "component").distinct()).withColumnRenamed("id", "node")
    names = every.join(classes, "node").groupBy("component").agg(F.min("first").alias("least"))
    named = every.join(names, "component").select("node", "least")
    labels = scratch.write(classes.join(named, "node", "left").select("node", F.coalesce("least", "first").alias("label")), "labels")
    out = sigs.select("id", "n", "node").join(labels, "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("label")), "id"))
    result = scratch.write(out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")), "result")
    scratch.keep_only("result")
    return result


def bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Pairs whose points allow the overlap that similar sets need."""
    left = points.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    right = points.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))
    sizes = (100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na"))

    def run(batches):
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            least = needed(na, nb, percent)
            ok = [shared_at_most(x, y) >= k for x, y, k in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), least, strict=True)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(left, "a").join(right, "b").where(sizes).select("a", "b", "na", "nb", "pa", "pb")
    return both.mapInArrow(textops.tidy(run), "a long, b long").distinct()


def set_table(docs: DataFrame) -> DataFrame:
    """(rep, hashes): the shingle set of each text and its digest."""

    def run(batches):
        for b in batches:
            sets = list(shingle_sets(b.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.array([digest(s) for s in sets], np.uint64))), lists([signed(s) for s in sets], pa.int64())], ["rep", "hashes"])

    return docs.select("id", "text").mapInArrow(textops.tidy(run), "rep long, hashes array<long>")
