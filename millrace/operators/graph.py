"""Lineage as relational work: edge extraction, many-root traversal, longest paths, propagation.

Vertices are any hashable value: a node id, or a struct such as (workspace, node) or (node, column)
made with ``pack``. All roots advance together, one join per round, and every round is a table in the
scratch folder; only "is this round empty" returns to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from millrace.functions.names import norm, trim
from millrace.functions.spread import small_or_spread, spread
from millrace.operators import reach
from millrace.sources.scratch import Scratch

# Function names that look like an alias in ``NAME.COLUMN`` text.
FUNCTION_NAMES = [
    "CAST", "TRIM", "NVL", "COALESCE", "IFF", "DECODE",
    "TO_CHAR", "TO_DATE", "TO_NUMBER", "TO_DECIMAL", "TO_DOUBLE",
    "REPLACE", "UPPER", "LOWER", "SUBSTR", "SUBSTRING",
    "LEFT", "RIGHT", "CONCAT",
    "MD5", "SHA1", "SHA2", "HASH",
    "ROW_NUMBER", "RANK", "DENSE_RANK",
    "ROUND", "TRUNC", "ABS", "CEIL", "FLOOR",
    "NULLIF", "IFNULL", "TRY_CAST",
]


def pack(df: DataFrame, **vertices: list[str]) -> DataFrame:
    """Replace columns by struct vertices: ``pack(e, src=["ws", "src"], dst=["ws", "dst"])``."""
    return df.select(*[F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(cs)]).alias(v) for v, cs in vertices.items()])


# ---- edges ---------------------------------------------------------------------------------


def extract_edges(nodes: DataFrame, rule: str = "lineage", refs: DataFrame | None = None) -> DataFrame:
    """(workspaceID, src, dst) of parsed node documents under one of four rules.

    ``lineage``: alias values and dependencies, inside the workspace. ``health``: those and the listed
    predecessors, inside the workspace. ``review``: the listed predecessors only, wherever they are, with ``pos``, their place in
    the list; a node that lists none has those of an object-shaped source mapping. ``join``: alias values; a node without any uses its column references (give ``refs``).
    """
    if rule in ("lineage", "health", "join"):  # read several times below, and the documents are long
        ends = lambda m: F.struct(m["aliases"].alias("aliases"), m["dependencies"].alias("dependencies"))
        listed = F.struct(F.transform("metadata.sourceMapping", ends).alias("sourceMapping")).alias("metadata")
        nodes = Scratch(nodes.sparkSession, "edges").write(nodes.select("workspaceID", "id", "predecessorNodeIDs", listed), "nodes")
    ws, dst = F.col("workspaceID"), F.col("id").alias("dst")
    mapping = nodes.select(ws, dst, F.explode("metadata.sourceMapping").alias("m"))
    aliases = mapping.select("workspaceID", F.explode(F.map_values("m.aliases")).alias("src"), "dst")
    text = mapping.select("workspaceID", F.explode("m.dependencies").alias("d"), "dst")
    dep = F.when(F.startswith(F.col("d"), F.lit("{")), F.get_json_object("d", "$.nodeID")).otherwise(F.col("d"))
    deps = text.select("workspaceID", dep.alias("src"), "dst")
    listed = nodes.select(ws, F.explode("predecessorNodeIDs").alias("src"), dst)
    if rule == "lineage":
        found, inside = aliases.unionByName(deps), True
    elif rule == "health":
        found, inside = aliases.unionByName(deps).unionByName(listed), True
    elif rule == "review":
        own = F.coalesce("predecessorNodeIDs", "mappedSources") if "mappedSources" in nodes.columns else F.col("predecessorNodeIDs")
        placed = nodes.select(ws, dst, F.posexplode(own).alias("pos", "src")).where("src IS NOT NULL")
        return placed.groupBy("workspaceID", "src", "dst").agg(F.min("pos").alias("pos"))
    elif rule == "join":
        named = aliases.filter("src <> ''")
        found, inside = named, False
        if refs is not None:
            other = refs.select("workspaceID", F.col("src_node").alias("src"), F.col("dst_node").alias("dst"))
            found = named.unionByName(other.join(spread(named.select("workspaceID", "dst").distinct()), ["workspaceID", "dst"], "left_anti"))
    else:
        raise ValueError("rule is lineage, health, review or join")
    found = found.filter("src IS NOT NULL").distinct()
    if inside:
        found = found.join(spread(nodes.select(ws, F.col("id").alias("src"))), ["workspaceID", "src"], "left_semi")
    return found.select("workspaceID", "src", "dst")


def column_edges(refs: DataFrame) -> DataFrame:
    """Column references as edges between (node, column) vertices; unknown ends are kept."""
    return pack(refs, src=["src_node", "src_column"], dst=["dst_node", "dst_column"]).distinct()


# ---- traversal -----------------------------------------------------------------------------


#: Roots that share a row: one bit each.
ROOT_BITS = 64


def traverse(edges: DataFrame, starts: DataFrame, max_depth: int | None = None, reverse: bool = False, label: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(root, node, depth) of everything reached from the (root, node) starts; starts are left out.

    Depth is the fewest hops. Cycles end by themselves: a vertex is reached once per root. ``label`` keeps or replaces
    nodes: a join by ``node`` that brings other columns in its place, or none of them.

    A graph of at most ``reach.MOST_EDGES`` edges is searched root by root in files of the shared folder, if that is mounted on
    the machines; pairs are then made where the result is read, without a shuffle. Others are searched in rounds.
    """
    scratch = Scratch(edges.sparkSession, "traverse")
    here, there = ("dst", "src") if reverse else ("src", "dst")
    step = scratch.write(edges.select(F.col(here).alias("node"), F.col(there).alias("next")), "edges")
    starts = scratch.write(starts.select("root", "node").distinct(), "starts")
    folder = scratch.mounted()
    if folder and step.count() <= reach.MOST_EDGES:
        return reach.search(step, starts, scratch, folder, max_depth, label)
    found = _rounds(step, starts, scratch, max_depth)
    return label(found) if label else found


def _rounds(step: DataFrame, starts: DataFrame, scratch: Scratch, max_depth: int | None) -> DataFrame:
    """``traverse`` by one join per round.

    Roots advance in blocks of ``ROOT_BITS``: a row is a node, a block and a mask of the block's roots that reach the node, and
    masks meet by ``bit_or``. Pairs of root and node are made only where the result is read, without a shuffle.
    """
    spark = step.sparkSession
    # Written as it comes, not partitioned by node: a hub with a great share of the edges would make
    # one huge partition. A small frontier is broadcast to it, a large one joins with skew handling.
    step = scratch.write(step.distinct(), "step")
    # neighbours in order share a block: they tend to reach the same nodes. A row's number counts within its partition.
    roots = starts.where("root IS NOT NULL").select("root").distinct().repartitionByRange("root").sortWithinPartitions("root")
    roots = scratch.write(roots.withColumn("number", F.monotonically_increasing_id()), "roots")
    roots = roots.select("root", F.shiftright("number", 6).alias("block"), (F.col("number") % ROOT_BITS).cast("int").alias("bit"))
    one = F.expr("shiftleft(1L, bit)")
    masks = lambda df, node: df.groupBy(F.col(node).alias("node"), "block").agg(F.bit_or("mask").alias("mask"))
    frontier = scratch.write(masks(starts.join(roots, "root").withColumn("mask", one), "node"), "reached/depth=0")
    shape = frontier.schema
    depth = 0
    while not frontier.isEmpty() and (max_depth is None or depth < max_depth):
        depth += 1
        seen = spark.read.schema(shape).parquet(*[f"{scratch.path}/reached/depth={d}" for d in range(depth)])
        reached = scratch.write(masks(small_or_spread(frontier).join(step, "node"), "next"), f"candidates/{depth}")
        # Only what was seen among the candidates matters: late rounds have few of them, so they are
        # broadcast against the seen masks, which then need no shuffle.
        known = masks(seen.join(small_or_spread(reached).select("node", "block"), ["node", "block"], "left_semi"), "node").withColumnRenamed("mask", "old")
        fresh = small_or_spread(reached).join(known, ["node", "block"], "left").withColumn("mask", F.expr("mask & ~coalesce(old, 0L)")).where("mask <> 0")
        frontier = scratch.write(fresh.select(*shape.names), f"reached/depth={depth}")
    members = scratch.write(roots.groupBy("block").agg(F.collect_list(F.struct("bit", "root")).alias("roots")), "members")
    scratch.keep_only("reached", "members")
    full = T.StructType([*shape.fields, T.StructField("depth", T.IntegerType())])
    found = spark.read.schema(full).parquet(f"{scratch.path}/reached").where("depth > 0").join(members, "block")
    held = F.filter("roots", lambda r: F.getbit("mask", r["bit"]) == 1)
    return found.select(F.explode(F.transform(held, lambda r: r["root"])).alias("root"), "node", "depth")


def upstream(edges: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Everything the (root) nodes come from, with depth."""
    return traverse(edges, roots.select("root", F.col("root").alias("node")), max_depth, reverse=True)


def downstream(edges: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Everything the (root) nodes feed, with depth."""
    return traverse(edges, roots.select("root", F.col("root").alias("node")), max_depth)


def column_lineage(col_edges: DataFrame, roots: DataFrame, columns: DataFrame) -> DataFrame:
    """Both directions from (node, column) roots. Unknown columns are passed through, not returned.

    ``col_edges`` from ``column_edges``; ``roots``: node_id, column_id; ``columns``: node_id,
    column_id, name.
    """
    start = pack(roots, root=["node_id", "column_id"]).withColumn("node", F.col("root"))
    known = lambda reached: _known_columns(reached, columns)
    up = traverse(col_edges, start, reverse=True, label=known).withColumn("direction", F.lit("upstream"))
    down = traverse(col_edges, start, label=known).withColumn("direction", F.lit("downstream"))
    return up.unionByName(down)


def _known_columns(reached: DataFrame, columns: DataFrame) -> DataFrame:
    """Vertices that are columns, with their names."""
    flat = reached.withColumns({"node_id": F.col("node.p0"), "column_id": F.col("node.p1")}).drop("node")
    return flat.join(spread(columns.select("node_id", "column_id", "name")), ["node_id", "column_id"])


def impact_nodes(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Downstream nodes per root with depth."""
    return downstream(edges, roots)


def impact_columns(col_edges: DataFrame, columns: DataFrame, roots: DataFrame) -> DataFrame:
    """Downstream columns per root: of one column if ``roots`` has column_id, else of all its columns.

    A column reached from several of the root's columns keeps its least depth.
    """
    own = columns.select(F.col("node_id").alias("root"), "column_id")
    keys = ["root", "column_id"] if "column_id" in roots.columns else ["root"]
    start = own.join(spread(roots.select(*keys).distinct()), keys, "left_semi")
    start = start.select("root", F.struct(F.col("root").alias("p0"), F.col("column_id").alias("p1")).alias("node"))
    return traverse(col_edges, start, label=lambda reached: _known_columns(reached, columns))


def impact_summary(nodes_hit: DataFrame, columns_hit: DataFrame) -> DataFrame:
    """Per root: how many nodes and columns are hit, and how deep it goes."""
    n = nodes_hit.groupBy("root").agg(F.count(F.lit(1)).alias("impacted_nodes"), F.max("depth").alias("deepest"))
    c = columns_hit.groupBy("root").agg(F.count(F.lit(1)).alias("impacted_columns"))
    return n.join(spread(c), "root", "full").fillna(0, ["impacted_nodes", "impacted_columns", "deepest"])


def impact_by_depth(nodes_hit: DataFrame) -> DataFrame:
    return nodes_hit.groupBy("root", "depth").agg(F.count(F.lit(1)).alias("nodes"))


# ---- longest paths -------------------------------------------------------------------------


def longest_paths(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(root, node, dist, prev): most hops from the root's starts, by peeling.

    A vertex passes on its distance once all its edges inside the root's reach have arrived; one on
    or behind a cycle never does, but still holds what it received. The lowest predecessor wins a tie.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "peel")
    starts = scratch.write(starts.select("root", "node").distinct(), "starts")
    reach = traverse(edges, starts).select("root", "node").unionByName(starts)
    step = edges.select(F.col("src").alias("node"), F.col("dst").alias("next")).distinct()
    inner = scratch.write(reach.join(spread(step), "node").select("root", "node", "next"), "inner")
    need = scratch.write(inner.groupBy("root", F.col("next").alias("node")).agg(F.count(F.lit(1)).alias("need")), "need")
    kind = edges.schema["src"].dataType
    first = starts.join(spread(need), ["root", "node"], "left_anti")
    ready = scratch.write(
        first.select("root", "node", F.lit(0).alias("neg"), F.lit(None).cast(kind).alias("prev")), "ready/round=0"
    )
    shape = ready.schema
    waiting, rnd = None, 0
    while not ready.isEmpty():
        rnd += 1
        sent = small_or_spread(ready).join(inner, ["root", "node"]).groupBy("root", F.col("next").alias("node")).agg(
            F.count(F.lit(1)).alias("got"), F.min(F.struct((F.col("neg") - 1).alias("neg"), F.col("node").alias("prev"))).alias("best")
        )
        if waiting is not None:
            sent = waiting.unionByName(sent).groupBy("root", "node").agg(F.sum("got").alias("got"), F.min("best").alias("best"))
        state = scratch.write(
            sent.join(spread(need), ["root", "node"]).select("root", "node", "got", "best", (F.col("got") == F.col("need")).alias("full")),
            f"state/{rnd}",
        )
        ready = scratch.write(state.filter("full").select("root", "node", "best.neg", "best.prev"), f"ready/round={rnd}")
        waiting = state.filter("NOT full").select("root", "node", "got", "best")
    done = spark.read.schema(shape).parquet(f"{scratch.path}/ready").select(*shape.names)
    if waiting is not None:
        done = done.unionByName(waiting.select("root", "node", "best.neg", "best.prev"))
    out = done.select("root", "node", (-F.col("neg")).alias("dist"), "prev")
    stuck = starts.join(spread(out), ["root", "node"], "left_anti")
    return out.unionByName(stuck.select("root", "node", F.lit(0).alias("dist"), F.lit(None).cast(kind).alias("prev")))


def critical_path(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, position, node) of the longest path from each root; the lowest far end wins a tie."""
    spark = edges.sparkSession
    scratch = Scratch(spark, "path")
    paths = scratch.write(longest_paths(edges, roots.select("root", F.col("root").alias("node"))), "paths")
    far = paths.groupBy("root").agg(F.min(F.struct((-F.col("dist")).alias("neg"), F.col("node").alias("node"))).alias("b"))
    here = far.select("root", (-F.col("b.neg")).alias("position"), F.col("b.node").alias("node"))
    here, rnd = scratch.write(here, "walk/0"), 0
    back = paths.filter("prev IS NOT NULL").select("root", "node", "prev")
    names = [f"{scratch.path}/walk/0"]
    while True:
        rnd += 1
        moved = small_or_spread(here).join(back, ["root", "node"]).select("root", (F.col("position") - 1).alias("position"), F.col("prev").alias("node"))
        here = scratch.write(moved, f"walk/{rnd}")
        if here.isEmpty():
            break
        names.append(f"{scratch.path}/walk/{rnd}")
    return spark.read.schema(here.schema).parquet(*names)


def _followed(up: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, bool]:
    """(node_id, at, hops, low, done) after following ``up(node_id, up)`` to its end, and whether all nodes got there.

    Every round doubles the way, and is a written table. Nodes that are not done after as many hops as there are nodes
    are in a cycle or lead into one; low is the least node of the way.
    """
    end = F.coalesce("up", "node_id")
    rows = up.select("node_id", end.alias("at"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("hops"), F.least("node_id", end).alias("low"), F.col("up").isNull().alias("done"))
    rows, reach, most = scratch.write(rows, f"{name}/0"), 1, up.count()
    while True:
        if rows.filter("not done").isEmpty():
            return rows, True
        if reach > most:
            return rows, False
        far = rows.select(F.col("node_id").alias("at"), *[F.col(c).alias(f"far_{c}") for c in ("at", "hops", "low", "done")])
        moved = rows.filter("not done").join(spread(far), "at", "left").select(
            "node_id",
            F.coalesce("far_at", "at").alias("at"),
            (F.col("hops") + F.coalesce("far_hops", F.lit(0))).alias("hops"),
            F.least("low", "far_low").alias("low"),
            F.coalesce("far_done", F.lit(True)).alias("done"),
        )
        reach *= 2
        rows = scratch.write(rows.filter("done").unionByName(moved), f"{name}/{reach}")


def chain_depth(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Hops along the first predecessor only, however many; a chain that repeats a node counts its different nodes.

    ``edges`` hold src, dst and pos (lowest pos is the first predecessor; without it the greatest src).
    """
    rank = F.min_by("src", "pos") if "pos" in edges.columns else F.max("src")
    first = edges.groupBy(F.col("dst").alias("node_id")).agg(rank.alias("up"))
    scratch = Scratch(nodes.sparkSession, "chain")
    up = scratch.write(nodes.select("node_id").distinct().join(spread(first), "node_id", "left"), "up")
    rows, ended = _followed(up, scratch, "way")
    depth = rows.select("node_id", F.col("hops").cast("int").alias("chain_depth"))
    if ended:
        return depth
    lost = rows.filter("not done")
    cycle = scratch.write(lost.join(lost.select(F.col("at").alias("node_id")).distinct(), "node_id", "left_semi").select("node_id", "low"), "cycles")
    sizes = cycle.join(cycle.groupBy("low").agg(F.count(F.lit(1)).alias("size")), "low").select(F.col("node_id").alias("at"), "size")
    # with the cycles' own steps taken out, what leads into them ends there
    cut = up.join(cycle.select("node_id", F.lit(True).alias("in_cycle")), "node_id", "left")
    into, _ = _followed(cut.select("node_id", F.when(F.col("in_cycle").isNull(), F.col("up")).alias("up")), scratch, "into")
    return into.join(sizes, "at", "left").select("node_id", (F.col("hops") + F.coalesce("size", F.lit(0))).cast("int").alias("chain_depth"))


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per workspace: roots, leaves, mean fan-out to one decimal, greatest depth."""
    out_deg = edges.groupBy(F.col("src").alias("node_id")).agg(F.count(F.lit(1)).alias("out"))
    in_deg = edges.groupBy(F.col("dst").alias("node_id")).agg(F.count(F.lit(1)).alias("in"))
    deg = nodes.select("workspace_id", "node_id").join(spread(out_deg), "node_id", "left").join(spread(in_deg), "node_id", "left")
    stats = deg.groupBy("workspace_id").agg(
        F.count_if(F.col("in").isNull()).alias("root_nodes"),
        F.count_if(F.col("out").isNull()).alias("leaf_nodes"),
        F.round(F.coalesce(F.sum("out"), F.lit(0)) / F.count(F.lit(1)), 1).alias("avg_fan_out"),
    )
    starts = deg.filter(F.col("in").isNull()).select(F.col("workspace_id").alias("root"), F.col("node_id").alias("node"))
    deepest = longest_paths(edges, starts).groupBy(F.col("root").alias("workspace_id")).agg(F.max("dist").alias("max_depth"))
    return stats.join(deepest, "workspace_id", "left").fillna(0, ["max_depth"])


# ---- column changes and references -----------------------------------------------------------


def propagate_column_change(columns: DataFrame, col_edges: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all columns after, before-image of the changed ones).

    ``changes``: node_id, column_id, new_name, new_type; a null leaves that side as it is. A column
    below several changes follows the nearest, then the lowest source. Publish the first frame as one
    snapshot to make it all or nothing.
    """
    start = pack(changes, root=["node_id", "column_id"]).withColumn("node", F.col("root"))
    reached = traverse(col_edges, start)
    nearest = reached.groupBy("node").agg(F.min(F.struct("depth", "root")).alias("m"))
    named = changes.select(
        F.struct(F.col("node_id").alias("p0"), F.col("column_id").alias("p1")).alias("root"), "new_name", "new_type"
    )
    new = nearest.select(
        F.col("node.p0").alias("node_id"), F.col("node.p1").alias("column_id"), F.col("m.root").alias("root")
    ).join(spread(named), "root").drop("root")
    both = columns.join(spread(new.withColumn("changed", F.lit(True))), ["node_id", "column_id"], "left")
    after = both.withColumns(
        {
            "name": F.coalesce("new_name", "name"),
            "data_type": F.coalesce("new_type", "data_type"),
            "changed": F.coalesce("changed", F.lit(False)),
        }
    ).drop("new_name", "new_type")
    return after, both.filter("changed").select(*columns.columns)


def scan_text(transform: Column) -> Column:
    """Text safe for scanning: literals emptied, dots inside quoted names neutralised, plain names unquoted."""
    pieces = F.regexp_extract_all(transform, F.lit(r"(\"(?:[^\"]|\"\")*\"|'[^']*'|[^\"']+|.)"), F.lit(1))

    def clean(p: Column) -> Column:
        inner = F.translate(p, ".", "_")
        bare = F.regexp_replace(inner, r"^\"([A-Za-z_][\w$]*)\"$", "$1")
        return F.when(F.startswith(p, F.lit('"')), bare).when(F.startswith(p, F.lit("'")), F.lit("''")).otherwise(p)

    return F.array_join(F.transform(pieces, clean), "")


def qualified_refs(transform: Column) -> Column:
    """Distinct ``ALIAS.COLUMN`` of an expression, upper-cased, function names left out."""
    found = F.regexp_extract_all(F.upper(scan_text(transform)), F.lit(r"\b([A-Z_]\w*\.[A-Z_]\w*)\b"), F.lit(1))
    return F.array_distinct(F.filter(found, lambda r: ~F.substring_index(r, ".", 1).isin(*FUNCTION_NAMES)))


def infer_column_refs(columns: DataFrame, aliases: DataFrame, source_columns: DataFrame) -> DataFrame:
    """Resolve expressions to upstream columns.

    ``columns``: node_id, column_id, name, transform. ``aliases``: node_id, pos, alias, src_node (the
    lowest pos is the default). ``source_columns``: node_id, column_id, name.

    By one reference: the aliased predecessor (or the default), else any predecessor in order, looking
    for the referenced name and then for the column's own. Failing that, all references of a
    several-alias expression (``multi``), or those that resolve (``partial``).
    """
    text = trim(F.coalesce("transform", F.lit("")))
    refs = qualified_refs(text)
    rows = columns.select("node_id", "column_id", F.upper("name").alias("own"), text.alias("text"), refs.alias("refs"))
    one_alias = F.size(F.array_distinct(F.transform("refs", lambda r: F.substring_index(r, ".", 1)))) == 1
    bare = F.upper(F.regexp_replace("text", r'^"(.*)"$', "$1"))
    is_bare = (
        (F.size("refs") == 0) & (F.col("text") != "") & ~F.col("text").rlike(r"[.(']") & ~bare.rlike(r"^\d+(\.\d+)?$")
    )
    head = F.col("refs")[0]
    rows = rows.withColumns(
        {
            "alias": F.when(one_alias, F.substring_index(head, ".", 1)),
            "wanted": F.when(one_alias, F.substring_index(head, ".", -1)).when(is_bare, bare),
        }
    ).withColumn("wanted", F.coalesce("wanted", "own"))

    lookup = source_columns.groupBy(F.col("node_id").alias("src_node"), F.upper("name").alias("key")).agg(
        F.min("column_id").alias("src_column")
    )
    known = aliases.withColumn("alias_key", F.upper("alias")).select("node_id", "pos", "alias_key", "src_node")
    available = known.join(lookup, "src_node")
    default = known.groupBy("node_id").agg(F.min("pos").alias("default_pos"))
    mapped = known.groupBy("node_id", F.col("alias_key").alias("alias")).agg(F.min("pos").alias("alias_pos"))
    aimed = rows.join(mapped, ["node_id", "alias"], "left").join(default, "node_id").withColumn(
        "target_pos", F.coalesce("alias_pos", "default_pos")
    )
    names = aimed.select("node_id", "column_id", "target_pos", F.posexplode(F.array_distinct(F.array("wanted", "own"))).alias("name_no", "key"))
    single = (
        names.join(available, ["node_id", "key"])
        .groupBy("node_id", "column_id")
        .agg(
            F.min_by(
                F.struct("src_node", "src_column"),
                F.struct((F.col("pos") != F.col("target_pos")).alias("off"), F.col("pos"), F.col("name_no")),
            ).alias("s")
        )
        .select("node_id", "column_id", "s.*", F.lit("single").alias("strategy"))
    )
    several = rows.filter(F.size("refs") > 1).join(single, ["node_id", "column_id"], "left_anti")
    each = several.select(
        "node_id",
        "column_id",
        F.size("refs").alias("n_refs"),
        F.explode(F.transform("refs", lambda r: F.struct(F.substring_index(r, ".", 1).alias("a"), F.substring_index(r, ".", -1).alias("k")))).alias("r"),
    ).select("node_id", "column_id", "n_refs", F.col("r.a").alias("alias_key"), F.col("r.k").alias("key"))
    hits = each.join(available, ["node_id", "alias_key", "key"])
    found = hits.groupBy("node_id", "column_id").agg((F.count(F.lit(1)) == F.max("n_refs")).alias("all_found"))
    multi = hits.join(found, ["node_id", "column_id"]).select(
        "node_id", "column_id", "src_node", "src_column", F.when(F.col("all_found"), "multi").otherwise("partial").alias("strategy")
    )
    return single.unionByName(multi)


IDENT = r"\"[A-Za-z_][\w$]*\""
REF_CALL = r"\{\{\s*ref\s*\(\s*['\"][^'\"]+['\"]\s*,\s*['\"][^'\"]+['\"]\s*\)\s*\}\}"
REF_PARTS = r"ref\s*\(\s*['\"]([^'\"]+)['\"]\s*,\s*['\"]([^'\"]+)['\"]"


def source_names(sql: Column) -> Column:
    """Array of (location, name) that a statement reads: ref() calls, three-part and two-part names.

    A two-part name counts only right after FROM, JOIN or a comma; elsewhere it is alias and column.
    """

    def pair(text: Column, pattern: str) -> Column:
        return F.struct(F.regexp_extract(text, pattern, 1).alias("location"), F.regexp_extract(text, pattern, 2).alias("name"))

    calls = F.transform(F.regexp_extract_all(sql, F.lit(f"(?i)({REF_CALL})"), F.lit(1)), lambda m: pair(m, f"(?i){REF_PARTS}"))
    name = r"\"([A-Za-z_][\w$]*)\""
    three = F.transform(
        F.regexp_extract_all(sql, F.lit(rf"({IDENT}\s*\.\s*{IDENT}\s*\.\s*{IDENT})"), F.lit(1)),
        lambda m: pair(m, rf"{IDENT}\s*\.\s*{name}\s*\.\s*{name}"),
    )
    two = F.transform(
        F.regexp_extract_all(sql, F.lit(rf"(?i)(?:\bFROM|\bJOIN|,)\s*({IDENT}\s*\.\s*{IDENT})(?!\s*\.)"), F.lit(1)),
        lambda m: pair(m, rf"{name}\s*\.\s*{name}"),
    )
    return F.array_distinct(F.concat(calls, three, two))


def refs_from_sql(corpus: DataFrame, sql: str = "sql") -> DataFrame:
    """(node_id, location, name) read by each stored statement."""
    return corpus.select("node_id", F.inline(source_names(F.col(sql))))


def preserve_lineage(new_columns: DataFrame, old_columns: DataFrame) -> DataFrame:
    """New columns keep the old references of the same name unless they bring their own.

    Both: node_id, name, refs (array, may be null or empty).
    """
    old = old_columns.filter(F.size("refs") > 0).groupBy("node_id", norm("name").alias("__key")).agg(F.max("refs").alias("__old"))
    joined = new_columns.withColumn("__key", norm("name")).join(spread(old), ["node_id", "__key"], "left")
    own = F.coalesce(F.size("refs") > 0, F.lit(False))
    return joined.withColumn("refs", F.when(own, F.col("refs")).otherwise(F.coalesce("__old", "refs"))).drop("__key", "__old")
