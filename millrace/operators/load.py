"""Warehouse load patterns as pure frame-to-frame functions; storing the result is the caller's step.

A change set is usually far smaller than its target. Merges therefore never full-outer-join: the
target is only anti- or semi-joined against the change set, which Catalyst can broadcast when its size
allows, so an unchanged target row is read and passed on without a shuffle. Keys compare null-safe. A
change set holds one row per key (see ``windows.latest_per_key``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from millrace.functions.ordered import HOT_ROWS, hot_keys, neighbour, numbered
from millrace.functions.spread import small_or_spread
from millrace.operators import patterns
from millrace.operators.aggregate import join_to_aggregation
from millrace.operators.windows import latest_per_key
from millrace.sources.scratch import Scratch


def _semi(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    small = right.select(*[F.col(k).alias(f"__{k}") for k in keys])
    return left.join(small, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]), how)


def _measured(df: DataFrame, keys: list[str], options: dict) -> dict:
    """Options with the large keys of ``df``, for helpers that order its rows, or some of them, again and again."""
    return options if "hot" in options else options | {"hot": hot_keys(df, keys, options.get("hot_rows", HOT_ROWS))}


def hash_of(columns: list[str]) -> Column:
    """SHA-256 of the columns' text, trimmed; null and empty text count as the same.

    Each part follows its length, so that no text can be taken for the end of one part and the start of the next.
    """
    parts = [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) for c in columns]
    return F.sha2(F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)]), 256)


# ---- merge -----------------------------------------------------------------------------------


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    high_water: str | None = None,
    tie: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Target with the source's rows put in; with ``high_water``, only newer rows, newest per key.

    A column the source lacks keeps the target's value. Without ``high_water`` there is no order to choose
    by, so a second source row for a key is an error; one count over the change set finds it, which ``unique`` spares a caller who knows.
    """
    if high_water:
        source = latest_per_key(newer_rows(source, target, high_water), keys, high_water, tie)
    elif not unique and not grain_violations(source, keys).isEmpty():
        raise ValueError(f"the source of a merge has several rows for one key of {keys}")
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        old = _semi(target, source, keys, "left_semi").select(*[F.col(k).alias(f"__{k}") for k in keys], *missing)
        on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        source = source.join(old, on, "left").drop(*[f"__{k}" for k in keys])
    kept = _semi(target, source, keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def dimension_scd1(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Overwrite the attributes of known keys, insert new keys."""
    return merge_upsert(target, source, keys)


def persistent_stage(
    target: DataFrame, source: DataFrame, keys: list[str], kind: int = 1, tracked: list[str] | None = None, as_of: Column | None = None
) -> DataFrame:
    """Rows kept across runs: type 1 holds the latest version, type 2 all of them."""
    if kind == 1:
        return merge_upsert(target, source, keys)
    if as_of is None:
        raise ValueError("a type 2 stage needs as_of")
    return dimension_scd2(target, source, keys, tracked or [c for c in source.columns if c not in keys], as_of)


def dimension_scd2(
    target: DataFrame, source: DataFrame, keys: list[str], tracked: list[str], as_of: Column, close_missing: bool = False
) -> DataFrame:
    """Close the current version of a changed key and open a new one, half-open in time.

    ``target`` adds valid_from, valid_to (null = current) and is_current to the source's columns. A key
    missing from the source is left alone unless ``close_missing``.
    """
    past, current = target.filter("NOT is_current"), target.filter("is_current")
    old = current.alias("t")
    new = source.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(c).alias(f"__n_{c}") for c in tracked], F.lit(True).alias("__hit"))
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__n_{c}")) for c in tracked], F.lit(True))
    hit = F.coalesce("__hit", F.lit(False))
    close = (hit & ~same) | (F.lit(close_missing) & ~hit)
    checked = old.join(new, on, "left").withColumn("__close", close)
    closed = checked.withColumns(
        {
            "valid_to": F.when(F.col("__close"), as_of).otherwise(F.col("valid_to")),
            "is_current": F.when(F.col("__close"), F.lit(False)).otherwise(F.col("is_current")),
        }
    ).select(*target.columns)
    held = _semi(current, source, keys, "left_semi").select(
        *[F.col(k).alias(f"__{k}") for k in keys], *[F.col(c).alias(f"__n_{c}") for c in tracked]
    )
    opened = source.join(held, on & same, "left_anti").withColumns(
        {"valid_from": as_of, "valid_to": F.lit(None).cast(target.schema["valid_to"].dataType), "is_current": F.lit(True)}
    )
    return past.unionByName(closed).unionByName(opened.select(*target.columns))


def scd2_from_history(
    df: DataFrame, keys: list[str], tracked: list[str], ts: str, tie: str, **options: int
) -> DataFrame:
    """All versions of every key from a change log: a version starts where a tracked value changes."""
    options = _measured(df, keys, options)
    before = neighbour(df, keys, ts, tie, {c: f"__p_{c}" for c in tracked}, -1, "__has", **options)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__p_{c}")) for c in tracked])
    starts = before.filter(~F.col("__has") | ~same).select(*dict.fromkeys([*keys, *tracked, ts, tie]))
    versions = neighbour(starts, keys, ts, tie, {ts: "valid_to"}, 1, **options)
    return versions.select(*keys, *tracked, F.col(ts).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"))


def high_water_mark(target: DataFrame, column: str) -> object:
    """The greatest value loaded so far: one number or time to the driver."""
    return target.agg(F.max(column)).first()[0]


def newer_rows(source: DataFrame, target: DataFrame, column: str, default: str = "1900-01-01") -> DataFrame:
    """Source rows above the target's mark; the mark is a literal, so the filter reaches the scan."""
    mark = high_water_mark(target, column)
    value = F.lit(default) if mark is None else F.lit(mark)
    return source.filter(F.col(column) > value.cast(source.schema[column].dataType))


def incremental_load(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Target with the newer source rows appended; no update of old rows."""
    return target.unionByName(newer_rows(source, target, column).select(*target.columns))


def append_increment(source: DataFrame, target: DataFrame, column: str, path: str) -> None:
    """Append the newer rows to the stored target; the old files are not touched."""
    newer_rows(source, target, column).select(*target.columns).write.mode("append").parquet(path)


# ---- facts and vault ---------------------------------------------------------------------------


def fact(
    dfs: dict[str, DataFrame], grain: list[str], measures: dict[str, str], target: DataFrame | None = None, how: str = "inner"
) -> DataFrame:
    """One row per grain with aggregated measures; merged into ``target`` on the grain if given."""
    rows = join_to_aggregation(dfs, grain, measures, how)
    names = [g.split(".")[-1] for g in grain]
    return rows if target is None else merge_upsert(target, rows, names, unique=True)


def grain_violations(df: DataFrame, grain: list[str]) -> DataFrame:
    """Grain values that occur more than once."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def factless_fact(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def hub(
    df: DataFrame, business_keys: list[str], load_ts: Column, record_source: str, existing: DataFrame | None = None
) -> DataFrame:
    """One row per hash key with business key, first load time and source; only keys not in ``existing``.

    Business keys that share a hash key (they differ in blanks around them, or in null and empty) are one; the least
    spelling stands for all.
    """
    rows = (
        df.withColumns({"__ts": load_ts, "hash_key": hash_of(business_keys)})
        .groupBy("hash_key")
        .agg(F.min(F.struct(*business_keys)).alias("__key"), F.min("__ts").alias("load_ts"))
        .select(*[F.col(f"__key.{c}") for c in business_keys], "load_ts", "hash_key", F.lit(record_source).alias("record_source"))
    )
    return rows if existing is None else rows.join(existing.select("hash_key"), "hash_key", "left_anti")


def link(
    df: DataFrame, hubs: dict[str, list[str]], load_ts: Column, record_source: str, existing: DataFrame | None = None
) -> DataFrame:
    """Distinct relationships of two hubs or more, each side by its hash key.

    Rows are grouped by what is hashed, which is shorter than its hashes: numbers as they are, else the text that ``hash_of`` reads.
    """
    if len(hubs) < 2:
        raise ValueError("a link joins at least two hubs")
    keys = {c: f"__key{i}" for i, c in enumerate(dict.fromkeys(c for cs in hubs.values() for c in cs))}
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}
    read = [F.col(c).alias(k) if c in whole else F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")).alias(k) for c, k in keys.items()]
    rows = df.select(load_ts.alias("__ts"), *read).groupBy(*keys.values()).agg(F.min("__ts").alias("load_ts"))
    rows = rows.select(*[hash_of([keys[c] for c in cs]).alias(n) for n, cs in hubs.items()], "load_ts")
    rows = rows.withColumns({"hash_key": hash_of(list(hubs)), "record_source": F.lit(record_source)})
    return rows if existing is None else rows.join(existing.select("hash_key"), "hash_key", "left_anti")


def satellite(
    df: DataFrame,
    hub_keys: list[str],
    attributes: list[str],
    ts: str,
    tie: str,
    record_source: str,
    existing: DataFrame | None = None,
    **options: int,
) -> DataFrame:
    """Attribute history of a hub: a row only where the hash of the attributes changes.

    With ``existing``, its latest row per key is what the first new row is compared with.
    """
    rows = df.select(*dict.fromkeys([*hub_keys, *attributes, ts, tie])).withColumns(
        {"hash_key": hash_of(hub_keys), "hash_diff": hash_of(attributes), "__old": F.lit(False)}
    )
    if existing is not None:
        last = latest_per_key(existing, ["hash_key"], ts).withColumns({"__old": F.lit(True), tie: F.lit(None).cast(df.schema[tie].dataType)})
        rows = rows.unionByName(last.select(*rows.columns))
    rows = neighbour(rows, ["hash_key"], ts, tie, {"hash_diff": "__before"}, -1, **options)
    changed = ~F.col("hash_diff").eqNullSafe(F.col("__before"))
    return rows.filter(changed & ~F.col("__old")).select(
        *dict.fromkeys(["hash_key", *hub_keys, *attributes, ts, tie, "hash_diff"]), F.lit(record_source).alias("record_source")
    )


# ---- views, aggregates, shapes -------------------------------------------------------------------


def view(df: DataFrame, name: str) -> None:
    """Recomputed at each use."""
    df.createOrReplaceTempView(name)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Stored once, read from then on."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Measure:
    function: str  # sum, count, min or max: those whose parts can be merged
    column: str


MERGE_WITH = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def materialised_aggregate(df: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    return df.groupBy(*keys).agg(*[getattr(F, m.function)(m.column).alias(n) for n, m in measures.items()])


def refresh_aggregate(stored: DataFrame, new_rows: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    """The stored aggregate brought up to date from new rows only."""
    parts = stored.unionByName(materialised_aggregate(new_rows, keys, measures))
    return parts.groupBy(*keys).agg(*[MERGE_WITH[m.function](n).alias(n) for n, m in measures.items()])


def signed_aggregate(df: DataFrame, keys: list[str], measures: dict[str, Measure]) -> DataFrame:
    """A materialised aggregate that changes and deletions can be applied to: with the rows of each group, and with the values that
    are not null of each measure."""
    held = [F.count(m.column).alias(f"{n}__held") for n, m in measures.items()]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), *held, *[getattr(F, m.function)(m.column).alias(n) for n, m in measures.items()])


def apply_signed(stored: DataFrame, changes: DataFrame, keys: list[str], measures: dict[str, Measure], rows_now: DataFrame, sign: str = "sign") -> DataFrame:
    """The aggregate of ``signed_aggregate`` after ``changes``: rows with a sign, 1 for one that came and -1 for one that went; an
    update is one of each.

    Rows that came and went again are taken off each other first. Counts and sums add up by sign. A least or greatest value
    is read again from ``rows_now`` only for the groups that lost a row with it; ``rows_now`` holds the rows after the changes. Groups
    without rows end.
    """
    columns = sorted({m.column for m in measures.values()} - set(keys))
    net = changes.groupBy(*keys, *columns).agg(F.sum(F.col(sign).cast("long")).alias("__by")).where("__by <> 0")
    by, came = F.col("__by"), F.col("__by") > 0
    parts = [F.sum(by).alias("__rows")]
    for n, m in measures.items():
        value = F.col(m.column)
        parts.append(F.sum(F.when(value.isNotNull(), by).otherwise(0)).alias(f"{n}__held"))
        if m.function in ("min", "max"):
            pick = getattr(F, m.function)
            parts += [pick(F.when(came, value)).alias(n), pick(F.when(~came, value)).alias(f"{n}__gone")]
        elif m.function == "sum":
            parts.append(F.sum(value * by).alias(n))
        else:
            parts.append(F.sum(F.when(value.isNotNull(), by).otherwise(0)).alias(n))
    delta = net.groupBy(*keys).agg(*parts)
    kinds = dict(stored.dtypes)
    both = stored.unionByName(delta.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in delta.columns]), allowMissingColumns=True)
    merged = [F.sum("__rows").alias("__rows")]
    for n, m in measures.items():
        merged.append(F.sum(f"{n}__held").alias(f"{n}__held"))
        if m.function in ("min", "max"):
            pick = getattr(F, m.function)
            merged += [pick(n).alias(n), pick(f"{n}__gone").alias(f"{n}__gone")]
        else:
            merged.append(F.sum(n).alias(n))
    scratch = Scratch(stored.sparkSession, "signed")
    groups = scratch.write(both.groupBy(*keys).agg(*merged).where("__rows > 0"), "groups")
    extremes = {n: m for n, m in measures.items() if m.function in ("min", "max")}
    lost = {n: F.coalesce(F.col(f"{n}__gone") <= F.col(n) if m.function == "min" else F.col(f"{n}__gone") >= F.col(n), F.lit(False)) for n, m in extremes.items()}
    out = groups.withColumns({n: F.when(F.col(f"{n}__held") > 0, F.col(n)).cast(kinds[n]) for n in measures if measures[n].function == "sum"})
    if extremes:
        some = reduce(Column.__or__, lost.values())
        again = scratch.write(groups.where(some).select(*keys), "lost")
        found = _semi(rows_now, again, keys, "left_semi").groupBy(*keys).agg(*[getattr(F, m.function)(m.column).alias(f"{n}__new") for n, m in extremes.items()])
        right = found.select(*[F.col(k).alias(f"__{k}") for k in keys], *[f"{n}__new" for n in extremes])
        out = out.join(right, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]), "left")
        out = out.withColumns({n: F.when(lost[n], F.col(f"{n}__new")).otherwise(F.col(n)) for n in extremes})
    return out.select(*stored.columns)


def pivot(df: DataFrame, keys: list[str], column: str, values: list[object], agg: Column) -> DataFrame:
    """Rows to columns; the values are given, so no extra pass looks for them."""
    return df.groupBy(*keys).pivot(column, values).agg(agg)


def unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(keys, columns, name, value)


def date_dimension(df: DataFrame, column: str) -> DataFrame:
    """One row per calendar day between the least and greatest date of the column."""
    span = df.agg(F.min(F.to_date(column)).alias("a"), F.max(F.to_date(column)).alias("b"))
    days = span.filter("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("day"))
    return days.select(
        "day",
        F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"),
        F.year("day").alias("year"),
        F.quarter("day").alias("quarter"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        (F.weekday("day") + 1).alias("iso_weekday"),
        F.weekofyear("day").alias("iso_week"),
        (F.weekday("day") >= 5).alias("is_weekend"),
        (F.last_day("day") == F.col("day")).alias("is_month_end"),
    )


def sequence_match(
    df: DataFrame, keys: list[str], ts: str, tie: str, column: str, pattern: list[str] | str, **options: int
) -> DataFrame:
    """Where consecutive rows of a key follow the pattern: one row per match, by its first row.

    A text is a pattern with alternatives, options and counts, as ``signup (view | click){1,3} purchase? error*``: one row
    for every row with which a match ends, with the longest one (see ``patterns``). A list is one step after the other:

    A step with a trailing ``+`` stands for one or more equal rows; such patterns are matched over runs
    of equal values, and neighbouring steps must then differ. Rows look at their neighbours only, so no
    key is gathered into one list.
    """
    if isinstance(pattern, str):
        return patterns.matches(df, keys, ts, tie, column, pattern, **options)
    options = _measured(df, keys, options)
    steps = [(p.removesuffix("+"), p.endswith("+")) for p in pattern]
    if not any(many for _, many in steps):
        rows, cond = df, F.col(column) == steps[0][0]
        rows = rows.withColumns({"__c0": F.col(column), "__t0": F.col(ts)})
        for i, (value, _) in enumerate(steps[1:], start=1):
            rows = neighbour(rows, keys, ts, tie, {f"__c{i - 1}": f"__c{i}", f"__t{i - 1}": f"__t{i}"}, 1, **options)
            cond = cond & (F.col(f"__c{i}") == value)
        return rows.filter(cond).select(*keys, F.col(ts).alias("match_start"), F.col(tie).alias("first_row"), F.col(f"__t{len(steps) - 1}").alias("match_end"))

    if any(a[0] == b[0] for a, b in zip(steps, steps[1:])):
        raise ValueError("neighbouring steps of a pattern with + must differ")
    rows = neighbour(df, keys, ts, tie, {column: "__before"}, -1, "__has", **options)
    begins = ~F.col("__has") | ~F.col(column).eqNullSafe(F.col("__before"))
    # Rows are numbered, run starts are numbered rows; a run ends one before the next one starts.
    rows = numbered(rows.withColumn("__begins", begins), keys, ts, tie, "__n", **options)
    last = rows.groupBy(*keys).agg(F.max("__n").alias("__last"), F.max(ts).alias("__last_ts"))
    runs = rows.filter("__begins").select(*keys, ts, tie, column, "__n")
    runs = neighbour(runs, keys, ts, tie, {"__n": "__next_n"}, 1, **options).join(last, keys)
    runs = runs.withColumn("__size", F.coalesce(F.col("__next_n"), F.col("__last") + 1) - F.col("__n"))
    runs = runs.withColumns({"__c0": F.col(column), "__s0": F.col("__size"), "__n0": F.col("__n")})
    cond = F.col(column) == steps[0][0]
    for i, (value, many) in enumerate(steps[1:], start=1):
        runs = neighbour(
            runs, keys, ts, tie, {f"__c{i - 1}": f"__c{i}", f"__s{i - 1}": f"__s{i}", f"__n{i - 1}": f"__n{i}"}, 1, **options
        )
        cond = cond & (F.col(f"__c{i}") == value)
        if i < len(steps) - 1 and not many:
            cond = cond & (F.col(f"__s{i}") == 1)
    end = len(steps) - 1
    first_row = F.col("__n0") if steps[0][1] else F.col("__n0") + F.col("__s0") - 1
    last_row = F.col(f"__n{end}") + F.col(f"__s{end}") - 1 if steps[end][1] else F.col(f"__n{end}")
    return runs.filter(cond).select(*keys, first_row.alias("first_row"), last_row.alias("last_row"))


def recursive_expand(seed: DataFrame, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """UNION ALL recursion from (root, node): (root, node, depth, paths).

    The bag is kept as a count of paths, so a node reached many ways is one row per depth. Without
    ``max_depth`` the edges must be free of cycles, as for any such recursion: a path of more steps than
    there are nodes with a successor has met one, and raises.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "expand")
    step = scratch.write(edges.select(F.col("src").alias("node"), F.col("dst").alias("next")), "edges")
    start = seed.groupBy("root", "node").agg(F.count(F.lit(1)).alias("paths"))
    level, depth = scratch.write(start.withColumn("depth", F.lit(0)), "level/0"), 0
    names = [f"{scratch.path}/level/0"]
    longest = step.select("node").distinct().count() if max_depth is None else max_depth
    while max_depth is None or depth < max_depth:
        depth += 1
        if depth > longest + 1:
            raise ValueError("the edges have a cycle; give max_depth")
        grown = small_or_spread(level).join(small_or_spread(step), "node").groupBy("root", F.col("next").alias("node")).agg(F.sum("paths").alias("paths"))
        level = scratch.write(grown.withColumn("depth", F.lit(depth)), f"level/{depth}")
        if level.isEmpty():
            break
        names.append(f"{scratch.path}/level/{depth}")
    return spark.read.schema(level.schema).parquet(*names)


def profile(df: DataFrame, columns: list[str] | None = None, exact: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, least, greatest, mean; one pass.

    ``exact`` counts distinct values exactly, which makes Spark shuffle the distinct (column, value)
    pairs; otherwise a sketch merges map-side.
    """
    names = columns or df.columns
    kinds = dict(df.dtypes)
    counter = F.count_distinct if exact else F.approx_count_distinct
    numeric = {n for n in names if kinds[n].startswith(("int", "bigint", "smallint", "tinyint", "double", "float", "decimal"))}
    parts = [
        F.struct(
            F.lit(n).alias("column_name"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(n).isNull()).alias("nulls"),
            counter(F.col(n)).alias("distinct_values"),
            F.min(n).cast("string").alias("least"),
            F.max(n).cast("string").alias("greatest"),
            (F.avg(n).cast("double") if n in numeric else F.lit(None).cast("double")).alias("mean"),
        )
        for n in names
    ]
    return df.agg(F.array(*parts).alias("p")).select(F.inline("p"))


#: Values of a column that a stored profile keeps track of as frequent ones.
TRACKED = 100


def _is_number(kind: str) -> bool:
    return kind.startswith(("int", "bigint", "smallint", "tinyint", "double", "float", "decimal"))


def profile_parts(df: DataFrame, part: str, columns: list[str]) -> DataFrame:
    """What is to be stored of each part of a table, so that its profile can be made again when parts come or change.

    One row for each value of ``part``: counts, extremes, sums, and mergeable sketches of distinct values, quantiles and
    frequent values. A part that changed is profiled again alone.
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c, kind in ((c, dict(df.dtypes)[c]) for c in columns):
        col = F.col(f"`{c}`")
        counted = col if kind in ("int", "bigint", "string", "binary") else col.cast("string")
        aggs += [
            F.count_if(col.isNull()).alias(f"{c}__nulls"), F.min(col).alias(f"{c}__least"), F.max(col).alias(f"{c}__greatest"),
            F.hll_sketch_agg(counted, F.lit(14)).alias(f"{c}__distinct"), F.expr(f"approx_top_k_accumulate(cast(`{c}` as string), {TRACKED})").alias(f"{c}__frequent"),
        ]
        if _is_number(kind):
            aggs += [F.sum(col.cast("double")).alias(f"{c}__total"), F.kll_sketch_agg_double(col.cast("double")).alias(f"{c}__quantiles")]
    return df.groupBy(F.col(part).alias("part")).agg(*aggs)


def profile_of_parts(parts: DataFrame, columns: list[str], quantiles: tuple[float, ...] = (0.25, 0.5, 0.75), frequent: int = 5) -> DataFrame:
    """The profile of a table from the stored rows of its parts alone: one row for each column.

    Rows, nulls, extremes and means are exact; distinct_values, quantiles and frequent (value and count) are as near as their
    sketches. Columns of other types than numbers have no mean and quantiles.
    """
    names = set(parts.columns)
    merged = [F.sum("__rows").alias("__rows")]
    for c in columns:
        merged += [
            F.sum(f"{c}__nulls").alias(f"{c}__nulls"), F.min(f"{c}__least").alias(f"{c}__least"), F.max(f"{c}__greatest").alias(f"{c}__greatest"),
            F.hll_union_agg(f"{c}__distinct").alias(f"{c}__distinct"), F.expr(f"approx_top_k_combine(`{c}__frequent`, {TRACKED})").alias(f"{c}__frequent"),
        ]
        if f"{c}__total" in names:
            merged += [F.sum(f"{c}__total").alias(f"{c}__total"), F.kll_merge_agg_double(f"{c}__quantiles").alias(f"{c}__quantiles")]
    rows = []
    for c in columns:
        held = F.col("__rows") - F.col(f"{c}__nulls")
        number = f"{c}__total" in names
        mean = F.when(held > 0, F.col(f"{c}__total") / held) if number else F.lit(None).cast("double")
        cuts = F.kll_sketch_get_quantile_double(f"{c}__quantiles", F.array(*[F.lit(float(q)) for q in quantiles])) if number else F.lit(None).cast("array<double>")
        top = F.expr(f"approx_top_k_estimate(`{c}__frequent`, {frequent})")
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"), F.col("__rows").alias("rows"), F.col(f"{c}__nulls").alias("nulls"), F.hll_sketch_estimate(f"{c}__distinct").alias("distinct_values"),
                F.col(f"{c}__least").cast("string").alias("least"), F.col(f"{c}__greatest").cast("string").alias("greatest"), mean.alias("mean"),
                F.when(held > 0, cuts).alias("quantiles"), F.transform(top, lambda x: F.struct(x["item"].alias("value"), x["count"].alias("n"))).alias("frequent"),
            )
        )
    return parts.agg(*merged).select(F.inline(F.array(*rows)))


def split_tested(df: DataFrame, checks: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(passed, failed); a failed row lists its failed checks. An unknown outcome is a failure."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(c), F.lit(False)), F.lit(n)) for n, c in checks.items()]))
    marked = df.withColumn("failed_checks", failed)
    return marked.filter(F.size("failed_checks") == 0).drop("failed_checks"), marked.filter(F.size("failed_checks") > 0)
