"""Ordered computations inside a key that stay parallel when one key holds most of the rows.

A plain window sorts a whole key in one task. Where the largest key is small that is the best
plan and is used. Where it is not, the rows of the large keys are split into ordered buckets: cut
points are rows of a sample, compared as what they are (order column, then tie column, in the column's own type), every
(key, bucket) is its own window group, and each bucket gets ghost rows that carry what the neighbouring buckets
contribute: a count or sum of everything before, or the nearest row on the other side. The result is exact in both
ways, for any type that can be sorted.

The number of buckets follows from the measured rows, so that a bucket holds about ``BUCKET_ROWS``. Rows that agree in order
and tie have no order among themselves; a hash of the row stands in for one, so that they can be cut too. Keys below the
limit keep one bucket. The split rows are written to the shared scratch folder once, so that what they were computed
from does not run again for the ghosts.

Measuring is one count per key over the input. A caller that orders the same keys again passes what ``hot_keys`` found
as ``hot``, and nothing is measured twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql import types as T

from millrace.sources.scratch import Scratch

HOT_ROWS = 2_000_000  # the largest key a single task is asked to sort
BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 8
SAMPLED = 50  # sample rows for each cut
SALTS = 32


class Hot:
    """What was measured: the keys with too many rows (None if there are none) and how many rows they hold together."""

    def __init__(self, keys: DataFrame | None, rows: int):
        self.keys, self.rows = keys, rows


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> Hot:
    """Keys with more rows than one task should sort. Measured, not guessed: one pre-aggregated count per key, two
    numbers to the driver."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    large = counts.filter(F.col("__n") > hot_rows)
    found = large.agg(F.count(F.lit(1)), F.sum("__n")).first()
    return Hot(large.drop("__n"), found[1]) if found[0] else Hot(None, 0)


def _sortable(df: DataFrame, name: str) -> Column:
    """The column in a type whose literals keep every digit: times as microseconds."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{name}`)")
    if isinstance(kind, T.DateType):
        return F.unix_date(name)
    if not isinstance(kind, (T.NumericType, T.StringType, T.BooleanType, T.BinaryType)):
        raise TypeError(f"order column {name} must be a number, text, flag, date or time, not {kind.simpleString()}")
    return F.col(name)


def _check(df: DataFrame, order: str, tie: str | None) -> None:
    """The same types are taken whether or not a key is large."""
    for name in [order, tie] if tie else [order]:
        _sortable(df, name)


def _place(df: DataFrame, hot: Column, buckets: int, rows: int) -> Column:
    """The number of cut rows at or below this row's ``__at``, found by halving."""
    share = min(1.0, SAMPLED * buckets / max(rows, 1))
    sample = df.filter(hot).select("__at").sample(share, seed=7).orderBy("__at").collect()
    points = [sample[i * len(sample) // buckets][0] for i in range(1, buckets)] if sample else []
    kinds = df.schema["__at"].dataType.fields
    cuts = F.array(*[F.struct(*[F.lit(v).cast(k.dataType).alias(k.name) for v, k in zip(p, kinds, strict=True)]) for p in points])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, len(points).bit_length())))])
    if not points:
        return F.lit(0)
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(cuts, low + step - 1) <= F.col("__at"), low + step).otherwise(low))


def bucketed(df: DataFrame, keys: list[str], hot: Hot, order: str, tie: str | None) -> DataFrame:
    """Add ``__bucket``, whose order agrees with (order, tie, ``__same``); keys that are not hot have bucket 0.

    ``__same`` orders rows that agree in order and tie.
    """
    marks = hot.keys.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.lit(True).alias("__hot"))
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    tagged = df.join(marks, on, "left") if keys else df.withColumn("__hot", F.lit(True))
    tagged = tagged.drop(*[f"__k{i}" for i in range(len(keys))])
    plain = [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    tagged = tagged.withColumn("__same", F.xxhash64(*plain))
    at = F.struct(*[_sortable(df, n).alias(f"c{i}") for i, n in enumerate([order, tie] if tie else [order])], "__same")
    tagged = Scratch(df.sparkSession, "split").write(tagged.withColumn("__at", at), "rows")
    is_hot = F.coalesce("__hot", F.lit(False))
    buckets = max(LEAST_BUCKETS, -(-hot.rows // BUCKET_ROWS))
    placed = F.when(is_hot, _place(tagged, is_hot, buckets, hot.rows)).otherwise(F.lit(0))
    return tagged.withColumn("__bucket", placed).drop("__hot", "__at")


def _order(order: str, tie: str | None, descending: bool, same: bool = False) -> list[Column]:
    names = [order] + ([tie] if tie else []) + (["__same"] if same else [])
    return [F.desc(n) if descending else F.asc(n) for n in names]


def running_total(
    df: DataFrame,
    keys: list[str],
    order: str,
    tie: str | None,
    value: Column,
    name: str,
    descending: bool = False,
    hot_rows: int = HOT_ROWS,
    hot: Hot | None = None,
) -> DataFrame:
    """Sum of ``value`` over the rows of the key up to and including this one."""
    frame = (Window.unboundedPreceding, Window.currentRow)
    _check(df, order, tie)
    hot = hot or hot_keys(df, keys, hot_rows)
    if hot.keys is None:
        w = Window.partitionBy(*keys).orderBy(*_order(order, tie, descending)).rowsBetween(*frame)
        return df.withColumn(name, F.sum(value).over(w))
    rows = bucketed(df, keys, hot, order, tie).withColumn("__v", value).withColumn("__ghost", F.lit(False))
    direction = F.desc("__bucket") if descending else F.asc("__bucket")
    before = Window.partitionBy(*keys).orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    ghosts = (
        rows.groupBy(*keys, "__bucket")
        .agg(F.sum("__v").alias("__v"))
        .withColumn("__v", F.sum("__v").over(before))
        .filter(F.col("__v").isNotNull())
        .withColumn("__ghost", F.lit(True))
    )
    w = Window.partitionBy(*keys, "__bucket").orderBy(F.desc("__ghost"), *_order(order, tie, descending, True)).rowsBetween(*frame)
    return (
        rows.unionByName(ghosts, allowMissingColumns=True)
        .withColumn(name, F.sum("__v").over(w))
        .filter(~F.col("__ghost"))
        .drop("__v", "__ghost", "__bucket", "__same")
    )


def numbered(
    df: DataFrame,
    keys: list[str],
    order: str,
    tie: str | None,
    name: str = "row_number",
    descending: bool = False,
    hot_rows: int = HOT_ROWS,
    hot: Hot | None = None,
) -> DataFrame:
    """Row number inside the key."""
    out = running_total(df, keys, order, tie, F.lit(1).cast("long"), name, descending, hot_rows, hot)
    return out.withColumn(name, F.col(name).cast("long"))


def ranked(
    df: DataFrame,
    keys: list[str],
    order: str,
    descending: bool = False,
    rank: str = "rank",
    dense: str = "dense_rank",
    hot_rows: int = HOT_ROWS,
    hot: Hot | None = None,
) -> DataFrame:
    """RANK and DENSE_RANK: numbered over the distinct values, then joined back to the rows."""
    _check(df, order, None)
    if (hot or hot_keys(df, keys, hot_rows)).keys is None:
        w = Window.partitionBy(*keys).orderBy(*_order(order, None, descending))
        return df.withColumn(rank, F.rank().over(w).cast("long")).withColumn(dense, F.dense_rank().over(w).cast("long"))
    values = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("__n"))
    few = hot_keys(values, keys, hot_rows)
    values = numbered(values, keys, order, None, dense, descending, hot_rows, few)
    values = running_total(values, keys, order, None, F.col("__n"), "__upto", descending, hot_rows, few)
    values = values.withColumn(rank, F.col("__upto") - F.col("__n") + 1).drop("__upto", "__n")
    right = values.select(*[F.col(c).alias(f"__{c}") for c in [*keys, order]], rank, dense)
    on = [df[c].eqNullSafe(right[f"__{c}"]) for c in [*keys, order]]
    return df.join(right, on, "inner").drop(*[f"__{c}" for c in [*keys, order]])


def neighbour(
    df: DataFrame,
    keys: list[str],
    order: str,
    tie: str | None,
    columns: dict[str, str],
    step: int = -1,
    present: str | None = None,
    hot_rows: int = HOT_ROWS,
    hot: Hot | None = None,
) -> DataFrame:
    """The row before (``step=-1``) or after (``step=1``): LAG and LEAD by one.

    ``columns`` maps source column to output name; ``present`` names a flag that is false on the
    first (last) row of the key.
    """
    picked = F.struct(*[F.col(c).alias(c) for c in columns])
    _check(df, order, tie)
    hot = hot or hot_keys(df, keys, hot_rows)
    if hot.keys is None:
        w = Window.partitionBy(*keys).orderBy(*_order(order, tie, False))
        rows = df.withColumn("__near", (F.lag if step < 0 else F.lead)(picked).over(w))
        return _unpack(rows, columns, present)

    rows = bucketed(df, keys, hot, order, tie).withColumn("__ghost", F.lit(0)).withColumn("__row", picked)
    along = F.struct(*[F.col(c) for c in ([order, tie] if tie else [order])], "__same")
    edge = F.max_by("__row", along) if step < 0 else F.min_by("__row", along)
    next_bucket = (F.lead if step < 0 else F.lag)("__bucket").over(Window.partitionBy(*keys).orderBy("__bucket"))
    ghosts = (
        rows.groupBy(*keys, "__bucket")
        .agg(edge.alias("__row"))
        .withColumn("__bucket", next_bucket)
        .filter(F.col("__bucket").isNotNull())
        .withColumn("__ghost", F.lit(step))
    )
    w = Window.partitionBy(*keys, "__bucket").orderBy(F.asc("__ghost"), *_order(order, tie, False, True))
    out = (
        rows.unionByName(ghosts, allowMissingColumns=True)
        .withColumn("__near", (F.lag if step < 0 else F.lead)("__row").over(w))
        .filter(F.col("__ghost") == 0)
        .drop("__ghost", "__row", "__bucket", "__same")
    )
    return _unpack(out, columns, present)


def _unpack(rows: DataFrame, columns: dict[str, str], present: str | None) -> DataFrame:
    if present:
        rows = rows.withColumn(present, F.col("__near").isNotNull())
    return rows.withColumns({out: F.col(f"__near.{c}") for c, out in columns.items()}).drop("__near")


# ---- frames ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Frame:
    """A window function over ROWS BETWEEN ``preceding`` AND ``following``; None stands for UNBOUNDED.

    ``function`` is sum, count, min, max, avg (a double), first or last; ``count`` without a column counts rows.
    """

    function: str
    column: str | None
    keys: tuple[str, ...]
    order: str
    tie: str | None = None
    preceding: int | None = None
    following: int | None = 0
    descending: bool = False

    def __post_init__(self):
        if self.function not in _PARTS:
            raise ValueError(f"no such function: {self.function}")
        if min(self.preceding or 0, self.following or 0) < 0:
            raise ValueError("a frame holds the current row")

    @property
    def group(self) -> tuple:
        return self.keys, self.order, self.tie, self.descending


#: What each function is put together from.
_PARTS = {"sum": ("sum",), "count": ("count",), "min": ("min",), "max": ("max",), "avg": ("sum", "count"), "first": ("first",), "last": ("last",)}


def _part(part: str, value: Column) -> Column:
    if part == "first":
        return F.first(value, ignorenulls=True)
    return F.last(value, ignorenulls=True) if part == "last" else {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[part](value)


def _value(frame: Frame, part: str, counted: Column | None = None) -> Column:
    """What a part aggregates: null where a row does not count. First and last keep nulls, so they take a row of one."""
    value = F.lit(1) if frame.column is None else F.col(frame.column)
    value = F.struct(value.alias("v")) if part in ("first", "last") else value
    return value if counted is None else F.when(counted, value)


def _joined(part: str, before: Column | None, inside: Column, after: Column | None) -> Column:
    """The part over what lies before, inside and after."""
    parts = [x for x in (before, inside, after) if x is not None]
    if len(parts) == 1:
        return inside
    if part in ("first", "last"):
        return F.coalesce(*(parts if part == "first" else reversed(parts)))
    if part in ("min", "max"):
        return (F.least if part == "min" else F.greatest)(*parts)
    total = parts[0]
    for x in parts[1:]:
        total = F.coalesce(total + x, total, x)
    return total


def _over(frame: Frame, part: str, value: Column, ahead: WindowSpec, back: WindowSpec) -> Column:
    """The part over the frame's rows. ``back`` orders as ``ahead`` does, from the other end: what runs from near a row to the end is
    made again for every row in Spark's frames, but going back it is one running aggregate."""
    if frame.following is None and frame.preceding is not None:
        turned = {"first": "last", "last": "first"}.get(part, part)
        return _part(turned, value).over(back.rowsBetween(Window.unboundedPreceding, frame.preceding))
    ends = Window.unboundedPreceding if frame.preceding is None else -frame.preceding, Window.unboundedFollowing if frame.following is None else frame.following
    return _part(part, value).over(ahead.rowsBetween(*ends))


def _made(frame: Frame, parts: dict[str, Column]) -> Column:
    if frame.function == "avg":
        return parts["sum"].cast("double") / parts["count"]
    only = parts[frame.function]
    return only["v"] if frame.function in ("first", "last") else only


def framed(df: DataFrame, frames: dict[str, Frame], hot_rows: int = HOT_ROWS, block_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` with a column for each frame, in plans that no single key can hold up.

    Keys of up to ``hot_rows`` rows are plain windows. The rows of larger ones are numbered and cut into blocks of ``block_rows``
    consecutive rows; a block also gets the rows of its neighbours that its frames reach. What an unbounded side takes from farther
    blocks is one aggregate for each block, summed along the blocks. Frames of one partitioning and order share all that.
    """
    for frame in dict.fromkeys(f.group for f in frames.values()):
        df = _framed(df, {n: f for n, f in frames.items() if f.group == frame}, hot_rows, block_rows)
    return df


def _framed(df: DataFrame, frames: dict[str, Frame], hot_rows: int, block_rows: int) -> DataFrame:
    keys, order, tie, descending = next(iter(frames.values())).group
    keys = list(keys)
    _check(df, order, tie)
    hot = hot_keys(df, keys, hot_rows)

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*_order(order, tie, descending))
        back = Window.partitionBy(*keys).orderBy(F.desc("__at"))
        turned = any(f.following is None and f.preceding is not None for f in frames.values())
        rows = rows.withColumn("__at", F.row_number().over(w)) if turned else rows  # so that both ways agree on equal rows
        w = Window.partitionBy(*keys).orderBy("__at") if turned else w
        made = {name: _made(f, {p: _over(f, p, _value(f, p), w, back) for p in _PARTS[f.function]}) for name, f in frames.items()}
        return rows.withColumns(made).drop("__at")

    if hot.keys is None:
        return plain(df)
    marks = hot.keys.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)] or F.lit(True)
    cold = df.join(marks, on, "left_anti") if keys else df.limit(0)
    large = df.join(marks, on, "left_semi") if keys else df
    return plain(cold).unionByName(_in_blocks(large, frames, hot, block_rows))


def _in_blocks(df: DataFrame, frames: dict[str, Frame], hot: Hot, block_rows: int) -> DataFrame:
    keys, order, tie, descending = next(iter(frames.values())).group
    keys = list(keys)
    before, after = max(f.preceding or 0 for f in frames.values()), max(f.following or 0 for f in frames.values())
    size = max(block_rows, before, after, 1)
    scratch = Scratch(df.sparkSession, "frames")
    rows = scratch.write(numbered(df, keys, order, tie, "__at", descending, hot=hot).withColumn("__at", F.col("__at") - 1), "rows")
    block, place = F.floor(F.col("__at") / size), F.col("__at") % size
    rows = rows.withColumn("__block", block)
    blocks = F.array_compact(F.array(block, F.when(place >= size - before, block + 1), F.when(place < after, block - 1)))
    placed = rows.withColumn("__for", F.explode(blocks)).withColumn("__own", F.col("__for") == F.col("__block"))

    w, back = (Window.partitionBy(*keys, "__for").orderBy(at) for at in ("__at", F.desc("__at")))
    far = {}  # aggregates of whole blocks, for unbounded sides
    inside, parts = {}, {}
    for n, (name, f) in enumerate(frames.items()):
        parts[name] = {}
        for p in _PARTS[f.function]:
            column = f"__f{n}_{p}"
            # rows of the block before belong to what lies before, if that side is unbounded, and likewise behind
            counted = None
            if f.preceding is None:
                counted = F.col("__block") >= F.col("__for")
            if f.following is None:
                counted = (F.col("__block") <= F.col("__for")) & (F.lit(True) if counted is None else counted)
            inside[column] = _over(f, p, _value(f, p, counted), w, back)
            sides = [None, None]
            for side, open_ in enumerate((f.preceding is None, f.following is None)):
                if open_:
                    sides[side] = f"{column}_{side}"
                    far[sides[side]] = (f, p, side)
            parts[name][p] = (column, *sides)
    out = placed.withColumns(inside).where("__own")
    if far:
        along = {"first": lambda v: F.min_by(v, "__at"), "last": lambda v: F.max_by(v, "__at")}
        sums = rows.groupBy(*keys, "__block").agg(*[along.get(p, lambda v, p=p: _part(p, v))(_value(f, p)).alias(c) for c, (f, p, _) in far.items()])
        line = Window.partitionBy(*keys).orderBy("__block")
        ends = [(Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)]
        more = lambda c, p: F.sum(c) if p == "count" else _part(p, F.col(c))
        sums = scratch.write(sums.withColumns({c: more(c, p).over(line.rowsBetween(*ends[side])) for c, (_, p, side) in far.items()}), "blocks")
        right = sums.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__block").alias("__b"), *far)
        on = (F.col("__block") == F.col("__b"))
        for i, k in enumerate(keys):
            on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        out = out.join(right, on)
    made = {}
    for name, f in frames.items():
        whole = {p: _joined(p, F.col(b) if b else None, F.col(c), F.col(a) if a else None) for p, (c, b, a) in parts[name].items()}
        made[name] = _made(f, whole)
    return out.withColumns(made).select(*df.columns, *frames)


def top_per_key(df: DataFrame, keys: list[str], ordering: list[Column], k: int, name: str | None = None) -> DataFrame:
    """The first ``k`` rows of every key, chosen in two steps: inside salts, then among winners.

    The second step sees at most ``k`` rows per salt, whatever the key holds.
    """
    salted = df.withColumn("__salt", F.monotonically_increasing_id() % SALTS)
    inner = Window.partitionBy(*keys, "__salt").orderBy(*ordering)
    outer = Window.partitionBy(*keys).orderBy(*ordering)
    out = (
        salted.withColumn("__rn", F.row_number().over(inner))
        .filter(F.col("__rn") <= k)
        .withColumn("__rn", F.row_number().over(outer))
        .filter(F.col("__rn") <= k)
    )
    out = out.withColumn(name, F.col("__rn").cast("long")) if name else out
    return out.drop("__rn", "__salt")
