"""Window filters and first / latest per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from millrace.functions.ordered import Frame, framed


def qualify(df: DataFrame, window: dict[str, str | Frame], predicate: str, **options: int) -> DataFrame:
    """QUALIFY: keep the rows whose window results meet the predicate.

    ``window`` maps a name to a window expression, or to a ``Frame``, whose plan splits keys that are too large for one task
    (``options`` go to ``ordered.framed``).
    """
    frames = {n: w for n, w in window.items() if isinstance(w, Frame)}
    out = framed(df, frames, **options) if frames else df
    out = out.withColumns({n: F.expr(w) for n, w in window.items() if n not in frames}).filter(predicate)
    return out.drop(*window)


def latest_per_key(df: DataFrame, keys: list[str], ts: str, tie: str | None = None) -> DataFrame:
    """The newest row of every key; among equal times the lowest ``tie`` (first seen), null before all others.

    An aggregate, not a window: every task keeps one row per key before anything is shuffled.
    """
    return _pick(df, keys, ts, tie, newest=True)


def first_per_key(df: DataFrame, keys: list[str], order: str, tie: str | None = None) -> DataFrame:
    """The first row of every key by ``order``, then ``tie``."""
    return _pick(df, keys, order, tie, newest=False)


def _pick(df: DataFrame, keys: list[str], order: str, tie: str | None, newest: bool) -> DataFrame:
    # Comparing inside a struct keeps rows whose order is null: they come last for ``newest``.
    row = F.struct(*[F.col(c) for c in df.columns])
    if not newest:
        best = F.min_by(row, F.struct(*dict.fromkeys([order, tie] if tie else [order])))
    elif tie is None:
        best = F.max_by(row, F.struct(order))
    else:
        falling = _falling(df, tie)
        if falling is None:
            per_time = df.groupBy(*keys, order).agg(F.min_by(row, F.struct(tie)).alias("r"))
            return per_time.groupBy(*keys).agg(F.max_by("r", F.struct(order)).alias("r")).select("r.*")
        # a null tie is the lowest, as in the other ways
        best = F.max_by(row, F.struct(F.col(order).alias("o"), F.col(tie).isNull().alias("n"), falling.alias("t")))
    return df.groupBy(*keys).agg(best.alias("r")).select("r.*")


def _falling(df: DataFrame, name: str) -> Column | None:
    """A number that falls as the column rises, so that "newest, then lowest" is one maximum."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.bitwise_not(F.col(name))
    return -F.col(name) if isinstance(kind, T.NumericType) else None


def first_and_last(df: DataFrame, keys: list[str], order: str, tie: str, value: str) -> DataFrame:
    """FIRST_VALUE and LAST_VALUE over the whole key, per key."""
    along = F.struct(order, tie)
    return df.groupBy(*keys).agg(
        F.min_by(value, along).alias("first_value"), F.max_by(value, along).alias("last_value")
    )
