"""Global places of the rows of a table, by ranges instead of one window over everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.sources.scratch import Scratch

#: ``monotonically_increasing_id`` counts the rows of a partition in its low 33 bits.
ROW_BITS = 33


def placed(df: DataFrame, order: list[Column], place: str, scratch: Scratch, name: str = "places") -> DataFrame:
    """``df`` with the place of every row, from 0, in the given order.

    Rows are dealt to ranges of the order, sorted in each and written; a range's first place is the sum of the rows of
    those before it. Only this sum is made in one task, over one row for each range. ``order`` has to tell rows
    apart if their places are to be the same in every run; a range takes all rows that are equal in it.
    """
    row, part = f"{place}_row", f"{place}_part"
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    found = scratch.write(dealt.withColumn(row, F.monotonically_increasing_id()), name)
    found = found.withColumn(part, F.shiftright(row, ROW_BITS))
    sizes = found.groupBy(part).count()
    before = F.coalesce(F.sum("count").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = scratch.write(sizes.select(part, before.alias(f"{place}_before")), f"{name}-starts")
    inside = F.col(row).bitwiseAND((1 << ROW_BITS) - 1)
    return found.join(starts, part).withColumn(place, F.col(f"{place}_before") + inside).select(*df.columns, place)
