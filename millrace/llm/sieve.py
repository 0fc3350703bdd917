"""Which rows may have one of many ids, told without a shuffle of the rows.

A join with ids that are too many to broadcast shuffles every text, also of the rows that match nothing. A sieve is ``BITS`` bits, one of
them set for each id by a hash, so its size is fixed whatever the number of ids. Rows whose bit is not set have none of the ids and
need not take part in the join; the join still decides about the others, so results are exact. With n ids about n / BITS of the other rows
take part too.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: A power of two; 8 MB.
BITS = 1 << 26


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(BITS))


def sieve(ids: DataFrame, id_col: str) -> Callable[[str], Column]:
    """A function that makes of a column's name whether its value may be in ``ids``; false only where it is not."""
    words = ids.select(_place(F.col(id_col)).alias("place")).groupBy(F.shiftright("place", 6).alias("word"))
    found = words.agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits")).toArrow()
    table = np.zeros(BITS // 64, np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    held = ids.sparkSession.sparkContext.broadcast(table)

    def run(places: pa.Array) -> pa.Array:
        at = places.to_numpy(zero_copy_only=False)
        return pa.array((held.value[at >> 6] >> (at & 63)) & 1 == 1)

    test = F.arrow_udf(run, "boolean")
    return lambda column: test(_place(F.col(column)))
