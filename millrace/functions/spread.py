"""Joins of frames that grow with the catalogue.

Spark guesses how large a frame is from its compressed files and does not count the rows that ``explode`` makes, so it may take
millions of rows for a few megabytes and send them whole through the driver to every executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df``, joined by a shuffle whatever its guessed size."""
    return df.hint("merge")


#: Rows of a written table that are still sent to every executor.
SMALL = 100_000


def small_or_spread(df: DataFrame) -> DataFrame:
    """A written table, measured by its number of rows: its files are far smaller than what they hold."""
    return df if df.count() <= SMALL else spread(df)
