"""Expressions other warehouses spell differently, as Column functions.

Everything else in the expression surface (CAST, NVL, COALESCE, NULLIF, CASE, TO_CHAR, TO_DATE,
REPLACE, UPPER, SUBSTR, MD5, SHA2, ROUND, DATEDIFF, DATE_TRUNC, ADD_MONTHS, SPLIT, INITCAP ...)
is already a Spark function of the same name and is used through ``selectExpr``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def iff(condition: Column, yes: Column, no: Column) -> Column:
    return F.when(condition, yes).otherwise(no)


def decode(value: Column, *cases: Column) -> Column:
    """DECODE(v, a, x, b, y [, default]); null matches null."""
    pairs, default = list(cases), F.lit(None)
    if len(pairs) % 2:
        default = pairs.pop()
    chain = None
    for key, result in zip(pairs[::2], pairs[1::2]):
        hit = value.eqNullSafe(key)
        chain = F.when(hit, result) if chain is None else chain.when(hit, result)
    return chain.otherwise(default)


def to_decimal(value: Column, precision: int = 38, scale: int = 0) -> Column:
    return value.try_cast(f"decimal({precision},{scale})")


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def trunc_number(value: Column, digits: int = 0) -> Column:
    """Cut towards zero after ``digits`` decimals."""
    factor = F.lit(10.0**digits)
    scaled = value * factor
    return F.when(scaled < 0, F.ceil(scaled)).otherwise(F.floor(scaled)) / factor


def dateadd(unit: str, amount: Column, value: Column) -> Column:
    return F.timestamp_add(unit, amount, value)


def regexp_substr(value: Column, pattern: str) -> Column:
    """First match, or null when there is none."""
    return F.regexp_substr(value, F.lit(pattern))


# Type text to Spark type, for conforming and casting. Fixed values.
SPARK_TYPES = {
    "NUMBER": "decimal(38,0)",
    "FLOAT": "double",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "STRING": "string",
    "TEXT": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP_NTZ": "timestamp_ntz",
    "VARIANT": "variant",
}


def spark_type(text: str) -> str:
    """``NUMBER(38,4)`` -> ``decimal(38,4)``; unknown text is taken as a Spark type already."""
    head, _, args = text.strip().upper().partition("(")
    if head == "NUMBER" and args:
        return "decimal(" + args
    return SPARK_TYPES.get(head, text.strip().lower())
