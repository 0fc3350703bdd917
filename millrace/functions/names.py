"""How names, types and identifiers are compared."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trim(c: Column | str) -> Column:
    """Take off blanks, tabs and line ends on both sides."""
    return F.btrim(_col(c), F.lit(" \t\r\n\f"))


def norm(c: Column | str) -> Column:
    """Match key of a column, type or object name: trimmed and upper-cased."""
    return F.upper(trim(c))


def norm_identifier(c: Column | str) -> Column:
    """As ``norm``, after taking off one pair of identifier quotes."""
    trimmed = trim(c)
    quoted = trimmed.rlike(r'^".*"$|^`.*`$|^\[.*\]$')
    return F.upper(F.when(quoted, F.substring(trimmed, F.lit(2), F.length(trimmed) - 2)).otherwise(trimmed))


def base_type(c: Column | str) -> Column:
    """``pkg:::id`` and a bare ``id`` name the same node type."""
    c = _col(c)
    return F.when(F.contains(c, F.lit(":::")), F.split(c, ":::")[1]).otherwise(c)


def package_of(c: Column | str) -> Column:
    """The part before ``:::``; null for a built-in type."""
    c = _col(c)
    at = F.instr(c, ":::")
    return F.when(at > 1, F.substring(c, F.lit(1), at - 1))


def squeeze(c: Column | str) -> Column:
    """Whitespace runs become one blank."""
    return trim(F.regexp_replace(_col(c), r"\s+", " "))


def norm_expression(c: Column | str) -> Column:
    """Collapse whitespace, then drop it next to punctuation."""
    return F.regexp_replace(F.regexp_replace(trim(c), r"\s+", " "), r"\s*([^\w\s])\s*", "$1")


def non_blank(c: Column | str) -> Column:
    """True only for text with a visible character; false for null."""
    return F.coalesce(F.length(trim(c)) > 0, F.lit(False))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
