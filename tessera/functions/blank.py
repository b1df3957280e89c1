"""Null, blank and lenient-cast helpers shared by every module.

Spark 4 runs with ANSI mode on: a failing ``cast`` raises. The formula
languages this library serves turn bad values into nulls instead, so every
lenient conversion goes through ``try_cast`` / ``try_to_*`` here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    """Accept a column name or a Column."""
    return c if isinstance(c, Column) else F.col(c)


def lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def is_blank(c) -> Column:
    """True for null or the empty string (isBlank); never null itself."""
    c = col(c)
    return c.isNull() | (c.cast("string") == F.lit(""))


def is_not_blank(c) -> Column:
    return ~is_blank(c)


def blank_to_null(c) -> Column:
    """'' becomes null, other values stay."""
    c = col(c)
    return F.when(c.cast("string") == F.lit(""), F.lit(None)).otherwise(c)


def try_cast(c, data_type: str) -> Column:
    """Lenient cast: null when the value does not convert."""
    return col(c).try_cast(data_type)


def to_number(c) -> Column:
    """Text to double, ignoring surrounding spaces; null when not numeric."""
    return F.trim(col(c).cast("string")).try_cast("double")


def safe_divide(a, b) -> Column:
    """Division that yields null for a zero or null divisor."""
    return F.try_divide(lit(a), lit(b))


def coalesce_false(cond: Column) -> Column:
    """Treat an unknown (null) condition as false."""
    return F.coalesce(cond, F.lit(False))


def balanced_sum(cols: list[Column]) -> Column:
    """Sum of many columns as a balanced tree (depth log2 n), so long lists
    stay within the analyzer's iteration and code-size limits."""
    if not cols:
        return F.lit(0)
    while len(cols) > 1:
        cols = [cols[i] + cols[i + 1] if i + 1 < len(cols) else cols[i] for i in range(0, len(cols), 2)]
    return cols[0]
