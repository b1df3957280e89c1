"""The recipe formula language (F1-F12) as functions on ``Column``.

Expressions are built from Python calls, not parsed from text: an unknown
column name fails at analysis time instead of silently yielding null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .blank import coalesce_false, col, is_blank, is_not_blank, lit, to_number

__all__ = [
    "add", "sub", "mul", "div", "concat", "if_", "to_string", "to_number", "length",
    "trim", "upper", "lower", "date_part", "is_blank", "is_not_blank", "coalesce",
    "and_", "or_", "not_", "bin_by_edges",
]


# F1 arithmetic; division by zero gives null rather than an error.
def add(a, b) -> Column:
    return lit(a) + lit(b)


def sub(a, b) -> Column:
    return lit(a) - lit(b)


def mul(a, b) -> Column:
    return lit(a) * lit(b)


def div(a, b) -> Column:
    return F.try_divide(lit(a), lit(b))


# F2 string '+': null in, null out.
def concat(*parts) -> Column:
    return F.concat(*[lit(p).cast("string") for p in parts])


# F3 if(c, a, b): an unknown condition takes the else branch.
def if_(cond: Column, then, otherwise=None) -> Column:
    return F.when(coalesce_false(cond), lit(then)).otherwise(lit(otherwise))


# F4
def to_string(c) -> Column:
    return col(c).cast("string")


# F6, F7
def length(c) -> Column:
    return F.length(col(c))


def trim(c) -> Column:
    return F.trim(col(c))


def upper(c) -> Column:
    return F.upper(col(c))


def lower(c) -> Column:
    return F.lower(col(c))


# F8 datePart. dayOfWeek runs 1=Monday .. 7=Sunday.
_PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
    "dayofweek": lambda c: F.weekday(c) + F.lit(1),
}


def date_part(d, part: str) -> Column:
    try:
        fn = _PARTS[part.lower()]
    except KeyError:
        raise ValueError(f"unknown date part {part!r}; use one of {sorted(_PARTS)}") from None
    return fn(col(d))


# F10
def coalesce(*cols) -> Column:
    return F.coalesce(*[lit(c) for c in cols])


# F11 boolean operators (parenthesised by construction).
def and_(*conds: Column) -> Column:
    return reduce(lambda a, b: a & b, conds)


def or_(*conds: Column) -> Column:
    return reduce(lambda a, b: a | b, conds)


def not_(cond: Column) -> Column:
    return ~cond


# F12 numeric binning by nested if: value < edges[i] -> labels[i], else the last label.
def bin_by_edges(c, edges, labels, null_label=None) -> Column:
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one more label than edges")
    x = col(c)
    expr = F.when(x.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        expr = expr.when(x < F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))
