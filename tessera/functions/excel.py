"""Spreadsheet functions (FX1-FX22) with spreadsheet semantics, on ``Column``.

Each function keeps the spreadsheet's behaviour where it differs from the
Spark built-in of the same name (TRIM collapses inner spaces, INT floors,
MOD takes the divisor's sign, WEEKDAY has three numberings, errors are null).
Kept apart from ``formula.py`` so that one name never means two things.
"""

from __future__ import annotations

import datetime as _dt
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .blank import balanced_sum, blank_to_null, coalesce_false, col, lit, to_number
from .text_format import compile_text


def _num(v) -> Column:
    """Numeric argument: a column name, a Column or a number."""
    if isinstance(v, Column):
        return v
    return F.col(v) if isinstance(v, str) else F.lit(v)


def _quote_regex(s: str) -> str:
    return "\\Q" + s + "\\E"


# FX1 ----------------------------------------------------------------------
def IF(cond: Column, then, otherwise=None) -> Column:
    return F.when(coalesce_false(cond), lit(then)).otherwise(lit(otherwise))


def IFS(*pairs) -> Column:
    """IFS(c1, v1, c2, v2, ...): first true condition wins, else null (#N/A)."""
    if len(pairs) % 2:
        raise ValueError("IFS takes condition/value pairs")
    expr = None
    for cond, val in zip(pairs[::2], pairs[1::2]):
        expr = (F.when if expr is None else expr.when)(coalesce_false(cond), lit(val))
    return expr


def SWITCH(expr, *cases, default=None) -> Column:
    """SWITCH(x, v1, r1, v2, r2, ..., default=)."""
    if len(cases) % 2:
        raise ValueError("SWITCH takes value/result pairs")
    x = col(expr)
    out = None
    for val, res in zip(cases[::2], cases[1::2]):
        out = (F.when if out is None else out.when)(x == lit(val), lit(res))
    return out.otherwise(lit(default))


# FX2: errors are nulls here, so both wrappers are a coalesce.
def IFERROR(value, alt) -> Column:
    return F.coalesce(lit(value), lit(alt))


IFNA = IFERROR


# FX3
def AND(*conds) -> Column:
    return reduce(lambda a, b: a & b, conds)


def OR(*conds) -> Column:
    return reduce(lambda a, b: a | b, conds)


def NOT(cond) -> Column:
    return ~cond


# FX4-FX10 dates -------------------------------------------------------------
def DATE(y, m, d) -> Column:
    """Month and day overflow roll over, as in the spreadsheet (DATE(2024,14,1) = 2025-02-01)."""
    start = F.make_date(_num(y), F.lit(1), F.lit(1))
    return F.date_add(F.add_months(start, _num(m) - F.lit(1)), _num(d) - F.lit(1))


def EDATE(d, months) -> Column:
    return F.add_months(col(d), _num(months))


def EOMONTH(d, months) -> Column:
    return F.last_day(F.add_months(col(d), _num(months)))


def YEAR(d) -> Column:
    return F.year(col(d))


def MONTH(d) -> Column:
    return F.month(col(d))


def DAY(d) -> Column:
    return F.dayofmonth(col(d))


def HOUR(d) -> Column:
    return F.hour(col(d))


def MINUTE(d) -> Column:
    return F.minute(col(d))


def SECOND(d) -> Column:
    return F.second(col(d))


def TODAY(as_of: _dt.date | None = None) -> Column:
    """Pass ``as_of`` for repeatable results; otherwise the query start date."""
    return F.lit(as_of) if as_of is not None else F.current_date()


def NOW(as_of: _dt.datetime | None = None) -> Column:
    return F.lit(as_of) if as_of is not None else F.current_timestamp()


def WEEKDAY(d, return_type: int = 1) -> Column:
    """1: Sunday=1..Saturday=7; 2: Monday=1..Sunday=7; 3: Monday=0..Sunday=6."""
    d = col(d)
    if return_type == 1:
        return F.dayofweek(d)
    if return_type == 2:
        return F.weekday(d) + F.lit(1)
    if return_type == 3:
        return F.weekday(d)
    raise ValueError("WEEKDAY return_type must be 1, 2 or 3")


def _whole_months(start: Column, end: Column) -> Column:
    months = (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))
    return months - F.when(F.dayofmonth(end) < F.dayofmonth(start), 1).otherwise(0)


def DATEDIF(start, end, unit: str) -> Column:
    """Whole years ("Y"), months ("M") or days ("D"); null when start > end."""
    s, e = F.to_date(col(start)), F.to_date(col(end))
    unit = unit.upper()
    if unit == "D":
        val = F.datediff(e, s)
    elif unit == "M":
        val = _whole_months(s, e)
    elif unit == "Y":
        val = F.floor(_whole_months(s, e) / F.lit(12)).cast("int")
    else:
        raise ValueError("DATEDIF unit must be Y, M or D")
    return F.when(s <= e, val)


def DATEVALUE(text, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(col(text), fmt)


def _weekdays_before(d: Column) -> Column:
    """Number of Monday-Friday days in [1970-01-05, d) (negative before it)."""
    n = F.unix_date(d) - F.lit(4)  # 1970-01-05 was a Monday
    weeks = F.floor(n / F.lit(7))
    rest = n - weeks * F.lit(7)
    return weeks * F.lit(5) + F.least(rest, F.lit(5))


def NETWORKDAYS(start, end, holidays=()) -> Column:
    """Working days between two dates, both ends included, minus listed holidays.

    Closed form on week numbers (no row generation). Reversed ends give a
    negative count, as in the spreadsheet. ``holidays`` is a literal list.
    """
    s, e = F.to_date(col(start)), F.to_date(col(end))
    lo, hi = F.least(s, e), F.greatest(s, e)
    days = _weekdays_before(F.date_add(hi, 1)) - _weekdays_before(lo)
    # only holidays on Monday-Friday can reduce the count; their weekday is known here
    hol = sorted(h for h in set(holidays) if h.weekday() < 5)
    if not hol:
        pass
    elif len(hol) <= 64:
        # a (balanced) sum of CASE terms stays inside whole-stage codegen (longer lists
        # would outgrow the generated-method size limit)
        days = days - balanced_sum([F.when((F.lit(h) >= lo) & (F.lit(h) <= hi), 1).otherwise(0) for h in hol])
    else:
        arr = F.array(*[F.lit(h) for h in hol])
        days = days - F.size(F.filter(arr, lambda h: (h >= lo) & (h <= hi)))
    return F.when(s <= e, days).otherwise(-days)


# FX12 TEXT -----------------------------------------------------------------
def TEXT(value, code: str, serial: bool = False) -> Column:
    """A number, date or text under a spreadsheet format code (see ``text_format``).

    ``serial``: a date code is applied to day serials instead of dates.
    """
    return compile_text(code, col(value), serial)


# FX13-FX19 text ------------------------------------------------------------
def LEFT(text, n=1) -> Column:
    return F.left(col(text), _num(n))


def RIGHT(text, n=1) -> Column:
    return F.right(col(text), _num(n))


def MID(text, start, n) -> Column:
    return F.substr(col(text), _num(start), _num(n))


def LEN(text) -> Column:
    return F.length(col(text))


def CONCAT(*parts) -> Column:
    """Blank cells count as empty text. Strings name columns; wrap text in ``F.lit``."""
    return F.concat(*[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts])


CONCATENATE = CONCAT


def TEXTJOIN(sep: str, ignore_empty: bool, *parts) -> Column:
    if ignore_empty:
        cols = [blank_to_null(col(p).cast("string")) for p in parts]
    else:
        cols = [F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]
    return F.concat_ws(sep, *cols)


def TRIM(text) -> Column:
    """Strip both ends and collapse inner runs of spaces to one."""
    return F.regexp_replace(F.trim(col(text)), " +", " ")


def UPPER(text) -> Column:
    return F.upper(col(text))


def LOWER(text) -> Column:
    return F.lower(col(text))


def PROPER(text) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest."""
    runs = F.regexp_extract_all(col(text), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    cased = F.transform(runs, lambda t: F.concat(F.upper(F.substr(t, F.lit(1), F.lit(1))), F.lower(F.substr(t, F.lit(2)))))
    return F.when(col(text).isNotNull(), F.array_join(cased, ""))


def SUBSTITUTE(text, old: str, new: str, instance: int | None = None) -> Column:
    """Replace every occurrence, or only the ``instance``-th one."""
    t = col(text)
    if instance is None:
        return F.replace(t, F.lit(old), F.lit(new))
    if instance < 1:
        raise ValueError("instance starts at 1")
    parts = F.split(t, _quote_regex(old), -1)
    head = F.array_join(F.slice(parts, 1, instance), old)
    tail = F.array_join(F.slice(parts, F.lit(instance + 1), F.size(parts)), old)
    return F.when(F.size(parts) > instance, F.concat(head, F.lit(new), tail)).otherwise(t)


def REPLACE(text, start, n, new) -> Column:
    return F.overlay(col(text), lit(new), _num(start), _num(n))


def FIND(find, within, start=1) -> Column:
    """1-based position, case-sensitive; null when absent (#VALUE!)."""
    pos = F.position(lit(find), col(within), _num(start))
    return F.when(pos > 0, pos)


def _wildcard_regex(find: str) -> str:
    """Spreadsheet wildcards to a regex: ? one character, * any run, ~ escapes ? * ~."""
    out, i = [], 0
    while i < len(find):
        ch = find[i]
        if ch == "~" and i + 1 < len(find) and find[i + 1] in "?*~":
            out.append(re.escape(find[i + 1]))
            i += 2
            continue
        out.append("." if ch == "?" else ".*" if ch == "*" else re.escape(ch))
        i += 1
    return "(?s)" + "".join(out)


def SEARCH(find, within, start=1) -> Column:
    """As FIND, ignoring case; a literal find text may use the ? * ~ wildcards."""
    if isinstance(find, str):
        st = _num(start)
        tail = F.substr(F.lower(col(within)), st)
        pos = F.regexp_instr(tail, F.lit(_wildcard_regex(find.lower())), F.lit(0))
        return F.when(pos > 0, pos + st - F.lit(1))
    pos = F.position(F.lower(lit(find)), F.lower(col(within)), _num(start))
    return F.when(pos > 0, pos)


def VALUE(text) -> Column:
    return to_number(text)


# FX20-FX22 math ------------------------------------------------------------
def ROUND(x, digits: int = 0) -> Column:
    """Half away from zero."""
    return F.round(col(x), digits)


def _scaled(x: Column, digits: int) -> Column:
    # round to 9 places first so 0.29*100 = 28.999999999999996 counts as 29
    return F.round(F.abs(x) * F.lit(10.0 ** digits), 9)


def ROUNDUP(x, digits: int = 0) -> Column:
    x = col(x).cast("double")
    return F.signum(x) * F.ceil(_scaled(x, digits)) / F.lit(10.0 ** digits)


def ROUNDDOWN(x, digits: int = 0) -> Column:
    x = col(x).cast("double")
    return F.signum(x) * F.floor(_scaled(x, digits)) / F.lit(10.0 ** digits)


def INT(x) -> Column:
    """Rounds down (INT(-1.5) = -2), unlike a cast."""
    return F.floor(col(x))


def ABS(x) -> Column:
    return F.abs(col(x))


def MOD(x, y) -> Column:
    """Result takes the divisor's sign; null for a zero divisor."""
    x, y = _num(x).cast("double"), _num(y).cast("double")
    return F.when(y != 0, x - y * F.floor(x / y))


def POWER(x, y) -> Column:
    return F.pow(_num(x), _num(y))


def SQRT(x) -> Column:
    x = col(x)
    return F.when(x >= 0, F.sqrt(x))


def LN(x) -> Column:
    x = col(x)
    return F.when(x > 0, F.ln(x))


def LOG(x, base: float = 10.0) -> Column:
    x = col(x)
    return F.when(x > 0, F.log(float(base), x))


def EXP(x) -> Column:
    return F.exp(col(x))


def RAND(seed: int | None = None) -> Column:
    return F.rand(seed)


def RANDBETWEEN(lo, hi, seed: int | None = None) -> Column:
    lo_c, hi_c = _num(lo), _num(hi)
    return (F.floor(F.rand(seed) * (hi_c - lo_c + F.lit(1))) + lo_c).cast("bigint")
