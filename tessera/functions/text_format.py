"""Spreadsheet format codes compiled to one Column (FX12).

A code has up to four sections, divided by ``;``: numbers above zero, below
zero, zero, and text; with fewer, the first one also serves for what is missing,
with a minus sign before negative numbers. The first two may begin with a
condition such as ``[>=100]``. In a section:

* ``0 # ?`` are digits (kept as zero, left out, or a space where there is none),
  ``.`` the decimal point, ``,`` between digits groups thousands and after the
  last digit divides by 1000, ``%`` multiplies by 100, ``E+00`` / ``E-00`` is
  the exponent;
* ``y m d h s``, ``AM/PM``, ``A/P``, ``s.00`` and elapsed ``[h] [m] [s]`` are date
  and time parts (``m`` is minutes after hours or before seconds);
* ``"text"``, ``\\x``, ``_x`` (a space) and other characters are literal, ``*x``
  (filling) and colours are left out, ``@`` is the text.

Numbers are rounded half away from zero on their decimal digits. Fractions
(``# ?/?``) are refused. Null gives null.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names that a code may hold in brackets and that change the display's colour only.
COLOURS = ("black", "blue", "cyan", "green", "magenta", "red", "white", "yellow")
#: Day 0 of date serials, and days from it to the Unix epoch.
SERIAL_EPOCH_DAYS = 25569

_TOKEN = re.compile(
    r"""(?P<quoted>"[^"]*")|\\(?P<escaped>.)|_(?P<space>.)|\*(?P<fill>.)|(?P<elapsed>\[(?:h+|m+|s+)\])|\[(?P<bracket>[^\]]*)\]
    |(?P<general>general)|(?P<ampm>am/pm|a/p)|(?P<exponent>e[+-](?=[0#?]))|(?P<second>ss?\.0+|ss?)|(?P<date>y+|m+|d+|h+)
    |(?P<digit>[0\#?])|(?P<point>\.)|(?P<comma>,)|(?P<percent>%)|(?P<at>@)|(?P<slash>/)|(?P<other>.)""",
    re.I | re.S | re.X,
)


def sections(code: str) -> list[str]:
    """The parts of a code between semicolons that stand outside quotes and escapes."""
    return [m[0] for m in re.finditer(r'(?:"[^"]*"|\\.|[^;])+|(?<=;)(?=;|$)|^(?=;)', code, re.S)] or [""]


@dataclass
class Section:
    tokens: list[tuple[str, str]] = field(default_factory=list)
    condition: tuple[str, float] | None = None

    def has(self, *kinds: str) -> bool:
        return any(k in kinds for k, _ in self.tokens)


def parse(text: str) -> Section:
    out = Section()
    for m in _TOKEN.finditer(text):
        kind, value = m.lastgroup, m[m.lastgroup]
        if kind == "bracket":
            rule = re.fullmatch(r"(<=|>=|<>|<|>|=)\s*(-?\d+(?:\.\d+)?)", value)
            if rule:
                out.condition = (rule[1], float(rule[2]))
            elif value[:1] == "$":  # a currency sign, with a locale after the hyphen
                out.tokens.append(("literal", value[1:].split("-")[0]))
            elif value.lower() not in COLOURS and not re.fullmatch(r"color ?\d+", value, re.I):
                raise ValueError(f"unsupported [{value}] in a TEXT format code")
        elif kind == "quoted":
            out.tokens.append(("literal", value[1:-1]))
        elif kind in ("escaped", "other"):
            out.tokens.append(("literal", value))
        elif kind == "space":
            out.tokens.append(("literal", " "))
        elif kind != "fill":
            out.tokens.append((kind, value.lower() if kind != "ampm" else value))
    if out.has("date", "second", "elapsed", "ampm"):
        # in dates, what else would be number syntax is literal
        out.tokens = [(k if k in ("date", "second", "elapsed", "ampm") else "literal", v) for k, v in out.tokens]
        return out
    if out.has("digit"):
        at = [i for i, (k, _) in enumerate(out.tokens) if k == "digit"]
        if any(k == "slash" for k, _ in out.tokens[at[0] : at[-1]]) and not out.has("point") and any(v == "?" for k, v in out.tokens if k == "digit"):
            raise ValueError("fractions are not supported in a TEXT format code")
    out.tokens = [("literal", v) if k == "slash" else (k, v) for k, v in out.tokens]
    return out


def _grouped(digits: Column) -> Column:
    return F.regexp_replace(digits, r"(?<=\d)(?=(?:\d{3})+$)", ",")


def _fixed(x: Column, places: int) -> Column:
    """The decimal digits of ``x`` (not negative) with ``places`` after the point."""
    return F.format_string(f"%.{places}f", F.round(x, places))


def _integer_pieces(tokens: list[tuple[str, str]], digits: Column, grouped: bool) -> list[Column]:
    """The tokens before the point, with ``digits`` dealt to the placeholders from the right."""
    masks = [v for k, v in tokens if k == "digit"]
    if not masks:
        return [F.lit(v) for k, v in tokens if k == "literal"]
    shown = F.when(digits == "0", F.lit("")).otherwise(digits)  # a zero shows only where a placeholder asks for it
    first_zero = next((i for i, m in enumerate(masks) if m == "0"), len(masks))
    kept = len(masks) - first_zero
    full = F.when(F.length(shown) < kept, F.lpad(shown, kept, "0")).otherwise(shown) if kept else shown
    if "?" in masks:
        room = len(masks) - masks.index("?")
        full = F.when(F.length(full) < room, F.lpad(full, room, " ")).otherwise(full)
    inner = [i for i, (k, _) in enumerate(tokens) if k == "digit"]
    if all(k in ("digit", "comma") for k, _ in tokens[inner[0] : inner[-1]]):
        before = [F.lit(v) for k, v in tokens[: inner[0]] if k == "literal"]
        after = [F.lit(v) for k, v in tokens[inner[-1] + 1 :] if k == "literal"]
        return [*before, _grouped(full) if grouped else full, *after]
    # each run of placeholders between literals takes its places; the first one takes all that are left
    out, right, length = [], len(masks), F.length(full)
    for k, run in groupby(tokens, key=lambda t: t[0]):
        run = list(run)
        if k == "literal":
            out += [F.lit(v) for _, v in run]
        elif k == "digit":
            first = right == len(masks)
            right -= len(run)
            stop = length - right if right else length
            start = F.lit(1) if first else F.greatest(stop - (len(run) - 1), F.lit(1))
            out.append(F.substr(full, start, F.greatest(stop - start + 1, F.lit(0))))
    return out


def _fraction_pieces(tokens: list[tuple[str, str]], digits: Column) -> list[Column]:
    """The tokens after the point: zeros at the end go where no placeholder keeps them."""
    masks = [v for k, v in tokens if k == "digit"]
    kept = max((i + 1 for i, m in enumerate(masks) if m == "0"), default=0)
    tail = F.rtrim(F.substr(digits, F.lit(kept + 1), F.lit(max(len(masks) - kept, 1))), F.lit("0")) if kept < len(masks) else F.lit("")
    shown = F.concat(F.substr(digits, F.lit(1), F.lit(kept)) if kept else F.lit(""), tail)
    out, at = [], 0
    for k, v in tokens:
        if k == "literal":
            out.append(F.lit(v))
        elif k == "digit":
            at += 1
            place = F.substr(shown, F.lit(at), F.lit(1))
            out.append(F.when(F.length(shown) >= at, place).otherwise(F.lit(" " if v == "?" else "")))
    return out


def number_column(section: Section, x: Column) -> Column:
    """The text of ``x``, a double that is not negative."""
    tokens = section.tokens
    if section.has("general"):
        plain = F.when(x == F.floor(x), F.format_string("%.0f", x)).otherwise(x.cast("string"))
        return F.concat(F.lit(""), *[plain if k == "general" else F.lit(v) for k, v in tokens if k in ("general", "literal")])
    percents = sum(k == "percent" for k, _ in tokens)
    tokens = [("literal", v) if k == "percent" else (k, v) for k, v in tokens]
    cut = next((i for i, (k, _) in enumerate(tokens) if k == "exponent"), None)
    body, tail = (tokens, []) if cut is None else (tokens[:cut], tokens[cut:])
    places = [i for i, (k, _) in enumerate(body) if k in ("digit", "point")]
    point = next((i for i, (k, _) in enumerate(body) if k == "point"), None)
    last = max(places, default=-1)
    thousands = sum(k == "comma" for k, _ in body[last + 1 :]) if places else 0
    whole_end = len(body) if point is None else point
    before = body[:whole_end]
    if point is None and places:
        before = [t for i, t in enumerate(before) if not (t[0] == "comma" and i > last)]
    at = [i for i, (k, _) in enumerate(before) if k == "digit"]
    if point is not None and at:  # commas right before the point divide, too
        thousands += sum(k == "comma" for k, _ in before[at[-1] + 1 :])
    grouped = bool(at) and any(k == "comma" for k, _ in before[at[0] : at[-1]])
    after = [] if point is None else [t for t in body[point + 1 :] if t[0] != "comma"]
    decimals = sum(k == "digit" for k, _ in after)
    if percents or thousands:  # to 15 digits, as spreadsheets count
        x = F.format_string("%.14e", x * F.lit(float(100**percents)) / F.lit(float(1000**thousands))).cast("double")

    exponent = None
    if cut is not None:
        size = max(sum(k == "digit" for k, _ in before), 1)
        scale = F.regexp_extract(F.format_string("%.15E", x), r"E([+-]\d+)$", 1).cast("int")
        power = (F.floor(scale / F.lit(size)) * size).cast("int")
        ten = lambda e: F.pow(F.lit(10.0), e)
        mantissa = F.round(x / ten(power), decimals)
        over = mantissa >= 10.0**size  # rounded up to one digit more
        power = F.when(over, power + size).otherwise(power)
        exponent = F.when(x == 0, F.lit(0)).otherwise(power)
        x = F.when(over, x / ten(power)).otherwise(F.when(x == 0, x).otherwise(mantissa))

    if not places:
        pieces = [F.lit(v) for k, v in body if k == "literal"]
    else:
        digits = _fixed(x, decimals)
        whole = F.substring_index(digits, ".", 1) if decimals else digits
        pieces = _integer_pieces(before, whole, grouped)
        if point is not None:
            pieces += [F.lit("."), *_fraction_pieces(after, F.substring_index(digits, ".", -1) if decimals else F.lit(""))]
    if exponent is not None:
        sign = F.when(exponent < 0, F.lit("-")).otherwise(F.lit("+" if tail[0][1].endswith("+") else ""))
        pieces += [F.lit("E"), sign, *_integer_pieces(tail[1:], F.abs(exponent).cast("string"), False)]
    return F.concat(F.lit(""), *pieces)


def date_column(section: Section, t: Column) -> Column:
    """The text of a date or timestamp."""
    tokens = section.tokens
    half = section.has("ampm")
    stamp = t.cast("timestamp_ntz")
    # seconds since day 0 of date serials, from the fields: no time zone
    seconds = (F.unix_date(F.to_date(stamp)).cast("long") + SERIAL_EPOCH_DAYS) * 86400 + F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.second(stamp)
    time_parts = [i for i, (k, _) in enumerate(tokens) if k in ("date", "second", "elapsed")]
    out = []
    for i, (kind, v) in enumerate(tokens):
        show = lambda pattern: F.date_format(stamp, pattern)
        near = time_parts.index(i) if i in time_parts else -1
        prior = tokens[time_parts[near - 1]] if near > 0 else ("", "")
        follow = tokens[time_parts[near + 1]] if 0 <= near < len(time_parts) - 1 else ("", "")
        if kind == "literal":
            out.append(F.lit(v))
        elif kind == "ampm":
            mark = F.when(F.hour(stamp) < 12, F.lit("AM")).otherwise(F.lit("PM"))
            out.append(mark if len(v) > 3 else F.substring(mark, 1, 1))
        elif kind == "elapsed":
            unit = {"h": 3600, "m": 60, "s": 1}[v[1]]
            out.append(F.lpad(F.floor(seconds / unit).cast("string"), len(v) - 2, "0") if len(v) > 3 else F.floor(seconds / unit).cast("string"))
        elif kind == "second":
            whole, _, parts = v.partition(".")
            micros = F.date_format(stamp, "SSSSSS")
            out.append(show("ss" if len(whole) > 1 else "s"))
            if parts:
                out += [F.lit("."), F.substring(F.rpad(micros, len(parts), "0"), 1, len(parts))]
        elif v[0] == "y":
            out.append(show("yy" if len(v) <= 2 else "yyyy"))
        elif v[0] == "d":
            out.append(show({1: "d", 2: "dd", 3: "EEE"}.get(len(v), "EEEE")))
        elif v[0] == "h":
            hour = (F.hour(stamp) + 11) % 12 + 1 if half else F.hour(stamp)
            out.append(F.lpad(hour.cast("string"), 2, "0") if len(v) > 1 else hour.cast("string"))
        elif len(v) <= 2 and (prior[1][:1] == "h" or prior[1][:2] == "[h" or follow[0] == "second" or follow[1][:2] == "[s"):
            out.append(show("mm" if len(v) > 1 else "m"))
        elif len(v) == 5:
            out.append(F.substring(show("MMM"), 1, 1))
        else:
            out.append(show({1: "M", 2: "MM", 3: "MMM"}.get(len(v), "MMMM")))
    return F.concat(F.lit(""), *out)


def text_column(section: Section, s: Column) -> Column:
    if not section.has("at"):
        return F.concat(F.lit(""), *[F.lit(v) for k, v in section.tokens if k == "literal"]) if section.tokens else F.lit("")
    return F.concat(F.lit(""), *[s if k == "at" else F.lit(v) for k, v in section.tokens if k in ("at", "literal")])


def is_date(code: str) -> bool:
    return parse(sections(code)[0]).has("date", "second", "elapsed", "ampm")


def compile_text(code: str, v: Column, serial: bool = False) -> Column:
    """The text of ``v`` under ``code``.

    Date codes take dates and timestamps, or day serials with ``serial``.
    Number codes take numbers; a code with ``@`` takes text, of which what
    reads as a number goes to the number sections.
    """
    parts = [parse(s) for s in sections(code)]
    if len(parts) > 4:
        raise ValueError(f"more than four sections in the TEXT format code {code!r}")
    if parts[0].has("date", "second", "elapsed", "ampm"):
        if serial:
            days = v.cast("double")
            v = F.timestamp_micros(F.round((days - SERIAL_EPOCH_DAYS) * 86_400_000_000).cast("long")).cast("timestamp_ntz")
        return F.when(v.isNotNull(), date_column(parts[0], v))
    words = next((p for p in parts if p.has("at")), parts[3] if len(parts) == 4 else None)
    numbers = [p for p in parts if p is not words]
    x = v.try_cast("double") if words is not None else v.cast("double")

    def shown(p: Section, signed: bool) -> Column:
        text = number_column(p, F.abs(x))
        return F.when(x < 0, F.concat(F.lit("-"), text)).otherwise(text) if signed else text

    result = None
    if numbers:
        compare = {"<": x.__lt__, "<=": x.__le__, ">": x.__gt__, ">=": x.__ge__, "=": x.__eq__, "<>": x.__ne__}
        if any(p.condition for p in numbers):
            # sections with a condition come first, in order; the last one is for the rest
            result = shown(numbers[-1], True) if not numbers[-1].condition else F.lit("#" * 5)
            for p in reversed([p for p in numbers if p.condition]):
                op, limit = p.condition
                result = F.when(compare[op](F.lit(limit)), shown(p, not (op in ("<", "<=") and limit <= 0))).otherwise(result)
        elif len(numbers) == 1:
            result = shown(numbers[0], True)
        else:
            zero = shown(numbers[2], False) if len(numbers) > 2 else shown(numbers[0], False)
            result = F.when(x > 0, shown(numbers[0], False)).when(x < 0, shown(numbers[1], False)).otherwise(zero)
    if words is None:
        return F.when(v.isNotNull(), result)
    text = text_column(words, v.cast("string"))
    return F.when(v.isNotNull(), F.when(x.isNull(), text).otherwise(result) if result is not None else text)
