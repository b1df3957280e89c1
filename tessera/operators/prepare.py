"""Row and column processors.

Every function is ``DataFrame -> DataFrame`` (or returns a tuple of frames for
multi-output tools) and adds only narrow projections and filters, so a chain
of them collapses into one whole-stage-codegen stage and filters reach the
Parquet scan. Two read a bounded amount of data to the driver:
``dynamic_rename`` from a table (at most one row per existing column) and
``find_replace`` in substring mode (its rules, up to ``rule_match.MAX_CHARS``
characters; beyond, an exact substring join needs the rules' distinct lengths only).
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blank import balanced_sum, blank_to_null, coalesce_false, is_blank, lit
from .rule_match import with_first_rule

UNKNOWN = "*Unknown"


def _cols(columns) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _quote(sep: str) -> str:
    return "\\Q" + sep + "\\E"


# P1 ------------------------------------------------------------------------
def with_formula(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Computed column; replaces a column of the same name."""
    return df.withColumn(name, expr)


def with_formulas(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Several computed columns in one projection (later ones cannot see earlier)."""
    return df.withColumns(exprs)


# P2 ------------------------------------------------------------------------
def multi_field(df: DataFrame, columns, fn: Callable[[Column], Column], suffix: str | None = None) -> DataFrame:
    """Apply one expression to each listed column; ``fn`` receives the current field."""
    cols = _cols(columns)
    return df.withColumns({(c + suffix if suffix else c): fn(F.col(c)) for c in cols})


# P3, P5, P6 -----------------------------------------------------------------
def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"cannot rename missing columns {missing}")
    return df.withColumnsRenamed(mapping)


def keep_columns(df: DataFrame, columns) -> DataFrame:
    return df.select(*_cols(columns))


def drop_columns(df: DataFrame, columns) -> DataFrame:
    return df.drop(*_cols(columns))


# P4 ------------------------------------------------------------------------
def change_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Lenient type change: values that do not convert become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


# P7 ------------------------------------------------------------------------
def select_fields(df: DataFrame, fields: list[dict]) -> DataFrame:
    """Select tool: per field ``{field, selected, rename, type}``.

    A field named ``*Unknown`` stands for every column not listed; its
    ``selected`` flag decides whether those columns are kept (at its position).
    """
    listed = {f["field"] for f in fields if f["field"] != UNKNOWN}
    out: list[Column] = []
    for f in fields:
        name = f["field"]
        if name == UNKNOWN:
            if f.get("selected", True):
                out.extend(F.col(c) for c in df.columns if c not in listed)
            continue
        if not f.get("selected", True):
            continue
        c = F.col(name)
        if f.get("type"):
            c = c.try_cast(f["type"])
        out.append(c.alias(f.get("rename") or name))
    if not any(f["field"] == UNKNOWN for f in fields):
        out.extend(F.col(c) for c in df.columns if c not in listed)
    return df.select(*out)


# P8, P9, P17 ---------------------------------------------------------------
def filter_on_value(df: DataFrame, column: str, values: Iterable, action: str = "KEEP") -> DataFrame:
    """KEEP rows whose value is listed; REMOVE them (rows with null are kept by REMOVE)."""
    hit = F.col(column).isin([v for v in values if v is not None])
    if action.upper() == "KEEP":
        return df.filter(hit)
    # hit is unknown exactly when the value is null: both parts push down to Parquet
    return df.filter(~hit | F.col(column).isNull())


def filter_formula(df: DataFrame, cond: Column, action: str = "KEEP") -> DataFrame:
    """KEEP rows where the condition is true; REMOVE them (unknown counts as false)."""
    # written so Catalyst can push both forms to the Parquet scan:
    # KEEP drops unknown rows by itself; REMOVE keeps them explicitly
    return df.filter(cond if action.upper() == "KEEP" else (~cond | cond.isNull()))


# Operators of the simple filter mode.
SIMPLE_OPERATORS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "IsNull": lambda c, v: c.isNull(),
    "IsNotNull": lambda c, v: c.isNotNull(),
    "IsEmpty": lambda c, v: is_blank(c),
    "IsNotEmpty": lambda c, v: ~is_blank(c),
    "Contains": lambda c, v: c.contains(v),
    "StartsWith": lambda c, v: c.startswith(v),
    "EndsWith": lambda c, v: c.endswith(v),
}


def simple_condition(field: str, operator: str, operand=None) -> Column:
    return SIMPLE_OPERATORS[operator](F.col(field), F.lit(operand))


def filter_split(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """Both outputs of a filter tool: (True, False). Null conditions go to False."""
    return df.filter(cond), df.filter(~cond | cond.isNull())


# P10, P11 ----------------------------------------------------------------------
def split_column(
    df: DataFrame,
    column: str,
    separator: str,
    out_columns: list[str] | None = None,
    prefix: str | None = None,
    limit: int | None = None,
    empty_as_null: bool = False,
) -> DataFrame:
    """Split on a literal separator into N columns; the last one keeps the rest.

    Names come from ``out_columns``, or are ``{prefix}_1 .. {prefix}_{limit}``.
    Missing parts are null.
    """
    if out_columns is None:
        if not prefix or not limit:
            raise ValueError("give out_columns, or prefix and limit")
        out_columns = [f"{prefix}_{i}" for i in range(1, limit + 1)]
    n = len(out_columns)
    parts = F.split(F.col(column), _quote(separator), n)
    exprs = {}
    for i, name in enumerate(out_columns, start=1):
        v = F.try_element_at(parts, F.lit(i))
        exprs[name] = blank_to_null(v) if empty_as_null else v
    return df.withColumns(exprs)


def split_to_rows(df: DataFrame, column: str, separator: str, out: str | None = None, pattern: bool = False) -> DataFrame:
    """One row per part; rows with a null value are kept with a null part."""
    sep = separator if pattern else _quote(separator)
    return df.withColumn(out or column, F.explode_outer(F.split(F.col(column), sep, -1)))


# P12-P16 ---------------------------------------------------------------------
def trim_columns(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in _cols(columns)})


def lowercase_columns(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.lower(F.col(c)) for c in _cols(columns)})


def uppercase_columns(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.upper(F.col(c)) for c in _cols(columns)})


def fill_empty(df: DataFrame, columns, value) -> DataFrame:
    """Replace null *or* empty string by ``value``."""
    return df.withColumns({c: F.when(is_blank(c), F.lit(value)).otherwise(F.col(c)) for c in _cols(columns)})


def fillna(df: DataFrame, value, subset=None) -> DataFrame:
    """pandas form: nulls only."""
    return df.fillna(value, subset=subset)


def drop_missing(df: DataFrame, how: str = "any", subset=None) -> DataFrame:
    return df.dropna(how=how, subset=subset)


def remove_bad_type(df: DataFrame, columns, data_type: str, mode: str = "OR") -> DataFrame:
    """Remove rows whose value does not convert to ``data_type``.

    Blank cells are not bad. ``mode='OR'`` removes a row when any listed
    column is bad, ``'AND'`` only when all are.
    """
    bad = [~is_blank(c) & F.trim(F.col(c).cast("string")).try_cast(data_type).isNull() for c in _cols(columns)]
    op = (lambda a, b: a | b) if mode.upper() == "OR" else (lambda a, b: a & b)
    return df.filter(~reduce(op, bad))


# P18-P20 ---------------------------------------------------------------------
def replace_values(df: DataFrame, column: str, mapping: dict, out: str | None = None, keep_unmatched: bool = True) -> DataFrame:
    """Exact dictionary replacement (pandas replace, value formats, SWITCH); a value mapped to None becomes null."""
    known = [k for k in mapping if k is not None]
    hit = F.lit(None)
    if known:
        m = F.create_map(*[F.lit(x) for k in known for x in (k, mapping[k])])
        hit = F.try_element_at(m, F.col(column))
    val = hit
    if keep_unmatched:  # a value mapped to null is a hit, too
        val = F.when(F.col(column).isin(known), hit).otherwise(F.col(column)) if known else F.col(column)
    return df.withColumn(out or column, val)


def range_format(df: DataFrame, column: str, ranges: list[tuple], out: str, other=None) -> DataFrame:
    """Numeric intervals to labels: ``(lo, hi, label)`` means lo <= x < hi.

    ``lo`` or ``hi`` may be None for an open end; first matching range wins.
    A fourth element ``'both'`` makes the interval closed on the right too.
    """
    x = F.col(column)
    expr = None
    for r in ranges:
        lo, hi, label = r[0], r[1], r[2]
        closed = r[3] if len(r) > 3 else "left"
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (x >= F.lit(lo))
        if hi is not None:
            cond = cond & ((x <= F.lit(hi)) if closed == "both" else (x < F.lit(hi)))
        expr = (F.when if expr is None else expr.when)(x.isNotNull() & cond, F.lit(label))
    return df.withColumn(out, expr.otherwise(F.lit(other)))


def find_replace(
    df: DataFrame,
    column: str,
    rules: DataFrame,
    find_col: str,
    replace_col: str,
    order_col: str,
    mode: str = "whole",
    out: str | None = None,
    inline_max: int = 256,
) -> DataFrame:
    """Find/replace from a lookup table.

    ``whole``: a value equal to a rule's find text is replaced (first rule by
    ``order_col`` when several share a find text); an equi-join, any size.
    ``substring``: the first rule (by ``order_col``, then find text) whose find
    text occurs in the value replaces every occurrence of it. Up to
    ``inline_max`` rules are compiled into one expression (no shuffle); more
    become automata (``rule_match``), exact for any rule count. Both read the
    column as text, skip rules without a find text and take a null replacement
    as empty.
    """
    out = out or column
    rule = rules.select(
        F.col(find_col).cast("string").alias("__find"),
        F.coalesce(F.col(replace_col).cast("string"), F.lit("")).alias("__repl"),
        F.col(order_col).alias("__ord"),
    ).filter(F.col("__find").isNotNull() & (F.length("__find") > 0))
    if mode == "whole":
        best = rule.groupBy("__find").agg(F.min_by("__repl", F.struct("__ord", "__repl")).alias("__repl"))
        joined = df.join(best, F.col(column).cast("string") == F.col("__find"), "left")
        return joined.withColumn(out, F.coalesce(F.col("__repl"), F.col(column).cast("string"))).drop("__find", "__repl")
    if mode != "substring":
        raise ValueError("mode is 'whole' or 'substring'")
    small = rule.orderBy("__ord", "__find", "__repl").limit(inline_max + 1).collect()
    v = F.col(column).cast("string")
    if len(small) <= inline_max:
        expr = None
        for r in small:
            cond = F.instr(v, r["__find"]) > 0
            rep = F.replace(v, F.lit(r["__find"]), F.lit(r["__repl"]))
            expr = (F.when if expr is None else expr.when)(cond, rep)
        return df.withColumn(out, v if expr is None else expr.otherwise(v))
    res = with_first_rule(df, v, rule.select("__find", F.col("__repl").alias("__value"), F.col("__ord").alias("__order")))
    hit = F.col("__hit")
    return res.withColumn(out, F.when(hit.isNull(), v).otherwise(F.replace(v, hit["find"], hit["value"]))).drop("__hit")


# P21 ---------------------------------------------------------------------------
def regex_match(df: DataFrame, column: str, pattern: str, out: str) -> DataFrame:
    return df.withColumn(out, coalesce_false(F.col(column).rlike(pattern)))


def regex_extract(df: DataFrame, column: str, pattern: str, out_columns: list[str]) -> DataFrame:
    """Capture groups 1..n into columns; null when the pattern does not match."""
    c = F.col(column)
    matched = c.rlike(pattern)
    return df.withColumns({
        name: F.when(matched, F.regexp_extract(c, pattern, i)) for i, name in enumerate(out_columns, start=1)
    })


def regex_replace(df: DataFrame, column: str, pattern: str, replacement: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or column, F.regexp_replace(F.col(column), pattern, replacement))


def regex_tokenize(df: DataFrame, column: str, pattern: str, out: str) -> DataFrame:
    """One row per match of the pattern."""
    return df.withColumn(out, F.explode(F.regexp_extract_all(F.col(column), F.lit(pattern), 0)))


# P22, P23 ------------------------------------------------------------------------
def parse_date(df: DataFrame, column: str, fmt: str, out: str | None = None, as_date: bool = False) -> DataFrame:
    """Text to timestamp (or date) by a Java pattern; null when it does not fit."""
    if as_date:
        return df.withColumn(out or column, F.try_to_date(F.col(column), fmt))
    return df.withColumn(out or column, F.try_to_timestamp(F.col(column), F.lit(fmt)))


def format_date(df: DataFrame, column: str, fmt: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or column, F.date_format(F.col(column), fmt))


# P24 ---------------------------------------------------------------------------------
def cleanse(
    df: DataFrame,
    columns,
    null_text_to_blank: bool = True,
    null_numbers_to_zero: bool = True,
    trim: bool = True,
    collapse_whitespace: bool = False,
    remove_letters: bool = False,
    remove_digits: bool = False,
    remove_punctuation: bool = False,
    case: str | None = None,
) -> DataFrame:
    """Data-cleansing bundle over the listed columns, by column type."""
    types = dict(df.dtypes)
    exprs = {}
    for c in _cols(columns):
        x = F.col(c)
        if types[c] == "string":
            if null_text_to_blank:
                x = F.coalesce(x, F.lit(""))
            if remove_letters:
                x = F.regexp_replace(x, r"\p{L}", "")
            if remove_digits:
                x = F.regexp_replace(x, r"\p{Nd}", "")
            if remove_punctuation:
                x = F.regexp_replace(x, r"\p{P}", "")
            if collapse_whitespace:
                x = F.regexp_replace(x, r"\s+", " ")
            if trim:
                x = F.trim(x)
            if case == "upper":
                x = F.upper(x)
            elif case == "lower":
                x = F.lower(x)
            elif case == "title":
                x = F.initcap(x)
        elif null_numbers_to_zero and (types[c] in ("int", "bigint", "double", "float", "smallint", "tinyint") or types[c].startswith("decimal")):
            x = F.coalesce(x, F.lit(0).cast(types[c]))
        exprs[c] = x
    return df.withColumns(exprs)


# P25 ---------------------------------------------------------------------------------
def dynamic_rename(
    df: DataFrame,
    prefix: str = "",
    suffix: str = "",
    fn: Callable[[str], str] | None = None,
    names: DataFrame | None = None,
    from_col: str = "from",
    to_col: str = "to",
    columns=None,
) -> DataFrame:
    """Rename by prefix/suffix, by a Python function of the name, or from a table.

    With a table, the smallest new name given for a column is taken: one row
    for each column of ``df`` reaches the driver.
    """
    targets = _cols(columns) if columns is not None else df.columns
    mapping = {}
    if names is not None:
        named = names.filter(F.col(from_col).isin(targets) & F.col(to_col).isNotNull())
        rows = named.groupBy(from_col).agg(F.min(to_col)).collect()
        mapping = {r[0]: r[1] for r in rows}
    new = []
    for c in df.columns:
        n = c
        if c in targets:
            n = mapping.get(c, n)
            if fn is not None:
                n = fn(n)
            n = prefix + n + suffix
        new.append(n)
    return df.toDF(*new)


# P26 is ordered and lives in operators.window (record_id).


# P27 -----------------------------------------------------------------------------------
def unpivot(df: DataFrame, ids, columns, name_col: str = "Name", value_col: str = "Value", value_type: str | None = None) -> DataFrame:
    """Fold columns into name/value rows; other id columns stay; null values are kept.

    Values are cast to ``value_type`` (default: string when types differ).
    """
    cols = _cols(columns)
    types = {t for c, t in df.dtypes if c in cols}
    vt = value_type or (types.pop() if len(types) == 1 else "string")
    casted = df.select(*_cols(ids), *[F.col(c).cast(vt).alias(c) for c in cols])
    return casted.unpivot(_cols(ids), cols, name_col, value_col)


# P28, P29 ------------------------------------------------------------------------------
def where(df: DataFrame, column: str, cond: Column, other=None) -> DataFrame:
    """pandas ``where``: keep the value where cond is true, else ``other``."""
    return df.withColumn(column, F.when(coalesce_false(cond), F.col(column)).otherwise(lit(other)))


def mask(df: DataFrame, column: str, cond: Column, other=None) -> DataFrame:
    """pandas ``mask``: replace the value where cond is true."""
    return df.withColumn(column, F.when(coalesce_false(cond), lit(other)).otherwise(F.col(column)))


def if_then(df: DataFrame, out: str, branches: list[tuple[Column, object]], otherwise=None) -> DataFrame:
    """SAS ``if ... then ...; else if ...; else ...``."""
    expr = None
    for cond, val in branches:
        expr = (F.when if expr is None else expr.when)(coalesce_false(cond), lit(val))
    return df.withColumn(out, expr.otherwise(lit(otherwise)))


def with_label(df: DataFrame, column: str, label: str | None = None, fmt: str | None = None) -> DataFrame:
    """Attach SAS label / format as column metadata (no data change)."""
    meta = {}
    if label is not None:
        meta["label"] = label
    if fmt is not None:
        meta["format"] = fmt
    return df.withMetadata(column, meta)


# P30 --------------------------------------------------------------------------------------
def generate_rows(df: DataFrame, name: str, init, stop, step=1, inclusive: bool = True) -> DataFrame:
    """One row per value of ``init, init+step, ...`` while ``<= stop`` (``< stop`` if not inclusive).

    A negative step goes down, while ``>= stop`` (``> stop``). ``init``/``stop``
    may be columns (per-row ranges). Dates step by days. An empty range yields
    no rows for that input row.
    """
    a, b, s = lit(init), lit(stop), lit(step)
    down = isinstance(step, (int, float)) and step < 0
    there = (a >= b) if down else (a <= b)
    seq = F.when(there, F.sequence(a, b, s))
    if not inclusive:
        seq = F.filter(seq, lambda x: (x > b) if down else (x < b))
    return df.withColumn(name, F.explode(seq))


def generate_date_rows(df: DataFrame, name: str, start, stop, days: int = 1) -> DataFrame:
    a, b = lit(start), lit(stop)
    seq = F.when(a <= b, F.sequence(a, b, F.expr(f"INTERVAL {int(days)} DAY")))
    return df.withColumn(name, F.explode(seq))


# P31 -----------------------------------------------------------------------------------------
def row_reduce(df: DataFrame, columns, how: str, out: str) -> DataFrame:
    """Row-wise sum / min / max / mean / n over a column list, missing values ignored.

    All missing gives null (n gives 0).
    """
    cols = [F.col(c).cast("double") for c in _cols(columns)]
    # plain arithmetic (no higher-order functions) keeps this inside whole-stage codegen
    n = balanced_sum([F.when(c.isNotNull(), 1).otherwise(0) for c in cols])
    total = balanced_sum([F.coalesce(c, F.lit(0.0)) for c in cols])
    if how == "min":
        expr = F.least(*cols)
    elif how == "max":
        expr = F.greatest(*cols)
    elif how == "sum":
        expr = F.when(n > 0, total)
    elif how == "mean":
        expr = F.when(n > 0, total / n)
    elif how == "n":
        expr = n
    else:
        raise ValueError("how is sum, min, max, mean or n")
    return df.withColumn(out, expr)


def array_apply(df: DataFrame, columns, fn: Callable[[Column], Column], suffix: str = "") -> DataFrame:
    """DATA step ``array`` + ``do`` loop: the same statement for each element."""
    return multi_field(df, columns, fn, suffix or None)


# P32, P33 ---------------------------------------------------------------------------------------
def flatten_json(df: DataFrame, column: str, schema: str, out: str | None = None, explode: bool = False) -> DataFrame:
    """Parse JSON text with a schema; ``explode`` turns an array into rows."""
    parsed = F.from_json(F.col(column), schema)
    if explode:
        parsed = F.explode_outer(parsed)
    return df.withColumn(out or column, parsed)


def flatten_variant(df: DataFrame, column: str, path: str = "$", outer: bool = False, prefix: str = "") -> DataFrame:
    """One row per element of the JSON text at ``path``, without a schema: LATERAL FLATTEN.

    Adds ``pos`` (place), ``key`` (of an object's field; null in arrays),
    ``value`` (a VARIANT) and ``type`` (its schema as text), each behind
    ``prefix``. Text that is not JSON, a missing path and values without
    elements give no row, or with ``outer`` one row of nulls.
    """
    parsed = F.try_variant_get(F.try_parse_json(F.col(column)), path, "variant")
    tvf = df.sparkSession.tvf
    parts = (tvf.variant_explode_outer if outer else tvf.variant_explode)(parsed.outer())
    names = [f"{prefix}{c}" for c in ("pos", "key", "value")]
    return df.lateralJoin(parts.toDF(*names)).withColumn(f"{prefix}type", F.schema_of_variant(names[-1]))


def variant_field(column: str, path: str, kind: str = "string") -> Column:
    """The field at ``path`` of a VARIANT column, or of JSON text by ``F.parse_json``; null where it does not fit."""
    return F.try_variant_get(F.col(column), path, kind)


def make_struct(df: DataFrame, name: str, columns) -> DataFrame:
    return df.withColumn(name, F.struct(*_cols(columns)))


# P34 -----------------------------------------------------------------------------------------------
def _step(kind: str) -> Callable:
    return {
        "CreateColumnWithGREL": lambda df, p: with_formula(df, p["column"], p["expression"]),
        "FilterOnValue": lambda df, p: filter_on_value(df, p["column"], p["values"], p.get("action", "KEEP")),
        "FilterOnFormula": lambda df, p: filter_formula(df, p["formula"], p.get("action", "KEEP")),
        "FilterOnBadType": lambda df, p: remove_bad_type(df, p["columns"], p["type"], p.get("booleanMode", "OR")),
        "ColumnRenamer": lambda df, p: rename(df, {r["from"]: r["to"] for r in p["renamings"]}),
        "ColumnsSelector": lambda df, p: (keep_columns if p.get("keep", True) else drop_columns)(df, p["columns"]),
        "ColumnSplitter": lambda df, p: split_column(
            df, p.get("column") or p.get("inCol"), p["separator"], p.get("outColumns"),
            p.get("outColPrefix"), p.get("limit"), not p.get("keepEmptyColumns", True)),
        "ColumnTrimmer": lambda df, p: trim_columns(df, p["columns"]),
        "ColumnLowercaser": lambda df, p: lowercase_columns(df, p["columns"]),
        "FillEmptyWithValue": lambda df, p: fill_empty(df, p["columns"], p["value"]),
        "DateParser": lambda df, p: parse_date(df, p["column"], p["format"], p.get("outColumn")),
        "DateFormatter": lambda df, p: format_date(df, p["column"], p["format"], p.get("outColumn")),
        "FoldMultipleColumns": lambda df, p: unpivot(
            df, [c for c in df.columns if c not in p["columns"]], p["columns"], p["nameColumn"], p["valueColumn"]),
        "ExtractRegex": lambda df, p: regex_extract(df, p["column"], p["pattern"], p["outColumns"]),
        "RemoveDuplicates": lambda df, p: df.dropDuplicates(p.get("columns") or None),
        "Python": lambda df, p: df.transform(p["fn"]),
    }[kind]


STEP_ALIASES = {"FilterOnCustomFormula": "FilterOnFormula", "ParseDate": "DateParser", "FormatDate": "DateFormatter"}


def prepare(df: DataFrame, steps: list[dict]) -> DataFrame:
    """Run a prepare recipe given as data: ``[{"type": ..., "params": {...}}, ...]``.

    The steps fold into one logical plan; Catalyst collapses the projections
    and filters into a single stage.
    """
    return reduce(lambda acc, s: _step(STEP_ALIASES.get(s["type"], s["type"]))(acc, s.get("params", {})), steps, df)
