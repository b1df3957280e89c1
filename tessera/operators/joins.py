"""Joins (J1-J14): equi, multi-table, three-output, match-merge, lookups.

Strategy is Spark's: AQE picks broadcast / sort-merge / shuffled-hash from
measured sizes at runtime and splits skewed partitions. Nothing here forces a
broadcast of a side whose size is not bounded. The one all-pairs form
(``append_fields``) checks the appended side's row count first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_scalars, written
from .window import materialize_if_costly, running

HOWS = {"LEFT": "left", "INNER": "inner", "RIGHT": "right", "OUTER": "full", "FULL": "full",
        "LEFT_ANTI": "left_anti", "LEFT_SEMI": "left_semi"}
BLOCKS_OF_KEY = 8  # packed blocks that a copy of a target row meets, on average


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    return [(p, p) if isinstance(p, str) else (p[0], p[1]) for p in on]


def condition(left: DataFrame, right: DataFrame, on) -> Column:
    return reduce(lambda a, b: a & b, [left[lk] == right[rk] for lk, rk in _pairs(on)])


# J1, J14 ------------------------------------------------------------------------
def join(left: DataFrame, right: DataFrame, on, how: str = "LEFT") -> DataFrame:
    """Equi-join on one or more key pairs ``(left_key, right_key)``.

    Keys with the same name on both sides are kept once (USING semantics).
    The join type is always explicit; default LEFT.
    """
    how = HOWS.get(how.upper(), how)
    pairs = _pairs(on)
    same = all(lk == rk for lk, rk in pairs)
    keys = [lk for lk, _ in pairs]
    if how == "full":
        # a full join cannot be split at a hot key; a left join and the right side's rest can
        cond = keys if same else condition(left, right, pairs)
        rest = right.join(left, cond, "left_anti")
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema if not (same and f.name in keys)]
        own = [rest[k] for k in keys] if same else []
        return left.join(right, cond, "left").union(rest.select(*own, *none, *[rest[c] for c in right.columns if not (same and c in keys)]))
    return left.join(right, keys if same else condition(left, right, pairs), how)


# J2 -------------------------------------------------------------------------------
def append_fields(target: DataFrame, source: DataFrame, max_source_rows: int = 10_000) -> DataFrame:
    """AppendFields: every target row paired with every source row.

    The source is counted first and must have at most ``max_source_rows``
    rows (an all-pairs product of two large tables is never intended). A
    one-row source is attached as a scalar subquery; a larger (bounded)
    source becomes a literal array exploded on each target row. Neither
    plans a join. ``append_in_blocks`` takes a source of any size.
    """
    rows = source.limit(max_source_rows + 1).collect()
    if len(rows) > max_source_rows:
        raise ValueError(f"append_fields source has more than {max_source_rows} rows")
    if len(rows) == 1:
        return with_scalars(target, source)
    if not rows:
        return target.limit(0).select(*target.columns, *[F.lit(None).cast(t).alias(c) for c, t in source.dtypes])
    lit_rows = F.array(*[F.struct(*[F.lit(r[c]).cast(t).alias(c) for c, t in source.dtypes]) for r in rows])
    return target.withColumn("__src", F.explode(lit_rows)).select(
        *target.columns, *[F.col(f"__src.{c}").alias(c) for c in source.columns])


def append_in_blocks(target: DataFrame, source: DataFrame, block_rows: int = 1000) -> DataFrame:
    """AppendFields for a source of any size: every target row with every source row.

    The product is what is asked for, so its rows cannot be avoided; what is
    moved can. The source is packed into arrays of at most ``block_rows``
    rows, and a target row travels once for about ``BLOCKS_OF_KEY`` of them;
    the pairs are only unpacked after the join. Equal rows on either side
    keep their number, an empty side gives no rows.
    """
    rows = written(source.select(F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("__src")))
    # places in the written files, so that a task that runs again packs the same blocks
    place = rows.withColumn("__at", F.monotonically_increasing_id())
    part, offset = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    packed = place.groupBy(part.alias("__part"), F.floor(offset / F.lit(block_rows)).alias("__no")).agg(F.collect_list("__src").alias("__rows"))
    packed = written(packed)
    keys = max(1, packed.count() // BLOCKS_OF_KEY)
    packed = packed.select(F.pmod(F.xxhash64("__part", "__no"), F.lit(keys)).cast("int").alias("__key"), "__rows")
    copies = target.select(F.struct(*[F.col(f"`{c}`") for c in target.columns]).alias("__row"),
                           F.explode(F.sequence(F.lit(0), F.lit(keys - 1))).alias("__key"))
    pairs = copies.join(packed, "__key").select("__row", F.explode("__rows").alias("__src"))
    return pairs.select("__row.*", "__src.*")


# J3 -------------------------------------------------------------------------------
def join_multiple(base: DataFrame, joins: list[tuple[DataFrame, object, str]]) -> DataFrame:
    """Left fold: each later input joins the result so far with its own keys and type."""
    return reduce(lambda acc, j: join(acc, j[0], j[1], j[2] if len(j) > 2 else "LEFT"), joins, base)


# J4, J5 -----------------------------------------------------------------------------
def select_columns(df: DataFrame, mode: str, columns) -> DataFrame:
    """Per-input column selection before a join: SELECT keeps, DROP removes."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    return df.select(*cols) if mode.upper() == "SELECT" else df.drop(*cols)


def prefixed(df: DataFrame, prefix: str, keep=()) -> DataFrame:
    """Rename every column to ``{prefix}_{name}`` (except ``keep``)."""
    return df.select(*[F.col(c).alias(c if c in keep else f"{prefix}_{c}") for c in df.columns])


# J6 ---------------------------------------------------------------------------------
def join_three_way(left: DataFrame, right: DataFrame, on) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Join tool outputs: (left-only rows, joined rows, right-only rows)."""
    cond = condition(left, right, on)
    return (
        left.join(right, cond, "left_anti"),
        left.join(right, cond, "inner"),
        right.join(left, condition(right, left, [(rk, lk) for lk, rk in _pairs(on)]), "left_anti"),
    )


# J7 ---------------------------------------------------------------------------------
def check_join_compatibility(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> None:
    """Both keys exist and share a type; raise naming both otherwise."""
    lt, rt = dict(left.dtypes), dict(right.dtypes)
    if left_key not in lt:
        raise ValueError(f"left key {left_key!r} not found; columns: {sorted(lt)}")
    if right_key not in rt:
        raise ValueError(f"right key {right_key!r} not found; columns: {sorted(rt)}")
    if lt[left_key] != rt[right_key]:
        raise TypeError(f"join key types differ: {left_key} is {lt[left_key]}, {right_key} is {rt[right_key]}")


# J8 ---------------------------------------------------------------------------------
def match_merge(x: DataFrame, y: DataFrame, by, keep: str = "all", in_x: str | None = None,
                in_y: str | None = None, check: bool = True) -> DataFrame:
    """SAS ``merge x(in=inX) y(in=inY); by k;``.

    ``keep``: ``'x'`` (if inX), ``'y'`` (if inY), ``'both'`` (if inX and inY),
    ``'all'`` (no subsetting). On a match, y's same-named columns win (even
    when missing), as in the program data vector. Many-to-many merges are
    refused when ``check``; :func:`match_merge_by_position` pairs them.
    """
    by = [by] if isinstance(by, str) else list(by)
    if check:
        dup_x = x.groupBy(*by).count().filter("count > 1").select(*by)
        dup_y = y.groupBy(*by).count().filter("count > 1").select(*by)
        if dup_x.join(dup_y, by).limit(1).count():
            raise ValueError("many-to-many match-merge: both inputs repeat a by value")
    xs = x.withColumn("__in_x", F.lit(True))
    ys = y.withColumn("__in_y", F.lit(True))
    if keep == "all":
        # full outer = (x left join y) + (y rows without x): AQE can split a hot key in
        # both of those joins, but not in a full outer join
        left = _merge_select(xs.join(ys, [xs[k].eqNullSafe(ys[k]) for k in by], "left"), xs, ys, x, y, by, in_x, in_y)
        only_y = ys.join(xs, [ys[k].eqNullSafe(xs[k]) for k in by], "left_anti")
        return left.unionByName(_merge_select_y_only(only_y, x, y, by, in_x, in_y))
    how = {"x": "left", "y": "right", "both": "inner"}[keep]
    return _merge_select(xs.join(ys, [xs[k].eqNullSafe(ys[k]) for k in by], how), xs, ys, x, y, by, in_x, in_y)


def match_merge_by_position(tables: list[tuple[DataFrame, object]], by, in_flags: list[str] | None = None) -> DataFrame:
    """``merge a b c ...; by k;`` of any number of tables, repeats on every side allowed.

    ``tables`` are (table, order columns), the order being that of its rows
    within a by value (make it total). Rows of a by value are paired by
    position; a table that has run out keeps its last row. A column of several
    tables takes the value of the last one, in the order listed, that gave a new
    row; at a position where none did, the value stays. ``in_flags`` name
    columns that say which tables have the by value. Null by values match.

    Positions come from the blocked scan, and pairing is a join on (by,
    position), so a frequent by value is spread over its positions.
    """
    by = [by] if isinstance(by, str) else list(by)
    numbered, values = [], []
    for t, order in tables:
        n = running(t, order, {"__p": ("row_number", None), "__n": ("group_count", None)}, by)
        numbered.append(materialize_if_costly(n.withColumn("__g", F.struct(*by))))
        values.append([c for c in t.columns if c not in by])
    spine = reduce(DataFrame.unionByName, [n.select("__g", "__p") for n in numbered]).distinct()
    for i, (n, own) in enumerate(zip(numbered, values)):
        sizes = n.where("__p = 1").select("__g", F.col("__n").alias(f"__n{i}"))
        spine = spine.join(sizes, "__g", "left").withColumn(f"__at{i}", F.least("__p", f"__n{i}"))
        right = n.select(F.col("__g").alias("__h"), F.col("__p").alias("__q"), F.struct(F.lit(1).alias("__one"), *own).alias(f"__v{i}"))
        # least ignores nulls: a table without the by value has no size and matches nothing
        on = (F.col("__g") == F.col("__h")) & (F.col(f"__at{i}") == F.col("__q")) & F.col(f"__n{i}").isNotNull()
        spine = spine.join(right, on, "left").drop("__h", "__q")
    out = []
    for c in dict.fromkeys(c for own in values for c in own):
        have = [i for i, own in enumerate(values) if c in own]
        x = F.col(f"__v{have[0]}")[c]
        if len(have) > 1:
            newest = F.least(F.col("__p"), F.greatest(*[F.coalesce(f"__n{i}", F.lit(0)) for i in have]))
            for i in have[1:]:
                x = F.when(F.col(f"__n{i}") >= newest, F.col(f"__v{i}")[c]).otherwise(x)
        out.append(x.alias(c))
    flags = [F.col(f"__n{i}").isNotNull().alias(name) for i, name in enumerate(in_flags or []) if name]
    return spine.select(*[F.col(f"__g.{k}").alias(k) for k in by], *out, *flags)


def _merge_select(j: DataFrame, xs: DataFrame, ys: DataFrame, x: DataFrame, y: DataFrame, by, in_x, in_y) -> DataFrame:
    shared = [c for c in x.columns if c in y.columns and c not in by]
    out = [F.coalesce(xs[k], ys[k]).alias(k) for k in by]
    iy = F.coalesce(ys["__in_y"], F.lit(False))
    for c in x.columns:
        if c in by:
            continue
        out.append(F.when(iy, ys[c]).otherwise(xs[c]).alias(c) if c in shared else xs[c])
    out += [ys[c] for c in y.columns if c not in by and c not in shared]
    if in_x:
        out.append(F.coalesce(xs["__in_x"], F.lit(False)).alias(in_x))
    if in_y:
        out.append(iy.alias(in_y))
    return j.select(*out)


def _merge_select_y_only(only_y: DataFrame, x: DataFrame, y: DataFrame, by, in_x, in_y) -> DataFrame:
    """Rows of y with no x match, in the merge's column layout."""
    shared = [c for c in x.columns if c in y.columns and c not in by]
    types = dict(x.dtypes)
    out = [F.col(k) for k in by]
    for c in x.columns:
        if c in by:
            continue
        out.append(F.col(c) if c in shared else F.lit(None).cast(types[c]).alias(c))
    out += [F.col(c) for c in y.columns if c not in by and c not in shared]
    if in_x:
        out.append(F.lit(False).alias(in_x))
    if in_y:
        out.append(F.lit(True).alias(in_y))
    return only_y.select(*out)


# J9, J11, J12 --------------------------------------------------------------------------
def lookup_exact(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, values, order_col: str,
                 default=None, prefix: str = "") -> DataFrame:
    """VLOOKUP/XLOOKUP exact: the first lookup row (by ``order_col``) per key.

    The lookup side is reduced to one row per key with a partial aggregation
    (skew-proof), then left-joined; misses take ``default`` (IFNA).
    """
    vals = [values] if isinstance(values, str) else list(values)
    first = lookup.groupBy(F.col(lookup_key).alias("__lk")).agg(
        F.min_by(F.struct(*[F.col(v) for v in vals]), F.col(order_col)).alias("__hit"))
    j = df.join(first, df[key] == first["__lk"], "left")
    outs = {}
    for v in vals:
        c = F.col(f"__hit.{v}")
        outs[prefix + v] = F.coalesce(c, F.lit(default)) if default is not None else c
    return j.withColumns(outs).drop("__lk", "__hit")


def lookup_position(df: DataFrame, column: str, lookup: DataFrame, lookup_col: str, order_col: str,
                    out: str = "match") -> DataFrame:
    """MATCH(x, range, 0): 1-based position of the first equal value in the lookup's order."""
    numbered = running(lookup, [order_col], {"__pos": ("row_number", None)})
    first = numbered.groupBy(F.col(lookup_col).alias("__lk")).agg(F.min("__pos").alias(out))
    return df.join(first, df[column] == first["__lk"], "left").drop("__lk")


def value_at(df: DataFrame, position: str, lookup: DataFrame, value_col: str, order_col: str,
             out: str = "value") -> DataFrame:
    """INDEX(range, n): the value at 1-based position ``n`` of the lookup's order."""
    numbered = running(lookup, [order_col], {"__pos": ("row_number", None)}).select(
        "__pos", F.col(value_col).alias(out))
    return df.join(numbered, df[position] == numbered["__pos"], "left").drop("__pos")


def hlookup(df: DataFrame, key: str, wide: DataFrame, header_values: list[str], row_on: list[tuple[str, str]],
            out: str = "value") -> DataFrame:
    """HLOOKUP: the header row holds the keys (column names of ``wide``).

    ``wide`` is unpivoted to (row keys, header, value) and joined on the
    header value plus the ``row_on`` pairs ``(df_column, wide_column)`` that
    choose the row.
    """
    row_cols = [w for _, w in row_on]
    long = wide.select(*row_cols, *header_values).unpivot(row_cols, header_values, "__hdr", "__val")
    long = long.select(*[F.col(w).alias(f"__row_{i}") for i, w in enumerate(row_cols)], "__hdr", "__val")
    cond = df[key] == long["__hdr"]
    for i, (d, _) in enumerate(row_on):
        cond = cond & (df[d] == long[f"__row_{i}"])
    j = df.join(long, cond, "left")
    return j.withColumnRenamed("__val", out).drop("__hdr", *[f"__row_{i}" for i in range(len(row_on))])


# J10 ------------------------------------------------------------------------------------
def asof_lookup(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, values, by=None,
                tie_col: str | None = None, prefix: str = "", direction: str = "down", **kw) -> DataFrame:
    """Approximate lookup: values of the lookup row with the greatest key <= the row's key.

    ``direction='up'`` takes the smallest key >= the row's key. Keys are
    compared in the wider of the two types. A null key or ``by`` value finds
    nothing, as in the equi-joins.

    Both sides are stacked and scanned in key order per ``by`` group,
    lookup rows first on equal keys; each data row takes the last lookup
    row seen (``last`` ignoring nulls). The scan is the blocked one from
    ``window.running``, so it neither needs a range join nor one task per
    group. Among equal lookup keys the greatest ``tie_col`` wins, in its own order.
    """
    if direction not in ("down", "up"):
        raise ValueError("direction is 'down' or 'up'")
    vals = [values] if isinstance(values, str) else list(values)
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    # the type that Spark itself compares the two keys in
    both = df.select(F.col(key).alias("__k")).limit(0).union(lookup.select(F.col(lookup_key).alias("__k")).limit(0))
    key_type = both.schema["__k"].dataType
    tie_type = lookup.schema[tie_col].dataType if tie_col else "double"
    data = df.withColumns({"__k": F.col(key).cast(key_type), "__side": F.lit(1),
                           "__tie": F.lit(None).cast(tie_type), "__v": F.lit(None)})
    struct = F.struct(*[F.col(v).alias(v) for v in vals])
    lk = lookup.select(
        *[F.col(b) for b in by],
        F.col(lookup_key).cast(key_type).alias("__k"),
        F.lit(0).alias("__side"),
        (F.col(tie_col) if tie_col else F.lit(None).cast("double")).alias("__tie"),
        struct.alias("__v"),
    ).filter(F.col("__k").isNotNull())
    for b in by:
        lk = lk.filter(F.col(b).isNotNull())
    data = data.withColumn("__v", F.lit(None).cast(lk.schema["__v"].dataType))
    stacked = data.unionByName(lk, allowMissingColumns=True)
    # upwards the scan runs from the greatest key down; the greatest tie still comes last
    order = ["__k", "__side", "__tie"] if direction == "down" else [("__k", False), "__side", "__tie"]
    scanned = running(stacked, order, {"__hit": ("last", "__v")}, by, **kw)
    res = scanned.filter(F.col("__side") == 1)
    found = F.when(F.col("__k").isNotNull(), F.col("__hit"))
    return res.select(*df.columns, *[found[v].alias(prefix + v) for v in vals])


# J13 ------------------------------------------------------------------------------------
def join_case_insensitive(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                          how: str = "LEFT") -> DataFrame:
    """Join on lower-cased keys; both original keys are kept."""
    how = HOWS.get(how.upper(), how)
    return left.join(right, F.lower(left[left_key]) == F.lower(right[right_key]), how)
