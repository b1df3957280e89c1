"""Grouping, summaries, pivots and frequency tables.

All of these are ``groupBy().agg()`` plans: Spark aggregates partially on the
map side, so a key holding a third of the rows is reduced to one partial row
per map task before the shuffle. Windows appear only over small aggregated
tables, and those go through ``group_total`` / the blocked scan rather than
a single global partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blank import is_not_blank, to_number
from .common import with_scalars
from .window import group_total, materialize_if_costly, running

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _is_numeric(t: str) -> bool:
    return t in NUMERIC_TYPES or t.startswith("decimal")


# A1-A6 ---------------------------------------------------------------------------
# Flag names and output suffixes of the grouping recipe.
FLAG_SUFFIX = {
    "sum": "sum", "avg": "avg", "min": "min", "max": "max", "count": "count",
    "countDistinct": "distinct", "stddev": "std", "concat": "concat",
    "first": "first", "last": "last", "sum_distinct": "sum_distinct",
}
NUMERIC_ONLY = {"sum", "avg", "stddev", "sum_distinct"}


def check_aggregation_types(df: DataFrame, aggregations: dict[str, list[str]]) -> None:
    """sum / avg / stddev need numeric columns; raise naming the column."""
    types = dict(df.dtypes)
    for c, flags in aggregations.items():
        if c not in types:
            raise ValueError(f"aggregation column {c!r} not found")
        bad = [f for f in flags if f in NUMERIC_ONLY and not _is_numeric(types[c])]
        if bad:
            raise TypeError(f"{bad} need a numeric column; {c!r} is {types[c]}")


def aggregate_expr(column: str, flag: str, order_by=None, concat_sep: str = ",", concat_distinct: bool = False) -> Column:
    """One aggregate of the grouping recipe."""
    c = F.col(column)
    if flag == "sum":
        return F.sum(c)
    if flag == "avg":
        return F.avg(c)
    if flag == "min":
        return F.min(c)
    if flag == "max":
        return F.max(c)
    if flag == "count":
        return F.count(c)
    if flag == "countDistinct":
        return F.count_distinct(c)
    if flag == "stddev":
        return F.stddev_samp(c)
    if flag == "sum_distinct":
        return F.sum_distinct(c)
    if flag == "concat":
        vals = F.collect_set(c.cast("string")) if concat_distinct else F.collect_list(c.cast("string"))
        return F.array_join(F.sort_array(vals), concat_sep)
    if flag in ("first", "last"):
        if not order_by:
            raise ValueError(f"{flag} needs an order column")
        ords = [order_by] if isinstance(order_by, str) else list(order_by)
        key = F.struct(*[F.col(o) for o in ords])
        return F.min_by(c, key) if flag == "first" else F.max_by(c, key)
    raise ValueError(f"unknown aggregation flag {flag!r}")


def group(
    df: DataFrame,
    keys,
    aggregations: dict[str, list[str]],
    global_count: bool = False,
    order_by=None,
    concat_sep: str = ",",
    concat_distinct: bool = False,
) -> DataFrame:
    """Grouping recipe: outputs ``{col}_{suffix}`` per flag, plus ``count`` when asked.

    ``first``/``last`` take the value at the smallest/greatest ``order_by``.
    Concat sorts the values (deterministic), joined by ``concat_sep``.
    """
    check_aggregation_types(df, aggregations)
    exprs = []
    for c, flags in aggregations.items():
        for f in flags:
            exprs.append(aggregate_expr(c, f, order_by, concat_sep, concat_distinct).alias(f"{c}_{FLAG_SUFFIX[f]}"))
    if global_count:
        exprs.append(F.count(F.lit(1)).alias("count"))
    return df.groupBy(*_keys(keys)).agg(*exprs)


# Summarize tool actions and the grouping flag each maps to.
SUMMARIZE_ACTIONS = {
    "Sum": "sum", "Avg": "avg", "Min": "min", "Max": "max", "Count": "count",
    "CountDistinct": "countDistinct", "Concat": "concat", "StdDev": "stddev",
    "Sum_Distinct": "sum_distinct", "First": "first", "Last": "last",
}


def summarize(df: DataFrame, fields: list[dict], order_by=None, concat_sep: str = ",") -> DataFrame:
    """Summarize tool: ``[{field, action, rename}]``; ``GroupBy`` fields are the keys."""
    keys = [f["field"] for f in fields if f["action"] == "GroupBy"]
    exprs = []
    for f in fields:
        if f["action"] == "GroupBy":
            continue
        flag = SUMMARIZE_ACTIONS[f["action"]]
        name = f.get("rename") or f"{flag}_{f['field']}"
        exprs.append(aggregate_expr(f["field"], flag, order_by, concat_sep).alias(name))
    out = df.groupBy(*keys).agg(*exprs)
    renames = {f["field"]: f["rename"] for f in fields if f["action"] == "GroupBy" and f.get("rename")}
    return out.withColumnsRenamed(renames) if renames else out


def agg(df: DataFrame, by, spec: dict[str, list[str]]) -> DataFrame:
    """pandas ``groupby(by).agg({col: [fn, ...]})`` with outputs ``{col}_{fn}``."""
    fns = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count,
           "nunique": F.count_distinct, "std": F.stddev_samp, "var": F.var_samp,
           "median": F.median, "first": F.first, "last": F.last, "size": lambda c: F.count(F.lit(1))}
    exprs = [fns[f](F.col(c)).alias(f"{c}_{f}") for c, fl in spec.items() for f in fl]
    return df.groupBy(*_keys(by)).agg(*exprs)


# A8 conditional aggregates ---------------------------------------------------------
def SUMIFS(value, *criteria: Column) -> Column:
    cond = _all(criteria)
    return F.sum(F.when(cond, F.col(value) if isinstance(value, str) else value))


def COUNTIFS(*criteria: Column) -> Column:
    return F.count_if(_all(criteria))


def AVERAGEIFS(value, *criteria: Column) -> Column:
    return F.avg(F.when(_all(criteria), F.col(value) if isinstance(value, str) else value))


def MAXIFS(value, *criteria: Column) -> Column:
    return F.max(F.when(_all(criteria), F.col(value) if isinstance(value, str) else value))


def MINIFS(value, *criteria: Column) -> Column:
    return F.min(F.when(_all(criteria), F.col(value) if isinstance(value, str) else value))


SUMIF, COUNTIF, AVERAGEIF = SUMIFS, COUNTIFS, AVERAGEIFS


def _all(criteria) -> Column:
    out = F.lit(True)
    for c in criteria:
        out = out & F.coalesce(c, F.lit(False))
    return out


# A9, A10 pivots -----------------------------------------------------------------------
def pivot(df: DataFrame, group_fields, header_field: str, data_field: str, method: str = "sum",
          values: list | None = None) -> DataFrame:
    """Cross-tab: one column per header value. Pass ``values`` to skip the discovery job."""
    fn = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max,
          "first": F.first, "concat": lambda c: F.array_join(F.sort_array(F.collect_list(c.cast("string"))), ",")}[method]
    return df.groupBy(*_keys(group_fields)).pivot(header_field, values).agg(fn(F.col(data_field)))


def tabulate(df: DataFrame, row: str, column: str, var: str, values: list, stats=("n", "sum", "mean")) -> DataFrame:
    """PROC TABULATE: row class x column class, several statistics per cell."""
    fns = {"n": lambda: F.count(F.col(var)), "sum": lambda: F.sum(var), "mean": lambda: F.avg(var),
           "min": lambda: F.min(var), "max": lambda: F.max(var), "std": lambda: F.stddev_samp(var)}
    return df.groupBy(row).pivot(column, values).agg(*[fns[s]().alias(s) for s in stats])


# A11 range aggregates --------------------------------------------------------------------
def COUNT(c) -> Column:
    """Cells holding numbers (text that parses as a number counts, as for VALUE)."""
    return F.count(to_number(c))


def COUNTA(c) -> Column:
    return F.count_if(is_not_blank(c))


def MEDIAN(c) -> Column:
    return F.median(F.col(c) if isinstance(c, str) else c)


def STDEV(c) -> Column:
    return F.stddev_samp(c)


def VAR(c) -> Column:
    return F.var_samp(c)


def SUMPRODUCT(*cols) -> Column:
    """Sum of row-wise products."""
    prod = None
    for c in cols:
        x = F.col(c) if isinstance(c, str) else c
        prod = x if prod is None else prod * x
    return F.sum(prod)


# A12 totals ---------------------------------------------------------------------------------
def with_totals(df: DataFrame, keys, aggs: dict[str, Column], total_label: str = "Total") -> DataFrame:
    """Group rows plus subtotal levels and a grand total (``rollup``).

    Key columns of total rows show ``total_label`` (string keys) and a
    ``_level`` column gives ``grouping_id``.
    """
    ks = _keys(keys)
    out = df.rollup(*ks).agg(*[v.alias(k) for k, v in aggs.items()], F.grouping_id().alias("_level"))
    types = dict(df.dtypes)
    fix = {}
    for i, k in enumerate(ks):
        bit = 1 << (len(ks) - 1 - i)
        if types[k] == "string":
            fix[k] = F.when((F.col("_level").bitwiseAND(F.lit(bit))) != 0, F.lit(total_label)).otherwise(F.col(k))
    return out.withColumns(fix) if fix else out


def subtotal(fn: str, c) -> Column:
    """SUBTOTAL / AGGREGATE function numbers 1-11 (ignore-errors = ignore nulls)."""
    x = F.col(c) if isinstance(c, str) else c
    table = {1: F.avg, 2: F.count, 3: lambda v: F.count_if(is_not_blank(v)), 4: F.max, 5: F.min,
             6: lambda v: F.try_product(v) if hasattr(F, "try_product") else F.product(v),
             7: F.stddev_samp, 8: F.stddev_pop, 9: F.sum, 10: F.var_samp, 11: F.var_pop}
    return table[int(fn) % 100](x)


# A13, A14 frequencies ------------------------------------------------------------------------
def freq_one_way(df: DataFrame, column: str) -> DataFrame:
    """PROC FREQ one-way: count, percent, cumulative count and percent by level order.

    The level table is aggregated first; the grand total is a one-row
    aggregate and the cumulative columns come from the blocked scan.
    """
    levels = df.groupBy(column).agg(F.count(F.lit(1)).alias("frequency"))
    with_total = group_total(levels, [], {"__total": F.sum("frequency")})
    cum = running(with_total, [column], {"cum_frequency": ("sum", "frequency")})
    return cum.select(
        column, "frequency",
        (F.col("frequency") * 100.0 / F.col("__total")).alias("percent"),
        "cum_frequency",
        (F.col("cum_frequency") * 100.0 / F.col("__total")).alias("cum_percent"),
    )


def freq_two_way(df: DataFrame, row: str, column: str) -> DataFrame:
    """PROC FREQ a*b: cell count, percent of total, row percent, column percent."""
    cells = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("frequency"))
    t = group_total(cells, [], {"__total": F.sum("frequency")})
    t = group_total(t, [row], {"__row_total": F.sum("frequency")})
    t = group_total(t, [column], {"__col_total": F.sum("frequency")})
    return t.select(
        row, column, "frequency",
        (F.col("frequency") * 100.0 / F.col("__total")).alias("percent"),
        (F.col("frequency") * 100.0 / F.col("__row_total")).alias("row_percent"),
        (F.col("frequency") * 100.0 / F.col("__col_total")).alias("col_percent"),
    )


# A15, A16 descriptive statistics ----------------------------------------------------------------
def means(df: DataFrame, var: str, by=None) -> DataFrame:
    """PROC MEANS: n, nmiss, mean, std, min, max, sum per class."""
    x = F.col(var)
    return df.groupBy(*_keys(by)).agg(
        F.count(x).alias("n"),
        F.count_if(x.isNull()).alias("nmiss"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.sum(x).alias("sum"),
    )


def moments(df: DataFrame, var: str, by=None) -> DataFrame:
    """Sample skewness and excess kurtosis (bias-adjusted, as PROC UNIVARIATE) from power sums."""
    return _moments(df, var, _keys(by), extremes=False)


def _moments(df: DataFrame, var: str, keys: list[str], extremes: bool) -> DataFrame:
    # two passes for numerical stability: mean first, then central power sums
    x = F.col(var).cast("double")
    first = [F.count(x).alias("n"), F.avg(x).alias("mean")]
    if extremes:
        first += [F.min(var).alias("min"), F.max(var).alias("max")]
    m = df.groupBy(*keys).agg(*first)
    j = df.select(*keys, var).join(m, keys) if keys else with_scalars(df.select(var), m)
    d = F.col(var).cast("double") - F.col("mean")
    carried = ["n", "mean"] + (["min", "max"] if extremes else [])
    s = j.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in carried],
        F.sum(d * d).alias("m2"), F.sum(d * d * d).alias("m3"), F.sum(d * d * d * d).alias("m4"))
    n = F.col("n").cast("double")
    var_ = F.col("m2") / (n - 1)
    skew = n / ((n - 1) * (n - 2)) * F.col("m3") / F.pow(var_, 1.5)
    kurt = (n * (n + 1) / ((n - 1) * (n - 2) * (n - 3)) * F.col("m4") / F.pow(var_, 2)
            - 3 * F.pow(n - 1, 2) / ((n - 2) * (n - 3)))
    extra = [F.col("min"), F.col("max"), (F.col("max") - F.col("min")).alias("range")] if extremes else []
    return s.select(*keys, *extra, "n", "mean", F.sqrt(var_).alias("std"), skew.alias("skewness"), kurt.alias("kurtosis"))


def exact_quantiles(df: DataFrame, var: str, probs: list[float], by=None, prefix: str = "p") -> DataFrame:
    """Exact ``percentile_cont`` per group without holding a group in one task.

    Values are numbered in order with the blocked scan; the two order
    statistics around each position ``1 + p*(n-1)`` are picked by equi-join
    on (group, row number) and interpolated.
    """
    keys = _keys(by)
    vals = df.select(*keys, F.col(var).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    numbered = running(vals, ["__v"], {"__rn": ("row_number", None), "__n": ("group_count", None)}, keys)
    g = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    numbered = materialize_if_costly(numbered.withColumn("__g", g))
    counts = numbered.groupBy("__g").agg(F.max("__n").alias("__n"), *[F.first(F.col(k)).alias(k) for k in keys])
    # all wanted positions meet the numbered rows in one join
    at = [F.lit(1.0) + F.lit(float(p)) * (F.col("__n") - 1) for p in probs]
    rows = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x).cast("bigint"), F.ceil(x).cast("bigint")) for x in at])))
    want = counts.select("__g", F.explode(rows).alias("__rn"))
    found = want.join(numbered.select("__g", "__rn", "__v"), ["__g", "__rn"])
    values = found.groupBy("__g").agg(F.map_from_entries(F.collect_list(F.struct("__rn", "__v"))).alias("__m"))  # two entries for each probability
    out = counts.join(values, "__g", "left")
    for p, x in zip(probs, at):
        name = f"{prefix}{int(round(p * 100)) if abs(p * 100 - round(p * 100)) < 1e-9 else p}"
        lo, hi = F.try_element_at("__m", F.floor(x).cast("bigint")), F.try_element_at("__m", F.ceil(x).cast("bigint"))
        out = out.withColumn(name, lo + (x - F.floor(x)) * (hi - lo))
    out = out.drop("__m")
    return out.drop("__g", "__n")


def mode(df: DataFrame, var: str, by=None) -> DataFrame:
    """Most frequent value per group (smallest among ties), via two aggregations."""
    keys = _keys(by)
    counts = df.filter(F.col(var).isNotNull()).groupBy(*keys, var).agg(F.count(F.lit(1)).alias("__c"))
    return counts.groupBy(*keys).agg(F.min_by(F.col(var), F.struct(-F.col("__c"), F.col(var))).alias("mode"))


def univariate(df: DataFrame, var: str, by=None, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """PROC UNIVARIATE: moments, range, mode and exact quantiles."""
    keys = _keys(by)
    out = _moments(df, var, keys, extremes=True)
    for p in (mode(df, var, keys), exact_quantiles(df, var, list(probs), keys)):
        out = out.join(p, keys) if keys else with_scalars(out, p)
    return out


# A19 ---------------------------------------------------------------------------------------------
def describe(df: DataFrame, exact: bool = False) -> DataFrame:
    """One pass: per column non-null count, null count, distinct count, min, max.

    Distinct counts are approximate (HyperLogLog++, bounded memory) unless
    ``exact``. Returns one row per column (a bounded unpivot of a one-row aggregate).
    """
    exprs = []
    for c, t in df.dtypes:
        if t.startswith(("array", "map", "struct")):
            continue
        x = F.col(c)
        exprs += [F.count(x).alias(f"{c}__count"), F.count_if(x.isNull()).alias(f"{c}__nulls"),
                  (F.count_distinct(x) if exact else F.approx_count_distinct(x)).alias(f"{c}__distinct"),
                  F.min(x).cast("string").alias(f"{c}__min"), F.max(x).cast("string").alias(f"{c}__max")]
    wide = df.agg(*exprs)
    cols = [c for c, t in df.dtypes if not t.startswith(("array", "map", "struct"))]
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(dict(df.dtypes)[c]).alias("type"),
                 F.col(f"{c}__count").alias("count"), F.col(f"{c}__nulls").alias("nulls"),
                 F.col(f"{c}__distinct").alias("distinct_approx"),
                 F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
        for c in cols]))
    return wide.select(stacked.alias("s")).select("s.*")
