"""Ordered, windowed calculations.

Running calculations use a *blocked scan* instead of one window per group:

1. A numeric block key is derived from the first order column and cut into
   ``blocks`` ranges at approximate quantiles (one small sampling job that
   returns ``blocks - 1`` numbers to the driver).
2. A window runs inside each (group, block); a group that holds a third of
   all rows is spread over every block, so no task holds a whole group.
3. Per (group, block) totals (a table of at most groups x blocks rows, read
   from the same shuffle) get an exclusive prefix over blocks, and are joined
   back on (group, block); the big side is already partitioned on those keys.

Ties in the order columns never straddle a block (the block key is a
monotone function of the first order column), so ranks stay exact. Text is
cut by the bytes after its common beginning. Where one value of the first
order column (or null) fills more than a block, or its type has no numeric key,
the cuts are tuples of all leading order columns of one direction, so a day that
holds most rows is cut by what follows the date. The scan runs in blocks at
every input size; ``blocks=1`` asks for the plain per-group window.
"""

from __future__ import annotations

import re
from typing import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import ensure_checkpoint_dir
from .common import with_scalars

NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}
KINDS = {"sum", "count", "min", "max", "last", "row_number", "rank", "dense_rank", "group_count"}


def _order_spec(order_by) -> list[tuple[str, bool]]:
    if isinstance(order_by, (str, tuple)):
        order_by = [order_by]
    out = []
    for o in order_by:
        out.append((o, True) if isinstance(o, str) else (o[0], bool(o[1])))
    return out


def _order_cols(spec) -> list[Column]:
    # Spark's defaults: ascending puts nulls first, descending puts them last.
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in spec]


def _block_key(df: DataFrame, name: str, asc: bool, skip: int = 0) -> Column | None:
    t = dict(df.dtypes)[name]
    c = F.col(name)
    if t in NUMERIC or t.startswith("decimal"):
        k = c.cast("double")
    elif t == "timestamp":
        k = F.unix_micros(c).cast("double")
    elif t == "timestamp_ntz":
        # whole seconds since the epoch from the fields: monotone, zone free
        k = (F.unix_date(F.to_date(c)).cast("double") * 86400.0
             + F.hour(c) * 3600.0 + F.minute(c) * 60.0 + F.second(c))
    elif t == "date":
        k = F.unix_date(c).cast("double")
    elif t == "string":
        # six bytes after what all values begin with, as a number: monotone in the text
        k = F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), skip + 1, 6)), 12, "0"), 16, 10).cast("double")
    else:
        return None
    return k if asc else -k


def _common_prefix(df: DataFrame, name: str) -> int:
    """Bytes that all values of a text column begin with (0 for other columns)."""
    if dict(df.dtypes)[name] != "string":
        return 0
    row = df.agg(F.min(name).alias("lo"), F.max(name).alias("hi")).first()
    lo, hi = (row["lo"] or "").encode(), (row["hi"] or "").encode()
    return next((i for i, (x, y) in enumerate(zip(lo, hi)) if x != y), min(len(lo), len(hi)))


CASE_MAX_SPLITS = 255  # a deeper CASE tree outgrows the 64 KB generated-method limit


def _bucket(k: Column, splits: list[float], null_block: int, nan_block: int | None = None) -> Column:
    """Binary search over sorted split points as nested CASE (codegen friendly).

    Nulls go to ``null_block``; NaN (which Spark orders above every number)
    goes to ``nan_block`` (the last block ascending, the first descending).
    Used up to ``CASE_MAX_SPLITS`` splits; see :func:`with_block`.
    """

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(k < F.lit(splits[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))

    expr = F.when(k.isNull(), F.lit(null_block))
    if nan_block is not None:
        expr = expr.when(F.isnan(k), F.lit(nan_block))
    return expr.otherwise(build(0, len(splits)))


def with_block(df: DataFrame, k: Column, splits: list[float], null_block: int, nan_block: int,
               name: str = "__blk") -> DataFrame:
    """Add the block number of key ``k``: block b holds keys in [splits[b-1], splits[b]).

    Few splits compile to a nested CASE inside whole-stage codegen; many
    splits (cluster-sized block counts) use ML's ``Bucketizer``, a JVM-side
    binary search whose code size does not grow with the split count.
    """
    # the key is computed once into a column; the search then reads that column
    keyed = df.withColumn("__bkey", k)
    if len(splits) <= CASE_MAX_SPLITS:
        return keyed.withColumn(name, _bucket(F.col("__bkey"), splits, null_block, nan_block)).drop("__bkey")
    from pyspark.ml.feature import Bucketizer

    b = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol="__bkey", outputCol="__braw",
                   handleInvalid="keep").transform(keyed)
    blk = (F.when(F.col("__bkey").isNull(), F.lit(null_block)).when(F.isnan("__bkey"), F.lit(nan_block))
           .otherwise(F.col("__braw").cast("int")))
    return b.withColumn(name, blk).drop("__bkey", "__braw")


def default_blocks(df: DataFrame) -> int:
    return max(1, min(16384, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


# Logical operators whose output is costly to recompute (a shuffle or Python).
_COSTLY = re.compile(r"\b(Join|Aggregate|Window|Sort|Expand|Generate|Deduplicate|Repartition\w*|"
                     r"\w*InPandas\w*|ArrowEvalPython|BatchEvalPython)\b")


def materialize_if_costly(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` to the shared checkpoint folder when its plan shuffles or runs Python.

    Operators that read their input twice (statistics pass, then the data
    pass) call this so an expensive upstream is computed once; the reliable
    checkpoint also cuts the lineage, so a lost executor does not recompute
    the upstream. Plain scans/filters/projections are simply read again.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if not _COSTLY.search(plan):
        return df
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def block_splits(df: DataFrame, order_by, blocks: int, rel_err: float | None = None) -> list[float] | None:
    """Quantile split points of the block key (``blocks - 1`` numbers at most)."""
    spec = _order_spec(order_by)
    return _splits(df, _block_key(df, *spec[0], skip=_common_prefix(df, spec[0][0])), blocks, rel_err)


def _quantiles(df: DataFrame, k: Column, blocks: int, rel_err: float | None = None) -> tuple[list[float], float]:
    """Values of ``k`` at the block ends, repeats included, and the share of rows without a value."""
    probs = [i / blocks for i in range(1, blocks)]
    err = rel_err if rel_err is not None else 1.0 / (4 * blocks)
    row = df.select(k.alias("__k")).agg(
        F.percentile_approx("__k", probs, int(max(10_000, 1.0 / err))).alias("q"),
        F.count("__k").alias("n"), F.count(F.lit(1)).alias("all")).first()
    return [q for q in row["q"] or [] if q is not None and q == q], 1 - row["n"] / max(row["all"], 1)


def _splits(df: DataFrame, k: Column | None, blocks: int, rel_err: float | None = None) -> list[float] | None:
    if k is None or blocks <= 1:
        return None
    return sorted(set(_quantiles(df, k, blocks, rel_err)[0]))


SAMPLE_EACH = 64  # order tuples sampled for each block when cutting by tuples


def _tuple_bounds(df: DataFrame, names: list[str], blocks: int) -> tuple[DataFrame, int]:
    """One row holding the tuples at which blocks 1, 2, ... begin (ascending), and their number.

    Spark's range partitioner finds them on a sample of the order columns;
    equal tuples are in one of its partitions. They are checkpointed, so that
    every reader sees the same cuts.
    """
    keys = df.select(F.struct(*names).alias("k"))
    share = SAMPLE_EACH * blocks / max(keys.count(), 1)
    sample = keys if share >= 1 else keys.sample(share, seed=7)
    parts = sample.repartitionByRange(blocks, "k").groupBy(F.spark_partition_id().alias("p")).agg(F.min("k").alias("k"))
    ensure_checkpoint_dir(df.sparkSession)
    # at most `blocks` tuples; the first block needs no cut
    starts = F.sort_array(F.collect_list("k"))
    bounds = parts.agg(F.slice(starts, 2, blocks).alias("bounds")).checkpoint(eager=True)
    return bounds, bounds.select(F.size("bounds").alias("n")).first()["n"]


def _with_tuple_block(df: DataFrame, names: list[str], asc: bool, bounds: DataFrame, n: int, name: str) -> DataFrame:
    """Add the number of cuts at or before each row's tuple (counted from the end for descending order)."""
    key = F.struct(*names)
    steps = F.array(*[F.lit(1 << j) for j in reversed(range(n.bit_length()))])
    cuts = F.col("__cuts")
    # binary search: beyond the last cut F.get is null, which takes no step
    at = F.aggregate(steps, F.lit(0), lambda pos, step: F.when(F.get(cuts, pos + step - 1) <= key, pos + step).otherwise(pos))
    return df.withColumn("__cuts", bounds.scalar()).withColumn(name, at if asc else F.lit(n) - at).drop("__cuts")


def _cut(df: DataFrame, spec, blocks: int, splits: list[float] | None = None, name: str = "__blk") -> DataFrame | None:
    """``df`` with the number of the block that each row is in; None where there is one block only."""
    if not splits and blocks <= 1:
        return None
    first, asc = spec[0]
    key = _block_key(df, first, asc, _common_prefix(df, first))
    if splits is None:
        ends = next((i for i, (_, a) in enumerate(spec) if a != asc), len(spec))
        leading = [c for c, _ in spec[:ends]]
        hot = key is None
        if key is not None:
            at, nulls = _quantiles(df, key, blocks)
            splits = sorted(set(at))
            hot = len(leading) > 1 and (len(at) > len(splits) or nulls * blocks > 1.5)
        if hot:
            bounds, n = _tuple_bounds(df, leading, blocks)
            if n:
                return _with_tuple_block(df, leading, asc, bounds, n, name)
    if not splits:
        return None
    return with_block(df, key, splits, 0 if asc else len(splits), len(splits) if asc else 0, name)


def running(
    df: DataFrame,
    order_by,
    aggs: dict[str, tuple[str, str | None]],
    partition_by: Iterable[str] = (),
    blocks: int | None = None,
    splits: list[float] | None = None,
) -> DataFrame:
    """Add running calculations per group in order.

    ``aggs`` maps an output name to ``(kind, column)``; kinds: ``sum``,
    ``count`` (non-null values; column None counts rows), ``min``, ``max``,
    ``last`` (last non-null value so far), ``row_number``, ``rank``,
    ``dense_rank``, ``group_count`` (rows in the whole group).
    Frames are "unbounded preceding to current row" by rows. Give a total
    order (add a unique tie-breaker) for ``row_number`` and ``last``.
    """
    pk = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    spec = _order_spec(order_by)
    for name, (kind, _) in aggs.items():
        if kind not in KINDS:
            raise ValueError(f"unknown running kind {kind!r} for {name}")
    n_blocks = default_blocks(df) if blocks is None else blocks
    if splits or n_blocks > 1:
        # the input is read more than once below (statistics, then data): compute it once
        df = materialize_if_costly(df)
    blocked = _cut(df, spec, n_blocks, splits)
    res = _running_plain(df, spec, aggs, pk) if blocked is None else _running_blocked(df, blocked, spec, aggs, pk)
    # the same types whatever the number of blocks
    sums = {n: df.select(F.sum(c).alias("s")).schema["s"].dataType for n, (k, c) in aggs.items() if k == "sum"}
    counts = {n: "bigint" for n, (k, _) in aggs.items() if k in ("count", "row_number", "rank", "dense_rank", "group_count")}
    return res.withColumns({n: F.col(n).cast(t) for n, t in (sums | counts).items()})


def _running_plain(df, spec, aggs, pk):
    order = _order_cols(spec)
    w = Window.partitionBy(*pk).orderBy(*order)
    wf = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wall = Window.partitionBy(*pk)
    exprs = {}
    for name, (kind, c) in aggs.items():
        x = F.col(c) if c else None
        exprs[name] = {
            "sum": lambda: F.sum(x).over(wf),
            "count": lambda: F.count(x if x is not None else F.lit(1)).over(wf),
            "min": lambda: F.min(x).over(wf),
            "max": lambda: F.max(x).over(wf),
            "last": lambda: F.last(x, ignorenulls=True).over(wf),
            "row_number": lambda: F.row_number().over(w),
            "rank": lambda: F.rank().over(w),
            "dense_rank": lambda: F.dense_rank().over(w),
            "group_count": lambda: F.count(F.lit(1)).over(wall),
        }[kind]()
    return df.withColumns(exprs)


def _running_blocked(df, blocked, spec, aggs, pk):
    cols = df.columns
    g = F.struct(*[F.col(c) for c in pk]) if pk else F.lit(0)
    blocked = blocked.withColumn("__g", g)

    order = _order_cols(spec)
    w = Window.partitionBy("__g", "__blk").orderBy(*order)
    wf = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local_exprs = {"__rn": F.row_number().over(w)}
    for name, (kind, c) in aggs.items():
        x = F.col(c) if c else None
        if kind == "sum":
            local_exprs[f"__l_{name}"] = F.sum(x).over(wf)
        elif kind == "count":
            local_exprs[f"__l_{name}"] = F.count(x if x is not None else F.lit(1)).over(wf)
        elif kind == "min":
            local_exprs[f"__l_{name}"] = F.min(x).over(wf)
        elif kind == "max":
            local_exprs[f"__l_{name}"] = F.max(x).over(wf)
        elif kind == "last":
            local_exprs[f"__l_{name}"] = F.last(x, ignorenulls=True).over(wf)
        elif kind == "rank":
            local_exprs[f"__l_{name}"] = F.rank().over(w)
        elif kind == "dense_rank":
            local_exprs[f"__l_{name}"] = F.dense_rank().over(w)
    local = blocked.withColumns(local_exprs)

    # Per (group, block) summary. Taken from the input with map-side partial
    # aggregation (one row per (group, block) per task crosses the network);
    # only "last" under a descending order needs the window's row numbers.
    all_asc = all(a for _, a in spec)
    from_window = any(kind == "last" for kind, _ in aggs.values()) and not all_asc
    order_key = F.struct(*[F.col(c2) for c2, _ in spec])
    summ = {"__n": F.count(F.lit(1))}
    for name, (kind, c) in aggs.items():
        x = F.col(c) if c else None
        if kind == "sum":
            summ[f"__s_{name}"] = F.sum(x)
        elif kind == "count":
            summ[f"__s_{name}"] = F.count(x if x is not None else F.lit(1))
        elif kind == "min":
            summ[f"__s_{name}"] = F.min(x)
        elif kind == "max":
            summ[f"__s_{name}"] = F.max(x)
        elif kind == "last":
            # ascending order: the struct of order columns sorts like the window (nulls first)
            rank_key = F.col("__rn") if from_window else order_key
            summ[f"__s_{name}"] = F.max_by(x, F.when(x.isNotNull(), rank_key))
        elif kind == "dense_rank":
            summ[f"__s_{name}"] = F.count_distinct(order_key)
    summary = (local if from_window else blocked).groupBy("__g", "__blk").agg(*[v.alias(k) for k, v in summ.items()])

    wp = Window.partitionBy("__g").orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    prefix = {"__before": F.sum("__n").over(wp)}
    if any(k == "group_count" for k, _ in aggs.values()):
        prefix["__whole"] = F.sum("__n").over(Window.partitionBy("__g"))
    for name, (kind, _) in aggs.items():
        s = F.col(f"__s_{name}")
        if kind in ("sum", "count", "dense_rank"):
            prefix[f"__p_{name}"] = F.sum(s).over(wp)
        elif kind == "min":
            prefix[f"__p_{name}"] = F.min(s).over(wp)
        elif kind == "max":
            prefix[f"__p_{name}"] = F.max(s).over(wp)
        elif kind == "last":
            prefix[f"__p_{name}"] = F.last(s, ignorenulls=True).over(wp)
    offsets = summary.select("__g", "__blk", *[v.alias(k) for k, v in prefix.items()])

    joined = local.join(offsets, ["__g", "__blk"], "left")
    pn = F.coalesce(F.col("__before"), F.lit(0))
    final = {}
    for name, (kind, _) in aggs.items():
        lc, pc = F.col(f"__l_{name}"), F.col(f"__p_{name}")
        if kind == "sum":
            final[name] = F.when(lc.isNull() & pc.isNull(), F.lit(None)).otherwise(
                F.coalesce(lc, F.lit(0)) + F.coalesce(pc, F.lit(0)))
        elif kind == "count":
            final[name] = lc + F.coalesce(pc, F.lit(0))
        elif kind == "min":
            final[name] = F.least(lc, pc)
        elif kind == "max":
            final[name] = F.greatest(lc, pc)
        elif kind == "last":
            final[name] = F.coalesce(lc, pc)
        elif kind == "row_number":
            final[name] = F.col("__rn") + pn
        elif kind == "rank":
            final[name] = lc + pn
        elif kind == "dense_rank":
            final[name] = lc + F.coalesce(pc, F.lit(0))
        elif kind == "group_count":
            final[name] = F.col("__whole")
    return joined.select(*cols, *[v.alias(k) for k, v in final.items()])


# W1 -------------------------------------------------------------------------
def running_total(df: DataFrame, columns, order_by, partition_by=(), suffix: str = "_cumsum", **kw) -> DataFrame:
    """RunningTotal: cumulative sum per group in order, one output per column."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    return running(df, order_by, {c + suffix: ("sum", c) for c in cols}, partition_by, **kw)


# W2 -------------------------------------------------------------------------
def group_total(df: DataFrame, partition_by, aggs: dict[str, Column]) -> DataFrame:
    """Whole-group aggregates as columns on every row.

    Aggregated with map-side partial aggregation, then joined back; AQE turns
    the join into a broadcast when the measured aggregate is small and splits
    a skewed key otherwise. No task ever holds a whole group.
    """
    pk = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    df = materialize_if_costly(df)  # read twice: aggregate branch and row branch
    if not pk:
        totals = df.agg(*[v.alias(k) for k, v in aggs.items()])
        return with_scalars(df, totals)
    g = F.struct(*[F.col(c) for c in pk])
    totals = df.groupBy(g.alias("__g")).agg(*[v.alias(k) for k, v in aggs.items()])
    return df.withColumn("__g", g).join(totals, "__g", "left").drop("__g")


# W3, W4, W5, W6 ----------------------------------------------------------------
def rank(df: DataFrame, order_by, partition_by=(), out: str = "rank", dense: bool = False, **kw) -> DataFrame:
    return running(df, order_by, {out: ("dense_rank" if dense else "rank", None)}, partition_by, **kw)


def row_number(df: DataFrame, order_by, partition_by=(), out: str = "row_number", **kw) -> DataFrame:
    return running(df, order_by, {out: ("row_number", None)}, partition_by, **kw)


def first_last_flags(df: DataFrame, by, order_by, first: str = "first", last: str = "last", **kw) -> DataFrame:
    """DATA step ``first.x`` / ``last.x``: flags for the first and last row of each by-group."""
    by = [by] if isinstance(by, str) else list(by)
    res = running(df, order_by, {"__rn": ("row_number", None), "__gn": ("group_count", None)}, by, **kw)
    return res.withColumns({first: F.col("__rn") == 1, last: F.col("__rn") == F.col("__gn")}).drop("__rn", "__gn")


def keep_first_per_group(df: DataFrame, by, order_by, last: bool = False) -> DataFrame:
    """Keep the first (or last) row of each by-group.

    ``row_number() <= 1`` is planned with a map-side partial group limit
    (WindowGroupLimit) so a hot group shrinks to one row per map task before
    the shuffle.
    """
    by = [by] if isinstance(by, str) else list(by)
    spec = _order_spec(order_by)
    if last:
        spec = [(c, not asc) for c, asc in spec]
    w = Window.partitionBy(*by).orderBy(*_order_cols(spec))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= 1).drop("__rn")


# W7 ---------------------------------------------------------------------------------
def retain(df: DataFrame, by, order_by, carry: dict[str, str] | None = None, sums: dict[str, str] | None = None,
           mins: dict[str, str] | None = None, maxs: dict[str, str] | None = None, counts: dict[str, str] | None = None,
           **kw) -> DataFrame:
    """RETAIN: carry the last non-missing value forward; running sum/min/max/count.

    Each dict maps output name -> input column.
    """
    aggs = {}
    for d, kind in ((carry, "last"), (sums, "sum"), (mins, "min"), (maxs, "max"), (counts, "count")):
        for out, c in (d or {}).items():
            aggs[out] = (kind, c)
    return running(df, order_by, aggs, by, **kw)


# W8 ---------------------------------------------------------------------------------
def shifted(df: DataFrame, columns, order_by, partition_by=(), offset: int = 1, default=None,
            suffix: str | None = None, **kw) -> DataFrame:
    """Read the value ``offset`` rows back (negative: forward) in the group's order."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    sfx = suffix or (f"_lag{offset}" if offset >= 0 else f"_lead{-offset}")
    return shift_many(df, [(c, offset, default, c + sfx) for c in cols], order_by, partition_by, **kw)


def shift_many(df: DataFrame, shifts: list[tuple[str, int, object, str]], order_by, partition_by=(), **kw) -> DataFrame:
    """Several lag/lead columns at once: ``(column, offset, default, out)``; positive offsets look back.

    Rows are numbered once with the blocked scan (materialized), then each
    distinct offset is one equi-join on (group, row number ± offset); rows of
    a hot group spread over all partitions because the row number is part of
    the key. Give a total order.
    """
    pk = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    numbered = row_number(df, order_by, pk, out="__rn", **kw)
    g = F.struct(*[F.col(c) for c in pk]) if pk else F.lit(0)
    numbered = materialize_if_costly(numbered.withColumn("__g", g))
    out = numbered
    for off in sorted({s[1] for s in shifts}):
        these = [s for s in shifts if s[1] == off]
        other = numbered.select("__g", (F.col("__rn") + F.lit(off)).alias("__rn"),
                                *[F.col(c).alias(name) for c, _, _, name in these])
        out = out.join(other, ["__g", "__rn"], "left")
        fills = {name: F.coalesce(F.col(name), F.lit(dflt)) for _, _, dflt, name in these if dflt is not None}
        if fills:
            out = out.withColumns(fills)
    return out.drop("__g", "__rn")


def lag_lead_window(df: DataFrame, column: str, order_by, partition_by=(), offset: int = 1, default=None,
                    out: str | None = None) -> DataFrame:
    """Plain ``lag``/``lead`` window (one task per group); for bounded groups."""
    pk = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    w = Window.partitionBy(*pk).orderBy(*_order_cols(_order_spec(order_by)))
    fn = F.lag(column, offset, default) if offset >= 0 else F.lead(column, -offset, default)
    return df.withColumn(out or f"{column}_shift", fn.over(w))


# P26 --------------------------------------------------------------------------------
def record_id(df: DataFrame, name: str, order_by, start: int = 1, partition_by=(), **kw) -> DataFrame:
    """Contiguous ids ``start, start+1, ...`` in the given (total) order.

    Uses the blocked scan: each order range is numbered in its own task and
    offset by the counts of the ranges before it; there is never one global
    single-partition window.
    """
    res = row_number(df, order_by, partition_by, out=name, **kw)
    return res.withColumn(name, F.col(name) + F.lit(start - 1)) if start != 1 else res


# W9 ---------------------------------------------------------------------------------
def linear_recurrence(df: DataFrame, order_by, a: str, b: str, out: str, partition_by=(), x0: float = 0.0,
                      blocks: int | None = None) -> DataFrame:
    """Multi-row formula that reads its own previous result: ``x = a*x_prev + b``.

    Covers running balances with rates, exponential smoothing and decay.
    Groups of at most a block's rows are solved whole, many in a task. Each
    (group, block) of a larger one is solved from a zero start, together with its
    transfer factor ``A = prod(a)``; the block transfer maps (one row per block)
    are composed in block order per group, and ``x = A_local * x_in + x_local``
    fixes every row. Task size is bounded by the quantile blocks, not by the size
    of a group. A null ``a`` or ``b`` leaves its group null from there on.
    Give a total order.
    """

    def follow(x, ai, bi):
        return None if x is None or ai is None or bi is None else ai * x + bi

    def then(m, ai, bi):
        return (None, None) if m[0] is None or ai is None or bi is None else (m[0] * ai, ai * m[1] + bi)

    return _recurrence(df, order_by, [a, b], out, partition_by, x0, blocks, follow, (1.0, 0.0), then,
                       lambda x, A, B: None if x is None or A is None else A * x + B,
                       lambda x, A, B: A * x + B)


def _states(df: DataFrame, key: list[str], order: list[Column], inputs: list[str], start, step, names: list[str],
            before: bool = False) -> DataFrame:
    """Add the state after each row (``before``: ahead of it) of a run over each key's rows in order.

    Keys are brought together and sorted by Spark; a task goes through its rows
    once, batch by batch, starting anew at each key, so neither the number of
    keys nor the size of one counts. ``names`` gives the state's columns.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    marked = df.withColumn("__first", F.row_number().over(w) == 1)
    schema = StructType(list(df.schema.fields) + [StructField(n, DoubleType()) for n in names])
    kept, columns, single = df.columns, schema.names, len(names) == 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start
        for batch in batches:
            made = []
            for first, *row in zip(batch.column("__first").to_pylist(), *(batch.column(c).to_pylist() for c in inputs)):
                if first:
                    state = start
                if before:
                    made.append(state)
                state = step(state, *row)
                if not before:
                    made.append(state)
            parts = [made] if single else [list(c) for c in zip(*made)] or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(p, pa.float64()) for p in parts)], names=columns)

    return marked.mapInArrow(run, schema)


def _recurrence(df: DataFrame, order_by, inputs: list[str], out: str, partition_by, x0: float, blocks: int | None, follow,
                identity: tuple, then, at, at_column) -> DataFrame:
    """A recurrence whose runs of rows are maps of the value before them.

    ``follow(x, *inputs)`` is the value after a row; ``then(m, *inputs)`` the map
    ``m`` followed by a row; ``at(x, *m)`` and ``at_column`` apply a map.
    """
    pk = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    spec = _order_spec(order_by)
    cols, order = df.columns, _order_cols(spec)
    df = df.select(*cols, *[F.col(c).cast("double").alias(f"__in{i}") for i, c in enumerate(inputs)])
    inputs = [f"__in{i}" for i in range(len(inputs))]
    n_blocks = default_blocks(df) if blocks is None else blocks
    df = materialize_if_costly(df)
    whole, large = df, None
    if n_blocks > 1 and pk:
        # only groups beyond a block's share of the rows are cut: fewer than there are blocks
        ensure_checkpoint_dir(df.sparkSession)
        sizes = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("__n"))
        share = df.agg((F.count(F.lit(1)) / n_blocks).alias("s")).first()["s"]
        over = sizes.where(F.col("__n") > share).select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(pk)]).checkpoint(eager=True)
        if not over.isEmpty():
            same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(pk)]
            whole, large = (df.join(F.broadcast(over), same, how) for how in ("left_anti", "left_semi"))
    elif n_blocks > 1:
        whole, large = None, df
    blocked = None if large is None else _cut(large, spec, n_blocks)
    if blocked is None:
        return _states(df, pk, order, inputs, x0, follow, [out]).select(*cols, out)
    names = [f"__m{i}" for i in range(len(identity))]
    w = Window.partitionBy(*pk, "__blk").orderBy(*order)
    blocked = blocked.withColumn("__last", F.lead(F.lit(True)).over(w).isNull())
    # read twice (block ends, then every row): run the Python solve once
    local = materialize_if_costly(_states(blocked, [*pk, "__blk"], order, inputs, identity, then, names))
    ends = local.where("__last").select(*pk, "__blk", *names)
    ins = _states(ends, pk, [F.col("__blk")], names, x0, at, ["__xin"], before=True)
    starts = ins.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate([*pk, "__blk"])], "__xin")
    cond = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate([*pk, "__blk"])]
    solved = local.join(starts, cond, "left").select(*cols, at_column(F.col("__xin"), *map(F.col, names)).alias(out))
    if whole is None:
        return solved
    return solved.unionByName(_states(whole, pk, order, inputs, x0, follow, [out]).select(*cols, out))


COEFFICIENT_MAX = 1e150  # beyond it a composed slope is no longer multiplied: the bounds decide


def _then(m: tuple[float, float, float, float], a: float, b: float, lo: float, hi: float) -> tuple[float, float, float, float]:
    """The clamped affine map ``m`` = (A, B, L, H), x -> min(H, max(L, A*x + B)), followed by one more step."""
    A, B, L, H = m
    low, high = (min(hi, max(lo, (a * end if a else 0.0) + b)) for end in (L, H))
    if a < 0:
        low, high = high, low
    if abs(a * A) > COEFFICIENT_MAX:
        return (A, B, low, high) if a > 0 else (-A, -B, low, high)
    return a * A, a * B + b, low, high


def clamped_recurrence(df: DataFrame, order_by, a: str, b: str, out: str, lo: str | float | None = None,
                       hi: str | float | None = None, partition_by=(), x0: float = 0.0, blocks: int | None = None) -> DataFrame:
    """Multi-row formula with bounds: ``x = min(hi, max(lo, a*x_prev + b))``.

    Stock that stops at zero, capped balances, throttled counters. ``a`` and
    ``b`` name columns; ``lo`` and ``hi`` are columns, numbers or None. A row
    with a null (or NaN) ``a`` or ``b`` carries the previous value on; a null
    bound is no bound; where ``lo`` exceeds ``hi``, ``hi`` holds.

    Clamped affine maps are closed under composition: a run of rows is one map
    ``x -> min(H, max(L, A*x + B))``. Groups of at most a block's rows are
    followed row by row. Each (group, block) of a larger one composes its rows
    from the identity, the blocks' maps are composed in order per group (one row
    a block), and every row applies its map to its block's start. Task size is
    bounded by the blocks, not by the size of a group. Slopes composed beyond
    1e150 stay there (what is left between the bounds is decided by them).
    Give a total order.
    """
    inf = float("inf")
    bound = lambda v, none: F.lit(none) if v is None else F.col(v).cast("double") if isinstance(v, str) else F.lit(float(v))
    bounded = df.withColumns({"__lo": F.coalesce(F.nanvl(bound(lo, -inf), F.lit(-inf)), F.lit(-inf)),
                              "__hi": F.coalesce(F.nanvl(bound(hi, inf), F.lit(inf)), F.lit(inf))})

    def known(ai, bi):
        return ai is not None and bi is not None and ai == ai and bi == bi

    def follow(x, ai, bi, low, high):
        return min(high, max(low, (ai * x if ai else 0.0) + bi)) if known(ai, bi) else x

    def then(m, ai, bi, low, high):
        return _then(m, ai, bi, low, high) if known(ai, bi) else m

    r = _recurrence(bounded, order_by, [a, b, "__lo", "__hi"], out, partition_by, x0, blocks, follow, (1.0, 0.0, -inf, inf), then,
                    lambda x, A, B, L, H: min(H, max(L, A * x + B)),
                    lambda x, A, B, L, H: F.least(H, F.greatest(L, A * x + B)))
    return r.drop("__lo", "__hi")
