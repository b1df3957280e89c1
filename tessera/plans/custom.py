"""Custom steps (UX1-UX3): the escape hatches for logic Spark has no operator for.

UX1: any ``DataFrame -> DataFrame`` callable is a step (``df.transform``).
UX2: a vectorised column function (``pandas_udf``, Arrow batches).
UX3: a grouped map (``applyInPandas``), over whole groups or, for groups of any
size, over a stream of batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType


def step(df: DataFrame, fn: Callable[[DataFrame], DataFrame], *args, **kwargs) -> DataFrame:
    """UX1: apply a custom step; it must stay lazy (no actions inside)."""
    return df.transform(fn, *args, **kwargs)


def vectorized(fn: Callable[..., pd.Series], return_type: DataType) -> Callable[..., Column]:
    """UX2: wrap a pandas Series function as a column function (Arrow-batched)."""
    return F.pandas_udf(fn, return_type)


def grouped_map(df: DataFrame, by, fn: Callable[[pd.DataFrame], pd.DataFrame], schema,
                max_group_rows: int | None = None) -> DataFrame:
    """UX3: run ``fn`` on each group as one pandas DataFrame.

    A task holds a whole group, so this is for groups of a bounded size;
    ``max_group_rows`` counts the largest one first and refuses more. Groups
    of any size go through :func:`grouped_stream`.
    """
    keys = [by] if isinstance(by, str) else list(by)
    if max_group_rows is not None:
        biggest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if biggest > max_group_rows:
            raise ValueError(f"largest group has {biggest} rows, above max_group_rows={max_group_rows}")
    return df.groupBy(*keys).applyInPandas(fn, schema)


def grouped_stream(df: DataFrame, by, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema,
                   order_by=(), salts: int = 1, merge: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None,
                   many: Callable[[pa.Table], pa.Table] | None = None) -> DataFrame:
    """UX3 for groups of any size: ``fn`` gets a group's rows in batches and yields rows.

    Memory holds one batch, whatever the size of the group. With ``order_by``
    the batches come in that order. With ``salts`` a group's rows are dealt to
    so many tasks, each of which runs ``fn`` on its part; ``merge`` then runs in
    the same way over what the parts of a group yielded (which has the key columns).

    A call of ``fn`` costs milliseconds a group, however small. ``many`` returns
    what ``fn`` yields for an Arrow table of many whole groups (in key order, rows
    of a group in ``order_by``): groups of at most a batch go there, so a task
    makes one call a batch; larger groups still stream through ``fn``.
    """
    keys = [by] if isinstance(by, str) else list(by)
    if many is not None:
        if salts > 1:
            raise ValueError("many takes whole groups, not parts of them")
        return _small_and_large(df, keys, fn, schema, list(order_by), many)

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from fn(frames)

    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from merge(frames)

    def unsalted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from fn(f.drop(columns="__salt") for f in frames)

    if salts > 1 and (merge is None or order_by):
        raise ValueError("parts of a group need a merge function and have no common order")
    placed = df
    if order_by:
        # the sort by key that grouping needs is kept by the longer one
        placed = df.repartition(*keys).sortWithinPartitions(*keys, *order_by)
    if salts == 1:
        return placed.groupBy(*keys).applyInPandas(batches, schema)
    # rows are dealt in turn within each task, so identical rows spread too
    salted = df.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    parts = salted.groupBy(*keys, "__salt").applyInPandas(unsalted, schema)
    return parts.groupBy(*keys).applyInPandas(merged, schema)


def _small_and_large(df: DataFrame, keys: list[str], fn, schema, order_by: list, many: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """:func:`grouped_stream` with groups of at most a batch in tables of many groups."""
    rows = int(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    rows = rows if rows > 0 else 10_000
    group = Window.partitionBy(*keys)
    sized = df.withColumns({"__n": F.count(F.lit(1)).over(group),
                            "__first": F.row_number().over(group.orderBy(*(order_by or keys))) == 1})
    large = grouped_stream(sized.where(F.col("__n") > rows).drop("__n", "__first"), keys, fn, schema, order_by)
    types = to_arrow_schema(large.schema)

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last group of a batch may go on in the next one
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            firsts = t["__first"].to_numpy().nonzero()[0]
            cut = int(firsts[-1])
            held = t.slice(cut).combine_chunks()
            if cut:
                yield from done(t.slice(0, cut))
        if held is not None and held.num_rows:
            yield from done(held)

    def done(t: pa.Table) -> Iterator[pa.RecordBatch]:
        return iter(many(t.drop_columns(["__first"])).select(types.names).cast(types).to_batches())

    small = sized.where(F.col("__n") <= rows).drop("__n")
    return small.mapInArrow(tables, large.schema).unionByName(large)
