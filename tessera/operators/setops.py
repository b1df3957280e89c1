"""Stacking inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: list[DataFrame]) -> DataFrame:
    """Stack by column name; columns missing from an input are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_by_position(frames: list[DataFrame]) -> DataFrame:
    """Stack by position; names come from the first input."""
    return reduce(lambda a, b: a.union(b), frames)


def stack_with_origin(frames: dict[str, DataFrame], origin: str = "source") -> DataFrame:
    """DATA step ``set a b`` with ``in=``: stacked rows plus the name of their input."""
    return stack([df.withColumn(origin, F.lit(name)) for name, df in frames.items()])


def append(base: DataFrame, new: DataFrame, force: bool = False) -> DataFrame:
    """PROC APPEND: rows of ``new`` after ``base``, in base's columns.

    Without ``force`` both must have the same columns; with it, extra columns
    of ``new`` are dropped and missing ones are null.
    """
    if not force and sorted(base.columns) != sorted(new.columns):
        raise ValueError("append: column sets differ (use force=True)")
    cols = [F.col(c) if c in new.columns else F.lit(None).cast(t).alias(c) for c, t in base.dtypes]
    return base.unionByName(new.select(*cols))
