"""Sort, limit, top-k, sample and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .window import _order_cols, _order_spec, materialize_if_costly, running


def sort(df: DataFrame, columns) -> DataFrame:
    """Sort by ``[(column, ascending), ...]`` (names alone mean ascending).

    A global sort is a range-partitioned shuffle; only use it where the
    order is the result (a write or a report), not as an input to other steps.
    """
    return df.orderBy(*_order_cols(_order_spec(columns)))


def limit(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def top_k(df: DataFrame, order_by, k: int) -> DataFrame:
    """ORDER BY ... LIMIT k: planned as TakeOrderedAndProject (per-task top-k, then merge)."""
    return df.orderBy(*_order_cols(_order_spec(order_by))).limit(k)


def top_k_per_group(df: DataFrame, by, order_by, k: int, out: str | None = None) -> DataFrame:
    """First ``k`` rows per group in order.

    ``row_number() <= k`` is planned with a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most ``k`` rows per group.
    """
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(*_order_cols(_order_spec(order_by)))
    res = df.withColumn(out or "__rn", F.row_number().over(w)).filter(F.col(out or "__rn") <= k)
    return res if out else res.drop("__rn")


def sample_fraction(df: DataFrame, fraction: float, key_columns, seed: int = 42) -> DataFrame:
    """Repeatable random sample: a row is kept when its key's 64-bit hash is below the fraction.

    Same rows for the same seed on any cluster size (no dependence on partitioning).
    """
    if fraction >= 1:
        return df
    cols = [key_columns] if isinstance(key_columns, str) else list(key_columns)
    h = F.xxhash64(*[F.col(c) for c in cols], F.lit(seed))
    return df.filter(h < F.lit(int(fraction * 2.0**64) - 2**63))


def sample_first(df: DataFrame, n: int, order_by) -> DataFrame:
    """First N records in a given order."""
    return top_k(df, order_by, n)


def sample_per_group(df: DataFrame, by, n: int, order_by) -> DataFrame:
    """First N records of each group."""
    return top_k_per_group(df, by, order_by, n)


def distinct(df: DataFrame, keys=None) -> DataFrame:
    """Distinct rows, or distinct combinations of ``keys`` (other columns dropped)."""
    if keys is None:
        return df.distinct()
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.select(*keys).distinct()


def unique(df: DataFrame, keys, order_by, **kw) -> tuple[DataFrame, DataFrame]:
    """Unique tool: (first row per key in order, all other rows).

    Rows are numbered per key with the blocked scan (a key holding a third of
    the rows is spread over many tasks), and the numbering is materialized
    once so both outputs come from the same numbering even among ties.
    When only the first rows are needed, :func:`top_k_per_group` with k=1 is
    cheaper (partial group limit before the shuffle).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    numbered = materialize_if_costly(running(df, order_by, {"__rn": ("row_number", None)}, keys, **kw))
    first = numbered.filter(F.col("__rn") == 1).drop("__rn")
    dups = numbered.filter(F.col("__rn") > 1).drop("__rn")
    return first, dups


def drop_duplicates(df: DataFrame, keys=None) -> DataFrame:
    """pandas ``drop_duplicates``: any one row per key (Spark's aggregate-based plan)."""
    return df.dropDuplicates(None if keys is None else ([keys] if isinstance(keys, str) else list(keys)))
