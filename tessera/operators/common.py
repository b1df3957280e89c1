"""Small helpers shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add every column of a one-row aggregate to each row of ``df``.

    Planned as one scalar subquery (computed once, inlined as a value), so no
    join and no all-pairs product appears in the plan.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("__s")).scalar()
    return df.withColumn("__s", packed).select(*df.columns, *[F.col(f"__s.{c}").alias(c) for c in cols])


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again.

    Like a checkpoint it cuts the lineage; columns are encoded, so repeated
    values take little room, and the planner knows the size when it chooses joins.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
