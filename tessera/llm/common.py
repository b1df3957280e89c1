"""Shared helpers: text buffers of Arrow batches, scratch tables in the shared folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-llm/{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_clean)
    _SCRATCH.append((spark, path))
    return path


def _clean() -> None:
    for spark, path in _SCRATCH:
        try:
            if "/" not in path:
                spark.sql(f"DROP TABLE IF EXISTS {path}")
                continue
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # noqa: BLE001 - the session may be gone; leftovers are only scratch
            return


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    Cuts the lineage: a lost executor rereads files instead of recomputing.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Write ``df`` as a table bucketed by ``key`` and read it back.

    Grouping or joining it on ``key`` then needs no further shuffle of it.
    """
    spark = df.sparkSession
    table = f"tessera_{name}_{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_clean)
    _SCRATCH.append((spark, table))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("compression", "zstd").bucketBy(n, key).saveAsTable(table)
    return spark.table(table)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary array; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        wide = np.int32
    else:
        wide = np.int64
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, target: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows holding about ``target`` text bytes each, with buffer and offsets."""
    for batch in batches:
        data, at = text_buffer(batch.column(column))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = int(np.searchsorted(at, at[lo] + target, "right")) - 1
            hi = min(n, max(lo + 1, hi))
            yield batch.slice(lo, hi - lo), data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
            lo = hi


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with the rows of each key in one partition, for a step in Python that relies on it.

    A plain ``repartition`` on the keys is left out after a join on them, and
    adaptive execution may turn that join into a broadcast whose probe side is
    read as it was written. A hash of the keys is always dealt anew.
    """
    return df.repartition(F.xxhash64(*keys))


def crc_mod(column: str, mod: int):
    """crc32 of the value's decimal text modulo ``mod`` (null for a null value)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % mod


def text_id(text: str) -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select([df[f"`{c}`"] for c in df.columns if c.lower() not in taken])
