"""Running the narrow operators on a stream.

The prepare operators, filters and stream-static joins add no actions, so
the same functions apply to a streaming DataFrame. This module wires a file
source to a prepared sink with a checkpoint in the shared folder.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources.io import scratch_path


def read_file_stream(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet",
                     glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def run_available(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], sink_path: str,
                  checkpoint: str | None = None, fmt: str = "parquet") -> str:
    """Apply ``transform`` to everything available now, append to ``sink_path``, stop.

    Re-running continues from the checkpoint (exactly-once file sink).
    """
    spark = stream.sparkSession
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")
    q = (transform(stream).writeStream.format(fmt).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start(sink_path))
    q.awaitTermination()
    return sink_path
