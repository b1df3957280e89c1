"""Session helpers: one place for the configuration every job relies on.

On a cluster the session already exists and carries the site's settings; the
helpers here only fill in what is missing (tests, the bench, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tessera job assumes. AQE re-plans joins from measured sizes
# (broadcast only when the materialised side is small) and splits skewed
# partitions; the time zone makes timestamp_ntz arithmetic repeatable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the site (a shared, durable folder) and is only
    read here. Only when it is unset (local tests) is a scratch folder made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings above on an existing session when unset."""
    for k, v in DEFAULT_CONF.items():
        if not k.startswith("spark.sql."):
            continue
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark
