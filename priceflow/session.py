"""Spark session helpers.

The settings here are the ones the pipeline depends on; cluster-wide knobs
(executor memory, shuffle service, checkpoint folder) belong to the cluster.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Spark settings the pipeline expects; every one is safe at any scale.
PIPELINE_CONF = {
    # AQE re-plans joins and coalesces or splits skewed shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The HTML rows are large; keep scan splits at a size a task can hold.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    # The per-site CASE projections generate long methods; above 8000 bytes
    # the JVM will not JIT-compile them, so let Spark split such stages.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(master: str | None = None, app: str = "priceflow",
              shuffle_partitions: int | None = None, driver_memory: str = "12g") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        # local mode: the driver JVM is the only executor
        builder = builder.master(master).config("spark.driver.memory", driver_memory)
    for key, value in PIPELINE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this names shared storage and must be set.  Only a local
    session without it (tests) gets a private folder: there every task sees
    the driver's disk.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="priceflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    context.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A location under the checkpoint folder, for tables that cut lineage."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)
