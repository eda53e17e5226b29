"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


# Sizing for a large cluster (e.g. ~100 TB of parquet over ~1000 executors):
# 256 MB scan splits (~400k tasks per full scan), AQE starting from a large
# shuffle partition count and coalescing to ~256 MB per reducer, and skew
# splitting above 5x the median partition. Broadcasts stay size-checked by
# AQE's default threshold; the operators broadcast explicitly only tables of
# a known bound.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def get_session(master: str | None = None, app: str = "lakemart",
                shuffle_partitions: int | None = None, cluster: bool = False,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings the operators assume.

    UTC session time zone (the test parquet holds ``timestamp_ntz``), ANSI
    mode (Spark 4 default) so bad casts raise unless ``try_*`` is used, AQE
    with partition coalescing and skew-join splitting, and no web UI.
    ``cluster=True`` adds ``CLUSTER_CONF`` (partition sizing for large data).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.ui.enabled", "false"))
    if cluster:
        for k, v in CLUSTER_CONF.items():
            b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A cluster names it; only where it is unset and the master is local (as in
    tests) do we create one under the local temp folder. Elsewhere an unset
    folder is an error: executors cannot read the driver's disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server side names the folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="lakemart-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder beneath the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
