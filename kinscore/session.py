"""Spark session helpers.

Cluster settings are the cluster's business: library code only *reads* the session. The
helpers here fill in defaults where a setting is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a large run wants (documented in README); local sessions get them by default.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that costs an extra shuffle: the fact ⋈ items
    # joins feed aggregates keyed by item_id, which would otherwise forbid the split
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # let AQE coalesce / re-plan the output of persisted intermediates too
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "kinscore") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.sparkContext.getCheckpointDir()
    return d or spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when none is set (local runs, tests)
    create a private scratch folder."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if not spark.sparkContext.master.startswith("local"):
        # a folder on the driver's disk is not visible to executors: require the shared one
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for cluster runs")
    local = tempfile.mkdtemp(prefix="kinscore-ckpt-", dir=os.environ.get("KINSCORE_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local
