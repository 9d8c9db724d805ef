"""Session helpers.

The library never builds its own session inside a job: the caller (driver, bench,
tests) owns it. ``configure`` only pins the settings the semantics depend on.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the results depend on. UTC: ``DATE(ts)`` of a billing instant is a UTC date.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that only affect speed; applied when the caller did not choose otherwise.
_TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin UTC and enable AQE on an existing session (idempotent)."""
    for key, value in _REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in _TUNING.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir`` (or the context's setting). Only when nothing is
    set and driver and executors are one process -- as in local tests -- a fresh folder is
    created and registered; on a cluster a machine-local folder would lose data, so that
    is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return local


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    """Session for tests and the local bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # no checksum file beside every file: without Hadoop's native library each one created forks a chmod
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
