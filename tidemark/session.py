"""Session settings the operators rely on, and the shared scratch location."""

from __future__ import annotations

import os
import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job needs for correct results: timestamps without zone shift,
# ANSI arithmetic, and runtime re-planning (AQE) so that shuffle partition
# counts, skewed joins and small join sides are handled from measured sizes.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # partition folders such as date=2024-01-05 stay text, as written
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


# Settings for large clusters (``build_session(cluster=True)``): post-shuffle
# partitions are sized by bytes rather than spread for parallelism, files are
# read in 256 MB splits, and the Z-order / compaction writes aim at the same
# size. Left off for local runs, where parallelism matters more than size.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, cluster: bool = False,
                  event_log_dir: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings of ``REQUIRED_CONF``.

    ``shuffle_partitions`` is the initial partition count before AQE coalesces;
    on a cluster size it so a partition is ~128-256 MB at the largest stage
    (100 TB of shuffle input: ~400k-800k), and pass ``cluster=True``.
    ``event_log_dir`` turns on Spark's event log there (stage and task times
    without the web UI, which stays off).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(REQUIRED_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    if cluster:
        conf.update(CLUSTER_CONF)
    if event_log_dir:
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log_dir})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of ``REQUIRED_CONF`` to a live session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for staged tables, stream checkpoints and lineage cuts.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only when it is
    unset on a local master - tests - a scratch folder is created and registered;
    elsewhere that is an error, for executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_table(spark: SparkSession, name: str) -> str:
    """A scratch path that is removed when the driver ends."""
    path = scratch_path(spark, name)

    def remove() -> None:
        if spark.sparkContext._jsc is not None:
            remove_path(spark, path)
    atexit.register(remove)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system of the path (any scheme)."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there, through its Hadoop file system."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)
