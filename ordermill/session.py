"""Session construction and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every ordermill job relies on. UTC keeps date_trunc / to_date on
# TIMESTAMP_NTZ columns free of zone shifts; AQE coalesces small shuffle
# partitions and splits skewed join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "ordermill",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the ordermill defaults (caller's conf wins)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:  # classic sessions only
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:
        pass
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    On a cluster the setting names a folder every executor can reach, so
    stream checkpoints and lineage cuts survive the loss of any executor.
    Only when it is unset in local mode (tests) do we create one under the
    system temp folder, record it in the session and remove it at exit; on a
    cluster an unset folder is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ordermill-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    try:  # classic sessions only; Spark Connect has no SparkContext
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(os.path.join(base, "rdd"))
    except Exception:
        pass
    return os.path.join(base, *parts, uuid.uuid4().hex) if parts else base


# Starting point for a large cluster (~100 TB of input, ~1000 executors).
# Shuffles start wide and AQE coalesces them to ~256 MB partitions, so a
# partition fits an executor core's memory at any scale; scans split files
# at 256 MB; a join partition over 5x the median and 1 GB is split by AQE.
# Broadcasts: a plan-time decision rests on the on-disk (compressed) size
# estimate, so it keeps Spark's small 10 MB default; the larger 64 MB
# applies only to AQE's run-time decision, which uses measured shuffle
# bytes. Merge with ``build_session(conf=CLUSTER_CONF)``.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.parquet.filterPushdown": "true",
}
