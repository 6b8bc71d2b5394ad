"""Session settings and the shared folder for checkpoints and snapshots."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings every operator is written for. All can be set on a live session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A join whose key holds a large share of the rows is split at run time, also where
    # the split costs one more shuffle further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streaming state that outgrows the memory stays on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Shuffles of the warehouse queries: partitions to start with at least, and the bytes up to which
# they are joined; keys and sums compress well and take many times as much in memory. File splits are
# bounded too, as a task may group nearly all the rows of its split.
START_PARTITIONS = 600
PARTITION_BYTES = "8m"
SPLIT_BYTES = "16m"


def spread(spark: SparkSession) -> SparkSession:
    """Start shuffles with many partitions, which are joined by their bytes at run time.

    What one task sorts or groups then depends on the advisory size of a partition and no longer on
    the input divided by a fixed number of partitions. What was set by hand stays.
    """
    tune(spark)
    start = max(int(spark.conf.get("spark.sql.shuffle.partitions")), START_PARTITIONS)
    for key, value in (("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start)),
                       ("spark.sql.adaptive.advisoryPartitionSizeInBytes", PARTITION_BYTES),
                       ("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Where it is unset, runs on local threads get a temporary folder; a cluster has no folder
    that could be guessed, so the setting is required there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="stockloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def ensure_checkpoints(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/stockloom/{uuid.uuid4().hex}/{name}"
