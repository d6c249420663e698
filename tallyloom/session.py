"""Session settings, and the shared folder for tables that a run writes on the way."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Checkpoint files go when nothing refers to them. Adaptive execution does the sizing: it merges small shuffle partitions, splits
# those of a hot key even where that costs one more shuffle, and hashes instead
# of sorting for a join whose every measured partition is under 64 MB.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# For inputs of many terabytes: fewer, larger scan tasks, and enough shuffle
# partitions to keep each in memory. Adaptive execution merges the surplus.
LARGE_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def build_session(
    name: str = "tallyloom", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that all executors can reach.

    It lies under ``spark.checkpoint.dir``, which must be set under any master: no
    other folder is known to survive an executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/tallyloom-{uuid.uuid4().hex}"
