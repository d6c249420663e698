"""Intermediate results that survive a lost executor, and column names that clash with nothing."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINTS = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a local session without one has its own in the warehouse."""
    folder = spark.conf.get(CHECKPOINTS, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINTS} to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    return folder.rstrip("/")


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let checkpoints go to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Within the block, the shuffle files of a finished action go at once."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stored(frame: DataFrame) -> DataFrame:
    """The frame's rows, computed once and written to the shared checkpoint folder.

    Spark removes the files when the returned frame is no longer referenced and
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    spark = frame.sparkSession
    ensure_checkpoints(spark)
    with _shuffles_dropped(spark):
        # The setting counts for plans that are made while it holds.
        return frame.select("*").checkpoint()


@contextmanager
def written(frame: DataFrame):
    """The frame's rows as Parquet in the shared checkpoint folder, for as long as the block lasts.

    Parquet is several times smaller than a checkpoint; what the block returns must not
    read the rows any more.
    """
    spark = frame.sparkSession
    ensure_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        frame.select("*").write.parquet(path)
    try:
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of the frame has it."""
    taken = {column.lower() for column in frame.columns}
    chosen = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        chosen.append(name)
    return chosen
