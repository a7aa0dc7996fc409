"""Where written intermediates go: the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a fresh temporary folder only for a local master."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="gablework-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/gablework/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once and read it back.

    For inputs that several passes use: the lineage is cut by files that outlive lost
    executors, and later passes read only the columns they need. Like Spark's own
    checkpoints, the files stay until the shared folder's owner clears it.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A frame written once, one file to a partition, and read back in the same partitions and row order.

    For what depends on how rows are dealt, such as the samples of a forest. Lost executors cost nothing, as
    the files are in the shared folder; Spark removes them with the frame if it is told to clean checkpoints.
    """
    folder, context = shared_folder(df.sparkSession), df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.checkpoint()
