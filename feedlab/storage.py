"""The shared folder, and cutting lineage through it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    own = tempfile.mkdtemp(prefix="feedlab-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder nobody else writes to."""
    return f"{shared_dir(spark)}/feedlab/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in reliable storage.

    For frames that a later plan reads more than once, so that the event log
    behind them is scanned a single time and lost executors cost no re-scan.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def spread(spark: SparkSession) -> int:
    """Partition count for compute-heavy stages over frames small in bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               spark.sparkContext.defaultParallelism)
