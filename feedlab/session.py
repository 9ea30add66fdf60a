"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # compact user-level frames shuffle into many small blocks; let AQE merge them
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # hash instead of sort for joins whose partitions all turn out small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # keeps streaming state off the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # drop checkpoint files once nothing refers to the frame
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


MB = 1024 * 1024


def sized(cores: int, shuffled_bytes: int) -> dict[str, str]:
    """Settings for a cluster and the bytes the largest shuffle moves.

    Starts from partitions that fit a task's memory, at least three waves of
    tasks, and lets AQE merge the small ones.
    """
    partitions = max(3 * cores, shuffled_bytes // (128 * MB))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{128 * MB}",
        "spark.sql.files.maxPartitionBytes": f"{256 * MB}",
    }


def build(app: str = "feedlab", master: str | None = None, **extra: str) -> SparkSession:
    """Create a session with the settings above; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
