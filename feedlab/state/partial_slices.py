"""Daily statistics as partial sums that batches are merged into.

A day's state has one row for each user, demographics, kind of contribution and counterparty, however many rows
of the logs went into it. A batch reads its own rows and the state of the days it touches, and nothing else.

Every day has two slots. A batch reads the newest version before its own number and writes to the other slot, so
a batch that runs again, after a failure anywhere, finds what it read the first time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlab.functions.clock import PARTITION
from feedlab.operators import slices

SCHEMA = f"""user_id BIGINT, os STRING, gender INT, age INT, kind STRING, other BIGINT, views BIGINT, likes BIGINT,
             messages BIGINT, version BIGINT, {PARTITION} DATE, slot INT"""


def create(spark: SparkSession, path: str) -> None:
    """An empty state, unless there is one."""
    spark.createDataFrame([], SCHEMA).write.mode("ignore").partitionBy(PARTITION, "slot").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def newest(state: DataFrame, before: int | None = None) -> list:
    """event_date, slot of the newest version of every day in ``state``: a row a day."""
    if before is not None:
        state = state.filter(F.col("version") < before)
    return state.groupBy(PARTITION).agg(F.max_by("slot", "version").alias("slot")).collect()


def _of(state: DataFrame, days: list) -> DataFrame:
    """The rows of the given days and slots; other folders are not opened."""
    wanted = F.lit(False)
    for slot in (0, 1):
        dates = [d[PARTITION] for d in days if d["slot"] == slot]
        if dates:
            wanted = wanted | (F.col(PARTITION).isin(dates) & (F.col("slot") == slot))
    return state.filter(wanted)


def merge(rows: DataFrame, path: str, version: int) -> DataFrame:
    """Add contributions (``slices.contributions``) to the state and return that of the days they touch.

    The driver holds a date and a slot for each touched day.
    """
    spark = rows.sparkSession
    state = stored(spark, path)
    days = [r[PARTITION] for r in rows.select(PARTITION).distinct().collect()]
    old = newest(state.filter(F.col(PARTITION).isin(days)), version)
    taken = {d[PARTITION]: d["slot"] for d in old}
    target = [{PARTITION: d, "slot": 1 - taken.get(d, 1)} for d in days]
    columns = [*slices.USER_DAY, "kind", "other", *slices.ADDED]
    both = slices.merged(rows.select(columns).unionByName(_of(state, old).select(columns)))
    ones = [d[PARTITION] for d in target if d["slot"] == 1]
    (both.withColumn("version", F.lit(version).cast("long"))
     .withColumn("slot", F.col(PARTITION).isin(ones).cast("int")).hint("rebalance", PARTITION)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION, "slot").parquet(path))
    return _of(stored(spark, path), target)
