"""Activity as bitmaps: a day's users are bits at their numbers, in buckets of 32,768 users.

Cohorts and days stored once answer every later question about who came when: an intersection gives the users
of any cohort on any day, a union the different users of any period, without reading the log again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedlab.functions import clock
from feedlab.functions.clock import day
from feedlab.state import first_seen

SCHEMA = "bucket BIGINT, bits BINARY, date DATE"


def _bits(users: DataFrame, key: str) -> DataFrame:
    """A bitmap for each ``key`` and bucket of user numbers; sets of bits merge before the shuffle."""
    return (users.groupBy(F.col(key).alias("date"), F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))


def write_activity(log: DataFrame, users: DataFrame, path: str, first: dt.date | str | None = None,
                   last: dt.date | str | None = None) -> None:
    """Store the bitmaps of the days from ``first`` to ``last`` (all without), replacing those days.

    ``users`` is the table of first days, which gives the numbers; a user who is not in it is left out.
    """
    if last is not None:
        log = clock.on_days(log, clock.as_date(first) if first else None, clock.as_date(last))
    days = log.select("user_id", day().alias("day")).filter(F.col("day").isNotNull()).distinct()
    (_bits(days.join(users.select("user_id", "number"), "user_id"), "day").hint("rebalance", "date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path))


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def cohorts(users: DataFrame) -> DataFrame:
    """Bitmaps of the users first seen on each day; ``date`` is that day."""
    return _bits(users.filter(F.col("user_id").isNotNull()), first_seen.KEY)


def _counted(both: DataFrame, by: list[str], merge: Column) -> DataFrame:
    """Bits set after ``merge`` of the bitmaps of each bucket, per ``by``."""
    return (both.groupBy(*by, "bucket").agg(F.bitmap_count(merge).alias("users"))
            .groupBy(*by).agg(F.sum("users").alias("users")))


def matrix(cohort_bits: DataFrame, activity: DataFrame) -> DataFrame:
    """first_day, date, users: how many of each cohort came on each day from its first on, where anyone did.

    Cohorts and days meet by bucket, so both bitmaps of a pair are merged in the task that joined them.
    """
    starts = cohort_bits.select(F.col("date").alias("first_day"), "bucket", F.col("bits").alias("mine"))
    pairs = (activity.join(starts, "bucket").filter(F.col("date") >= F.col("first_day"))
             .select("first_day", "date", "bucket", F.explode(F.array("bits", "mine")).alias("bits")))
    return _counted(pairs, ["first_day", "date"], F.bitmap_and_agg("bits")).filter(F.col("users") > 0)


def distinct_users(activity: DataFrame, period: Column) -> DataFrame:
    """period, users: the different users of all days that fall into each ``period`` (of ``date``)."""
    return _counted(activity.withColumn("period", period), ["period"], F.bitmap_or_agg("bits"))
