"""The daily job over stored state: one day of the logs goes in, reports on any day read the state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlab.functions import clock
from feedlab.plans import daily_load
from feedlab.state import bitmaps, first_seen, sketches


def create(spark: SparkSession, root: str) -> None:
    """The folders of an empty state."""
    first_seen.create(spark, f"{root}/first_seen")


def add_day(feed: DataFrame, messages: DataFrame, as_of: dt.date | str, root: str) -> None:
    """Bring the day before ``as_of`` into every part of the state; running a day again replaces it.

    Reads that day of both logs and the ids of known users. First days come first, as they number the users
    whose bits the day's bitmaps are.
    """
    spark, on = feed.sparkSession, clock.days_before(as_of, 1)
    day = clock.on_days(feed, on, on)
    first_seen.merge_day(feed, f"{root}/first_seen", on)
    bitmaps.write_activity(feed, first_seen.read(spark, f"{root}/first_seen"), f"{root}/activity", on, on)
    sketches.write_buckets(day, f"{root}/buckets")
    daily_load.load_day(feed, messages, as_of, f"{root}/slices")


def arrivals(spark: SparkSession, root: str, as_of: dt.date | str) -> DataFrame:
    """New users of yesterday and first-day retention of those of the day before, from the state alone; one row.

    Opens two folders of first days and yesterday's bitmaps.
    """
    start, back = (clock.days_before(as_of, n) for n in (2, 1))
    table = first_seen.stored(spark, f"{root}/first_seen")
    cohort = table.filter(F.col(first_seen.KEY) == F.lit(start))
    came = bitmaps.read_activity(spark, f"{root}/activity").filter(F.col("date") == F.lit(back))
    returned = (bitmaps.matrix(bitmaps.cohorts(cohort), came)
                .agg(F.coalesce(F.sum("users"), F.lit(0).cast("long")).alias("returned")))
    return (first_seen.new_users(table, as_of)
            .crossJoin(first_seen.cohort_size(table, start))
            .crossJoin(returned)  # one row each
            .select("new_users", F.lit(start).alias("start_date"), "cohort_size", "returned",
                    (F.try_divide(F.col("returned").cast("double"), F.col("cohort_size")) * 100).alias("retention_pct")))
