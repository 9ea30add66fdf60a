"""New users and retention.

A user's first day and the set of days they came back on are fixed-width state:
the minimum date and a bit per day. One scan and one shuffle on ``user_id``
replace the join of first days with distinct active days, and a user with very
many rows is one small row per task before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlab.functions import clock
from feedlab.functions.clock import day
from feedlab.functions.ratios import ratio

BITS = 62


def user_active_days(feed: DataFrame) -> DataFrame:
    """Distinct (user, date) pairs."""
    return feed.select("user_id", day().alias("date")).distinct()


def arrivals(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    """New users of yesterday, and first-day retention of those of the day before; one row.

    Rows after yesterday change neither, so they are not read.
    """
    start, back = (F.lit(clock.days_before(as_of, n)) for n in (2, 1))
    users = (clock.on_days(feed, None, clock.days_before(as_of, 1))
             .filter(F.col("user_id").isNotNull()).groupBy("user_id")
             .agg(F.min(day()).alias("first"), F.max(day()).alias("last")))
    cohort = F.col("first") == start
    return users.agg(
        F.count_if(F.col("first") == back).alias("new_users"),
        start.alias("start_date"),
        F.count_if(cohort).alias("cohort_size"),
        F.count_if(cohort & (F.col("last") == back)).alias("returned"),
    ).withColumn("retention_pct", ratio("returned", "cohort_size") * 100)


def new_users(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Number of users whose first day is the day before ``as_of``."""
    return arrivals(feed, as_of).select("new_users")


def retention_day1(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Share of users first seen two days before ``as_of`` who came back the next day."""
    return arrivals(feed, as_of).select("start_date", "cohort_size", "returned", "retention_pct")


def _came_on(word: int, offset: Column) -> Column:
    bit = offset - word * BITS
    return F.bit_or(F.when(bit.between(0, BITS - 1),
                           F.call_function("shiftleft", F.lit(1).cast("long"), bit)))


def _offsets(word: int, horizon: int) -> Column:
    """Day offsets whose bit is set in one word."""
    bits = F.coalesce(F.col(f"days_{word}"), F.lit(0).cast("long"))
    possible = F.sequence(F.lit(word * BITS), F.lit(min(horizon, (word + 1) * BITS - 1)))
    return F.filter(possible, lambda d: F.getbit(bits, d - word * BITS) == 1)


def cohort_days(feed: DataFrame, start: dt.date, last: dt.date) -> DataFrame:
    """For users first seen on ``start``: how many came on each day up to ``last``."""
    horizon = (last - start).days
    words = range(horizon // BITS + 1)
    offset = F.datediff(day(), F.lit(start))
    users = (clock.on_days(feed, None, last).filter(F.col("user_id").isNotNull())
             .groupBy("user_id")
             .agg(F.min(day()).alias("start_date"),
                  *[_came_on(w, offset).alias(f"days_{w}") for w in words])
             .filter(F.col("start_date") == F.lit(start)))
    came = F.flatten(F.array(*[_offsets(w, horizon) for w in words]))
    return (users.select("start_date", F.explode(came).alias("offset"))
            .groupBy("start_date", "offset").agg(F.count(F.lit(1)).alias("users"))
            .select("start_date", F.date_add("start_date", F.col("offset")).alias("date"), "users"))


def retention_curve(feed: DataFrame, as_of: dt.date | str, age: int = 28) -> DataFrame:
    """Users per day of the cohort that started ``age`` days before ``as_of``."""
    cohort = Window.partitionBy("start_date")  # at most age + 1 rows
    return (cohort_days(feed, clock.days_before(as_of, age), clock.as_date(as_of))
            .withColumn("cohort_size", F.max("users").over(cohort))
            .withColumn("retention_rate", ratio("users", "cohort_size")))
