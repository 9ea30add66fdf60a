"""Audience and load metrics of the feed and the messenger."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from feedlab.functions import clock
from feedlab.functions.clock import day
from feedlab.functions.ratios import count_action, is_action, ratio


def _trailing(actions: DataFrame, as_of: dt.date | str, days: int) -> DataFrame:
    """The ``days`` complete days before ``as_of``."""
    return clock.on_days(actions, clock.days_before(as_of, days), clock.days_before(as_of, 1))


def _user_counts(feed: DataFrame, *keys: Column) -> DataFrame:
    """Views, likes and actions per key and user.

    Counting per user first makes the distinct count a plain count one level up
    and collapses a hot user or a hot key before anything is shuffled.
    """
    return feed.groupBy(*keys, "user_id").agg(
        count_action("view").alias("views"),
        count_action("like").alias("likes"))


def _known(column: str) -> Column:
    return F.sum(F.when(F.col("user_id").isNotNull(), F.col(column)))


def daily(feed: DataFrame, as_of: dt.date | str, days: int = 1) -> DataFrame:
    """DAU, views, likes and CTR of each of the ``days`` days before ``as_of``."""
    users = _user_counts(_trailing(feed, as_of, days), day().alias("date"))
    return users.groupBy("date").agg(
        F.count("user_id").alias("dau"),
        F.sum("views").alias("views"),
        F.sum("likes").alias("likes"),
        ratio(_known("likes"), _known("views")).alias("ctr"))


def dau(feed: DataFrame, as_of: dt.date | str, days: int = 7, approximate: bool = False) -> DataFrame:
    """Distinct users per day; ``approximate`` trades exactness for a constant-size state."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return (_trailing(feed, as_of, days).groupBy(day().alias("date"))
            .agg(distinct("user_id").alias("dau")))


def ctr_daily(feed: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """Likes per view of identified users per day."""
    known = F.col("user_id").isNotNull()
    return (_trailing(feed, as_of, days).groupBy(day().alias("date"))
            .agg(ratio(F.count_if(known & is_action("like")),
                       F.count_if(known & is_action("view"))).alias("ctr")))


def dau_by_source(feed: DataFrame, as_of: dt.date | str, days: int = 14,
                  sources: tuple[str, ...] = ("organic", "ads")) -> DataFrame:
    """DAU per acquisition source, from ``days`` days ago up to the running day.

    One column per source, aligned by date; a source without users that day is 0.
    Users of any other source, or of none, are counted under ``other``.
    """
    last = clock.as_date(as_of)
    users = (clock.on_days(feed, clock.days_before(last, days), last)
             .select(day().alias("date"), "source", "user_id").distinct())
    return users.groupBy("date").agg(
        *[F.count(F.when(F.col("source") == s, F.col("user_id"))).alias(s) for s in sources],
        F.count_distinct(F.when(F.coalesce(~F.col("source").isin(list(sources)), F.lit(True)), F.col("user_id")))
        .alias("other"))


def views_per_user(feed: DataFrame, as_of: dt.date | str, days: int = 14,
                   approximate: bool = False) -> DataFrame:
    """Mean and median views per viewing user and day.

    The median reads (views, number of users) pairs: their count per day is at
    most the square root of twice the day's rows, whatever the number of users.
    """
    per_user = (_trailing(feed, as_of, days).filter(is_action("view"))
                .groupBy(day().alias("date"), "user_id").agg(F.count("action").alias("views")))
    if approximate:
        return per_user.groupBy("date").agg(
            F.avg("views").alias("avg_views"),
            F.percentile_approx("views", 0.5).cast("double").alias("median_views"))
    weighted = per_user.groupBy("date", "views").agg(F.count(F.lit(1)).alias("users"))
    return weighted.groupBy("date").agg(
        ratio(F.sum(F.col("views") * F.col("users")), F.sum("users")).alias("avg_views"),
        F.percentile("views", 0.5, F.col("users")).alias("median_views"))


def peak_per_hour(actions: DataFrame, on: dt.date | str, distinct: bool = False) -> DataFrame:
    """Largest number of events in one second, for each hour of a day.

    ``distinct`` counts users instead of events. The day is cut on the raw
    timestamp, so only that day is read.
    """
    counter = F.count_distinct if distinct else F.count
    seconds = (clock.on_days(actions, clock.as_date(on), clock.as_date(on))
               .groupBy(clock.grid("time", clock.SECOND).alias("second"))
               .agg(counter("user_id").alias("users")))
    return (seconds.groupBy(clock.grid("second", clock.HOUR).alias("hour"))
            .agg(F.max("users").alias("peak_users"))
            .orderBy("hour"))


def active_audience(feed: DataFrame, k: int = 10_000) -> DataFrame:
    """Users and actions per user of the ``k`` largest demographic groups."""
    return (feed.groupBy("age", "os", "gender")
            .agg(F.count_distinct("user_id").alias("users"),
                 ratio(F.count("action"), F.count_distinct("user_id")).alias("actions_per_user"))
            .orderBy(F.desc("users"), "age", "os", "gender").limit(k))


def _quarter_hours(actions: DataFrame, since: dt.datetime | None, until: dt.datetime | None) -> DataFrame:
    if since is not None and until is not None:
        actions = clock.on_days(actions, since.date(), until.date())
    if since is not None:
        actions = actions.filter(F.col("time") >= clock.moment(since))
    if until is not None:
        actions = actions.filter(F.col("time") < clock.moment(until))
    return actions.withColumn("ts", clock.grid("time", clock.QUARTER_HOUR))


def _with_labels(buckets: DataFrame) -> DataFrame:
    rest = [c for c in buckets.columns if c != "ts"]
    return buckets.select("ts", day("ts").alias("date"), clock.label("ts", clock.LABEL_HOUR).alias("hm"),
                          *rest)


def feed_15min(feed: DataFrame, since: dt.datetime | None = None,
               until: dt.datetime | None = None) -> DataFrame:
    """Users, views, likes and CTR per quarter of an hour."""
    users = _user_counts(_quarter_hours(feed, since, until), F.col("ts"))
    return _with_labels(users.groupBy("ts").agg(
        F.count("user_id").alias("users_feed"),
        F.coalesce(_known("views"), F.lit(0)).alias("views"),
        F.coalesce(_known("likes"), F.lit(0)).alias("likes"),
        ratio(_known("likes"), _known("views")).alias("ctr")))


def message_15min(messages: DataFrame, since: dt.datetime | None = None,
                  until: dt.datetime | None = None) -> DataFrame:
    """Senders and messages per quarter of an hour."""
    users = (_quarter_hours(messages, since, until).groupBy("ts", "user_id")
             .agg(F.count("user_id").alias("sent")))
    return _with_labels(users.groupBy("ts").agg(
        F.count("user_id").alias("users_message"),
        F.sum("sent").alias("sent_message")))


def closed_range(as_of: dt.datetime | str) -> tuple[dt.datetime, dt.datetime]:
    """From yesterday's midnight up to the start of the running quarter of an hour."""
    until = clock.floor_moment(as_of)
    return clock.midnight(clock.days_before(until.date(), 1)), until


def metrics_15min(feed: DataFrame, messages: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """Feed and messenger side by side in time order; a side without events in a bucket is NULL.

    With ``as_of`` only the closed buckets since yesterday, else the whole log.
    """
    since, until = closed_range(as_of) if as_of is not None else (None, None)
    return feed_15min(feed, since, until).join(
        message_15min(messages, since, until), on=["ts", "date", "hm"], how="full").orderBy("ts")
