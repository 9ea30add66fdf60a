"""Per-user daily statistics and their roll-up by dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlab.functions.clock import PARTITION, as_date, day, on_days
from feedlab.functions.ratios import count_action, is_action

DEMOGRAPHICS = ["os", "gender", "age"]
USER_DAY = ["user_id", "event_date", *DEMOGRAPHICS]
COUNTERS = ["views", "likes", "messages_sent", "messages_received", "users_sent", "users_received"]


def _on(rows: DataFrame, on: dt.date | str | None) -> DataFrame:
    if on is not None:
        rows = on_days(rows, as_date(on), as_date(on))
    return rows if PARTITION in rows.columns else rows.withColumn(PARTITION, day())


def feed_user_day(feed: DataFrame, on: dt.date | str | None = None, literal: bool = False) -> DataFrame:
    """Views and likes per user and day; all days unless ``on`` names one.

    ``literal`` counts the rows where the comparison is not NULL, which is every
    action, in both columns.
    """
    def counted(kind: str) -> Column:
        return F.count(is_action(kind)) if literal else count_action(kind)

    return (_on(feed, on).groupBy(*USER_DAY)
            .agg(counted("view").alias("views"), counted("like").alias("likes")))


def _both_roles(messages: DataFrame) -> DataFrame:
    """Each message twice: as sent by one user and as received by the other."""
    sent = F.col("is_sent")

    def either(if_sent: str, if_received: str) -> Column:
        return F.when(sent, F.col(if_sent)).otherwise(F.col(if_received))

    return (messages.withColumn("is_sent", F.explode(F.array(F.lit(True), F.lit(False))))
            .select("event_date", "is_sent", either("user_id", "reciever_id").alias("who"),
                    either("reciever_id", "user_id").alias("other"),
                    *[F.when(sent, F.col(d)).alias(d) for d in DEMOGRAPHICS])
            .filter(sent | F.col("who").isNotNull()))


def message_user_day(messages: DataFrame, on: dt.date | str | None = None) -> DataFrame:
    """Messages and counterparties of every sender and day, 0 where nothing was received.

    One scan and no join: both roles are counted together, then a user's
    received counts are handed to the same user's sent rows of that day.
    """
    counts = (_both_roles(_on(messages, on))
              .groupBy("who", "event_date", "is_sent", *DEMOGRAPHICS)
              .agg(F.count("other").alias("messages"), F.count_distinct("other").alias("users")))
    same_user = Window.partitionBy("who", "event_date")

    def received(counter: str) -> Column:
        mine = F.when(~F.col("is_sent"), F.col(counter))
        return F.coalesce(F.max(mine).over(same_user), F.lit(0)).alias(f"{counter}_received")

    return (counts.select("who", "event_date", "is_sent", *DEMOGRAPHICS, "messages", "users",
                          received("messages"), received("users"))
            .filter("is_sent")
            .select(F.col("who").alias("user_id"), "event_date", *DEMOGRAPHICS,
                    F.col("messages").alias("messages_sent"), "messages_received",
                    F.col("users").alias("users_sent"), "users_received"))


def message_user_day_literal(messages: DataFrame, on: dt.date | str) -> DataFrame:
    """The same with received messages grouped by the demographics on the message too.

    The lookup is by user alone, so a sender comes out once per demographic
    group that wrote to them. Defined for one day.
    """
    rows = _on(messages, on)
    sent = rows.groupBy(*USER_DAY).agg(
        F.count("reciever_id").alias("messages_sent"),
        F.count_distinct("reciever_id").alias("users_sent"))
    received = rows.groupBy(F.col("reciever_id").alias("user_id"), *DEMOGRAPHICS).agg(
        F.count("user_id").alias("messages_received"),
        F.count_distinct("user_id").alias("users_received")).drop(*DEMOGRAPHICS)
    return (sent.join(received, "user_id", "left").na.fill(0, ["messages_received", "users_received"])
            .select(*USER_DAY, "messages_sent", "messages_received", "users_sent", "users_received"))


def contributions(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """What each row of the two logs adds to a user's day; a message adds to both of its users.

    ``kind`` is feed, sent or received. A received message has no demographics, as they are the sender's.
    """
    none, nobody = F.lit(0).cast("long"), F.lit(None).cast("long")

    def one(when: Column) -> Column:
        return F.when(when, 1).otherwise(0).cast("long")

    seen = _on(feed, None).select(
        *USER_DAY, F.lit("feed").alias("kind"), nobody.alias("other"), one(is_action("view")).alias("views"),
        one(is_action("like")).alias("likes"), none.alias("messages"))
    both = _both_roles(_on(messages, None))
    talked = both.select(
        F.col("who").alias("user_id"), "event_date", *DEMOGRAPHICS,
        F.when(F.col("is_sent"), "sent").otherwise("received").alias("kind"), F.col("other").cast("long").alias("other"),
        none.alias("views"), none.alias("likes"), one(F.col("other").isNotNull()).alias("messages"))
    return seen.unionByName(talked)


ADDED = ["views", "likes", "messages"]


def merged(rows: DataFrame) -> DataFrame:
    """Contributions added up per user, day, demographics, kind and counterparty: again contributions.

    Sums and pairs can be merged any number of times and in any order, so they may be kept and added to.
    """
    return rows.groupBy(*USER_DAY, "kind", "other").agg(*[F.sum(c).alias(c) for c in ADDED])


#: Which of (has feed rows, has sent messages) each kind of join keeps.
KEPT = {"inner": ("feed", "sent"), "left": ("feed",), "right": ("sent",), "full": ()}


def user_day(pairs: DataFrame, how: str = "inner") -> DataFrame:
    """Feed and messenger statistics of every user, day and demographics, from ``merged`` contributions.

    Equal to joining ``feed_user_day`` with ``message_user_day``, without a join: all three kinds of a user's
    day are brought to one task, after their counterparties are counted, so what is moved is at most a row a kind
    and demographics of a user's day. Rows with a NULL key match nothing, as in a join.
    """
    counted = pairs.groupBy(*USER_DAY, "kind").agg(
        *[F.sum(c).alias(c) for c in ADDED], F.count("other").alias("users"))
    same_user = Window.partitionBy("user_id", "event_date")

    def received(counter: str) -> Column:
        mine = F.when(F.col("kind") == "received", F.col(counter))
        return F.coalesce(F.max(mine).over(same_user), F.lit(0)).alias(f"{counter}_received")

    alone = F.col("user_id").isNull() | F.col("event_date").isNull()
    for d in DEMOGRAPHICS:
        alone = alone | F.col(d).isNull()
    rows = (counted.select("*", received("messages"), received("users")).filter("kind != 'received'")
            .withColumn("side", F.when(alone, F.col("kind"))))

    def of(kind: str, column: str, name: str | None = None) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(column))), F.lit(0)).alias(name or column)

    both = rows.groupBy(*USER_DAY, "side").agg(
        of("feed", "views"), of("feed", "likes"), of("sent", "messages", "messages_sent"),
        of("sent", "messages_received"), of("sent", "users", "users_sent"), of("sent", "users_received"),
        *[F.count_if(F.col("kind") == k).alias(f"has_{k}") for k in ("feed", "sent")])
    for kind in KEPT[how]:
        both = both.filter(F.col(f"has_{kind}") > 0)
    return both.select(*USER_DAY, "views", "likes", "messages_sent", "messages_received", "users_sent", "users_received")


def join_user_day(feed_stats: DataFrame, message_stats: DataFrame, how: str = "inner") -> DataFrame:
    """Feed and messenger statistics of the same user, day and demographics."""
    return feed_stats.join(message_stats, USER_DAY, how).na.fill(0, COUNTERS)


def slice_by(joined: DataFrame, dimension: str) -> DataFrame:
    """Sums of all counters per day and one dimension."""
    return (joined.groupBy("event_date", dimension)
            .agg(*[F.sum(c).alias(c) for c in COUNTERS]))


def daily_slices(joined: DataFrame) -> DataFrame:
    """All three dimensions stacked as (event_date, dimension, dimension_value, counters)."""
    grouped = joined.groupingSets(
        [["event_date", d] for d in DEMOGRAPHICS], "event_date", *DEMOGRAPHICS,
    ).agg(*[F.sum(c).alias(c) for c in COUNTERS], *[F.grouping(d).alias(f"no_{d}") for d in DEMOGRAPHICS])
    here = {d: F.col(f"no_{d}") == 0 for d in DEMOGRAPHICS}
    return grouped.select(
        "event_date",
        F.coalesce(*[F.when(here[d], d) for d in DEMOGRAPHICS]).alias("dimension"),
        F.coalesce(*[F.when(here[d], F.col(d).cast("string")) for d in DEMOGRAPHICS]).alias("dimension_value"),
        *COUNTERS)


def daily_slices_union(joined: DataFrame) -> DataFrame:
    """Same rows from three separate roll-ups."""
    parts = [slice_by(joined, d).select(
        "event_date", F.lit(d).alias("dimension"), F.col(d).cast("string").alias("dimension_value"),
        *COUNTERS) for d in DEMOGRAPHICS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
