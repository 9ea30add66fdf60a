"""Closed 15-minute buckets from an event stream.

Event time must carry a zone for watermarks, so ``time`` is cast at the source
and cast back in the output; use a session in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedlab.functions.clock import QUARTER_HOUR
from feedlab.functions.ratios import count_action, ratio

DELAY = "30 minutes"


def _timed(stream: DataFrame, delay: str) -> DataFrame:
    return stream.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", delay)


def _started(buckets: DataFrame) -> DataFrame:
    return buckets.withColumn("ts", F.col("bucket.start").cast("timestamp_ntz")).drop("bucket")


def _exact(stream: DataFrame, delay: str, users: str, counts: dict[str, Column]) -> DataFrame:
    """Counts per user and bucket, then a second stateful count over the closed user rows."""
    per_user = (_timed(stream, delay).groupBy(F.window("time", QUARTER_HOUR), "user_id")
                .agg(*[c.alias(name) for name, c in counts.items()]))
    closed = per_user.withColumn("at", F.window_time("window"))
    return _started(closed.groupBy(F.window("at", QUARTER_HOUR).alias("bucket"))
                    .agg(F.count("user_id").alias(users), *[F.sum(name).alias(name) for name in counts]))


def _approximate(stream: DataFrame, delay: str, users: str, counts: dict[str, Column]) -> DataFrame:
    """One row of state per bucket: a sketch of its users."""
    return _started(_timed(stream, delay).groupBy(F.window("time", QUARTER_HOUR).alias("bucket"))
                    .agg(F.approx_count_distinct("user_id").alias(users),
                         *[c.alias(name) for name, c in counts.items()]))


def feed_buckets(feed: DataFrame, delay: str = DELAY, approximate: bool = False) -> DataFrame:
    """Users, views, likes and CTR of every bucket the watermark has closed.

    ``approximate`` keeps a sketch per bucket instead of a row per bucket and user. As in
    the batch form, actions without a user are not counted, but their bucket is there.
    """
    feed = feed.withColumn("action", F.when(F.col("user_id").isNotNull(), F.col("action")))
    count = _approximate if approximate else _exact
    buckets = count(feed, delay, "users_feed", {"views": count_action("view"), "likes": count_action("like")})
    return buckets.withColumn("ctr", ratio("likes", "views"))


def message_buckets(messages: DataFrame, delay: str = DELAY, approximate: bool = False) -> DataFrame:
    """Senders and messages of every bucket the watermark has closed."""
    count = _approximate if approximate else _exact
    return count(messages, delay, "users_message", {"sent_message": F.count("user_id")})
