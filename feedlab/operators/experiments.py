"""Per-user experiment metrics and their transforms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from feedlab.functions import hashing
from feedlab.functions.clock import as_date, on_days
from feedlab.functions.ratios import count_action, ratio

BUCKETS = 50  # fixed value


def user_ctr(feed: DataFrame, first: dt.date | str, last: dt.date | str, groups: list[int]) -> DataFrame:
    """Likes, views and CTR per user of the given groups; both days included."""
    return (on_days(feed, as_date(first), as_date(last)).filter(F.col("exp_group").isin(groups))
            .groupBy("exp_group", "user_id")
            .agg(count_action("like").alias("likes"), count_action("view").alias("views"))
            .withColumn("ctr", ratio("likes", "views")))


def group_sizes(users: DataFrame) -> DataFrame:
    """Users per group; ``users`` has one row per group and user."""
    return users.groupBy("exp_group").agg(F.count("user_id").alias("users"))


def bucket_ctr(users: DataFrame, buckets: int = BUCKETS, method: str = "xxhash64") -> DataFrame:
    """CTR of hash buckets of users."""
    return (users.groupBy("exp_group", hashing.bucket(F.col("user_id"), buckets, method).alias("bucket"))
            .agg(ratio(F.sum("likes"), F.sum("views")).alias("bucket_ctr")))


def linearized_likes(users: DataFrame, control_group: int) -> DataFrame:
    """Likes minus the likes expected from the user's views at the control group's CTR.

    The control CTR is one number; it enters the plan as a scalar subquery.
    ``users`` is read twice: pass a checkpointed frame if it is dear.
    """
    control = (users.filter(F.col("exp_group") == control_group)
               .agg(ratio(F.sum("likes"), F.sum("views")).alias("ctr")).scalar())
    return (users.select("user_id", "exp_group", "likes", "views", control.alias("ctr_control"))
            .withColumn("linearized_likes", F.col("likes") - F.col("views") * F.col("ctr_control")))
