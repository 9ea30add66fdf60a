"""Feed and message logs derived from the ``events`` table (rules: FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedlab.functions.clock import moment
from feedlab.functions.hashing import md5_long
from feedlab.sources import schemas

EFFECT_START = dt.datetime(2024, 1, 15)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(schemas.EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """The same table as a file stream. The pattern accepts a file or a folder."""
    reader = spark.readStream.schema(schemas.EVENTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{sf_dir}/events.parquet*")


def _demographics() -> list[Column]:
    user = F.col("user_id")
    return [
        F.when(user % 3 == 0, "iOS").otherwise("Android").alias("os"),
        (user % 2).cast("int").alias("gender"),
        (F.lit(18) + (user % 4) * 10).cast("int").alias("age"),
    ]


def exp_group(user: Column) -> Column:
    return (md5_long(F.concat(F.lit("exp:"), user.cast("string"))) % 5).cast("int")


def feed_actions(source: DataFrame) -> DataFrame:
    """One row per view or like."""
    user, kind = F.col("user_id"), F.col("event_type")
    # the cheap tests come first, so the hash runs for few rows
    treated = (F.col("ts") >= moment(EFFECT_START)) & (F.col("event_id") % 3 == 0)
    action = (F.when(treated & (kind == "click") & (exp_group(user) == 2), "view")
              .when(treated & (kind == "view") & (exp_group(user) == 3), "like")
              .when(kind == "click", "like")
              .otherwise("view"))
    return (source.filter(kind.isin("view", "click"))
            .select("event_id", "user_id", F.col("ts").alias("time"), action.alias("action"),
                    *_demographics(),
                    F.when(user % 5 < 2, "ads").otherwise("organic").alias("source"),
                    exp_group(user).alias("exp_group")))


def message_actions(source: DataFrame) -> DataFrame:
    """One row per message sent; the demographics are the sender's."""
    return (source.filter(F.col("event_type").isin("signup", "purchase"))
            .select("event_id", "user_id",
                    F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("reciever_id"),
                    F.col("ts").alias("time"), *_demographics()))
