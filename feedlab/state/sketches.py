"""Users per quarter hour as mergeable sketches, stored by day.

A sketch takes a few kilobytes whatever the number of users. Hours, days and weeks are unions of stored sketches,
so a roll-up reads sketches and no log. Views and likes are stored next to them and add up exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedlab.functions.clock import PARTITION, QUARTER_HOUR, day, grid
from feedlab.functions.ratios import count_action, ratio

#: Log2 of the sketch's cells: the relative standard error is 1.04 / 2 ** (CELLS / 2), 1.6 percent for 12.
CELLS = 12

SCHEMA = f"ts TIMESTAMP_NTZ, views BIGINT, likes BIGINT, users BINARY, {PARTITION} DATE"


def write_buckets(feed: DataFrame, path: str, cells: int = CELLS) -> None:
    """Store views, likes and a sketch of the users of every quarter hour, replacing the days in ``feed``."""
    known = feed.filter(F.col("time").isNotNull() & F.col("user_id").isNotNull())
    (known.groupBy(day().alias(PARTITION), grid("time", QUARTER_HOUR).alias("ts"))
     .agg(count_action("view").alias("views"), count_action("like").alias("likes"),
          F.hll_sketch_agg("user_id", cells).alias("users"))
     .hint("rebalance", PARTITION).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(path))


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def rolled_up(buckets: DataFrame, period: Column) -> DataFrame:
    """period, users (estimated), views, likes, ctr of each ``period``, a function of ``ts``."""
    return (buckets.groupBy(period.alias("period"))
            .agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"),
                 F.sum("views").alias("views"), F.sum("likes").alias("likes"))
            .withColumn("ctr", ratio("likes", "views")))
