"""The daily slices table and the event logs, one partition per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlab.functions.clock import PARTITION, day
from feedlab.sources import schemas
from feedlab.storage import checkpointed


def write_slices(slices: DataFrame, path: str) -> None:
    """Replace the days in ``slices``, keep all others: running a day twice changes nothing.

    A slice is a few rows per day, so one file per day is written.
    """
    (slices.repartition(PARTITION).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(path))


def append_slices(slices: DataFrame, path: str) -> None:
    """Add rows; running a day twice doubles it."""
    slices.repartition(PARTITION).write.mode("append").partitionBy(PARTITION).parquet(path)


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DAILY_SLICES).parquet(path)


def create_slices_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the catalog table with its declared columns unless it is there."""
    where = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({schemas.DAILY_SLICES}) "
              f"USING parquet PARTITIONED BY ({PARTITION}) {where}", args={"name": name})


def write_slices_table(slices: DataFrame, name: str) -> None:
    """Replace the days in ``slices`` in the catalog table and keep all others.

    An insert into a table heeds the session's overwrite mode alone, and its default
    drops every other day. So the days are replaced at the table's location, where
    the option counts, and their partitions are added to the catalog: those of the days
    written, so no other day of the table is listed.
    """
    spark = slices.sparkSession
    described = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name})
    location = described.filter(F.col("col_name") == "Location").first()["data_type"]
    rows = checkpointed(slices.select(*spark.table(name).columns))  # a few rows a day
    days = [r[PARTITION] for r in rows.select(PARTITION).distinct().collect()]  # the days written
    write_slices(rows, location)
    if days:
        added = " ".join(f"PARTITION ({PARTITION} = DATE '{d}')" for d in days)
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) ADD IF NOT EXISTS {added}", args={"name": name})
    spark.catalog.refreshTable(name)


def write_log(log: DataFrame, path: str) -> None:
    """Store a feed or message log by day, replacing the days it holds.

    Day filters of the operators then open the folders of those days only, and
    time filters skip row groups, as every file is in time order. A day's rows are
    brought together first, so it has few files; adaptive execution splits a big day.
    """
    (log.withColumn(PARTITION, day()).hint("rebalance", PARTITION).sortWithinPartitions(PARTITION, "time").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(path))
