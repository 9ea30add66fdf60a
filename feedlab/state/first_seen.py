"""The first day of every user, as a table that one day's rows are merged into.

``path`` holds a folder for each merged day with the users first seen on it. A report on new users or retention
opens the folders of its cohort and the log of the days it looks at, never the history. Each user also has a
number, dense from 1, for bitmaps (``feedlab.state.bitmaps``).

Every merged day has one row without a user: it marks the day as done, also if nobody was new on it. Days may be
merged in any order and again; the table is then what a run over the whole log would give.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedlab.functions import clock
from feedlab.functions.clock import day
from feedlab.functions.ratios import ratio
from feedlab.operators.resampling import numbered
from feedlab.storage import checkpointed

SCHEMA = "user_id BIGINT, number BIGINT, first_day DATE"
KEY = "first_day"


def create(spark: SparkSession, path: str) -> None:
    """An empty table."""
    spark.createDataFrame([], SCHEMA).write.partitionBy(KEY).parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The table with its marks."""
    return spark.read.schema(SCHEMA).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """user_id, number, first_day."""
    return stored(spark, path).filter(F.col("user_id").isNotNull())


def merged_days(spark: SparkSession, path: str) -> DataFrame:
    """The days that are in the table."""
    return stored(spark, path).filter(F.col("user_id").isNull()).select(F.col(KEY).alias("date"))


def _write(rows: DataFrame, path: str) -> None:
    (rows.select("user_id", "number", KEY).hint("rebalance", KEY).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(KEY).parquet(path))


def _numbers(users: DataFrame, after: int) -> DataFrame:
    """``users`` (user_id, first_day) with numbers from ``after`` + 1 on; read twice."""
    ranked, _ = numbered(users.withColumn("exp_group", F.lit(0)))
    return ranked.select("user_id", (F.col("number") + after + 1).alias("number"), KEY)


def _marks(spark: SparkSession, days: list[dt.date]) -> DataFrame:
    return spark.createDataFrame([(None, None, d) for d in days], SCHEMA)


def build(log: DataFrame, path: str) -> None:
    """Write the whole table from a whole log in one pass over it, replacing the days it holds."""
    known = log.filter(F.col("time").isNotNull())
    seen = checkpointed(known.groupBy("user_id", day().alias(KEY)).agg(F.lit(1).alias("one")).drop("one"))
    users = seen.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.min(KEY).alias(KEY))
    marks = seen.select(F.lit(None).cast("long").alias("user_id"), F.lit(None).cast("long").alias("number"), KEY).distinct()
    _write(_numbers(checkpointed(users), 0).unionByName(marks), path)


def merge_day(log: DataFrame, path: str, on: dt.date | str) -> None:
    """Bring one day of the log into the table.

    Reads that day of the log and the user ids of the table. If later days are merged already, users who turn out
    to have come earlier are taken out of them; if the day itself is, users who are no longer on it go to the
    next day they came on, for which the log after the day is read. Numbers once given stay.
    """
    spark, on = log.sparkSession, clock.as_date(on)
    table = stored(spark, path)
    here = clock.on_days(log, on, on).filter(F.col("user_id").isNotNull()).select("user_id").distinct()
    earlier = table.filter(F.col(KEY) < F.lit(on)).select("user_id")
    fresh = checkpointed(here.join(earlier, "user_id", "left_anti"))
    behind = read(spark, path).filter(F.col(KEY) >= F.lit(on))
    numbers = fresh.join(behind.select("user_id", "number"), "user_id", "left").withColumn(KEY, F.lit(on))
    numbers = checkpointed(numbers)
    last = table.agg(F.max("number").alias("n")).first()["n"] or 0
    new = _numbers(numbers.filter(F.col("number").isNull()).drop("number"), last)
    rows = numbers.filter(F.col("number").isNotNull()).unionByName(new).unionByName(_marks(spark, [on]))
    later = [r[KEY] for r in table.filter(F.col(KEY) >= F.lit(on)).select(KEY).distinct().collect()]  # days
    if later:
        rows = rows.unionByName(_moved(log, behind, fresh, here, on))
    _write(rows, path)


def _moved(log: DataFrame, behind: DataFrame, fresh: DataFrame, here: DataFrame, on: dt.date) -> DataFrame:
    """What the folders after ``on`` hold now, of those that gain or lose users, with their marks."""
    spark = log.sparkSession
    gone = behind.filter(F.col(KEY) == F.lit(on)).join(here, "user_id", "left_anti")
    after = log.filter(day() > F.lit(on))
    if clock.PARTITION in log.columns:
        after = after.filter(F.col(clock.PARTITION) > F.lit(on))
    gained = checkpointed(after.join(gone.select("user_id", "number"), "user_id")
                          .groupBy("user_id", "number").agg(F.min(day()).alias(KEY)))
    beyond = behind.filter(F.col(KEY) > F.lit(on))
    touched = [r[KEY] for r in beyond.join(fresh, "user_id", "left_semi").select(KEY)
               .unionByName(gained.select(KEY)).distinct().collect()]  # days
    if not touched:
        return spark.createDataFrame([], SCHEMA)
    return (beyond.filter(F.col(KEY).isin(touched)).join(fresh, "user_id", "left_anti")
            .unionByName(gained).unionByName(_marks(spark, touched)))


def _counted(on: dt.date) -> tuple[Column, Column]:
    """Whether a row is of the cohort of a day, and the cohort's size: an error where the day was never merged."""
    cohort = F.col(KEY) == F.lit(on)
    merged = F.count_if(cohort & F.col("user_id").isNull()) > 0
    missing = F.raise_error(F.lit(f"{on} is not merged into the table of first days")).cast("long")
    return cohort, F.when(merged, F.count_if(cohort & F.col("user_id").isNotNull())).otherwise(missing)


def new_users(table: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Number of users whose first day is the day before ``as_of``; ``table`` is ``stored``. One folder is opened."""
    cohort, users = _counted(clock.days_before(as_of, 1))
    return table.filter(cohort).agg(users.alias("new_users"))


def cohort_size(table: DataFrame, on: dt.date) -> DataFrame:
    """Number of users whose first day is ``on``; one folder is opened."""
    cohort, users = _counted(on)
    return table.filter(cohort).agg(users.alias("cohort_size"))


def retention_day1(table: DataFrame, log: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Share of users first seen two days before ``as_of`` who came back the next day; one folder of each."""
    start, back = (clock.days_before(as_of, n) for n in (2, 1))
    cohort, size = _counted(start)
    came = clock.on_days(log, back, back).select("user_id").distinct().withColumn("came", F.lit(True))
    return (table.filter(cohort).join(came, "user_id", "left")
            .agg(F.lit(start).alias("start_date"), size.alias("cohort_size"), F.count_if("came").alias("returned"))
            .withColumn("retention_pct", ratio("returned", "cohort_size") * 100))


def daily_arrivals(table: DataFrame, log: DataFrame) -> DataFrame:
    """new_users, returned and retention_pct of every merged day; a user's days are looked at one by one."""
    days = log.select("user_id", day().alias("date")).distinct()
    users = table.filter(F.col("user_id").isNotNull())
    next_day = (users.join(days, (users["user_id"] == days["user_id"])
                           & (F.date_add(users[KEY], 1) == days["date"]), "left_semi")
                .groupBy(KEY).agg(F.count(F.lit(1)).alias("returned")))
    sizes = table.groupBy(KEY).agg(F.count("user_id").alias("new_users"))
    return (sizes.join(next_day, KEY, "left")
            .select(F.col(KEY).alias("date"), "new_users", F.coalesce("returned", F.lit(0).cast("long")).alias("returned"))
            .withColumn("retention_pct", ratio("returned", "new_users") * 100))


def retention_curve(table: DataFrame, log: DataFrame, as_of: dt.date | str, age: int = 28) -> DataFrame:
    """Users per day of the cohort that started ``age`` days before ``as_of``.

    Opens the cohort's folder and the log from its first day on.
    """
    start, last = clock.days_before(as_of, age), clock.as_date(as_of)
    cohort = table.filter((F.col(KEY) == F.lit(start)) & F.col("user_id").isNotNull()).select("user_id")
    days = clock.on_days(log, start, last).select("user_id", day().alias("date")).distinct()
    whole = Window.partitionBy("start_date")  # at most age + 1 rows
    return (days.join(cohort, "user_id", "left_semi").groupBy("date").agg(F.count(F.lit(1)).alias("users"))
            .select(F.lit(start).alias("start_date"), "date", "users")
            .withColumn("cohort_size", F.max("users").over(whole))
            .withColumn("retention_rate", ratio("users", "cohort_size")))
