"""Named queries over state that is kept between daily runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlab import sources
from feedlab.catalog import parameters as p
from feedlab.catalog.shape import rounded
from feedlab.functions import clock
from feedlab.plans import daily_state, reports
from feedlab.sinks import tables
from feedlab.sources import schemas
from feedlab.state import bitmaps, first_seen, sketches
from feedlab.storage import fresh_path


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """The feed log, stored by day."""
    path = fresh_path(spark, "feed_log")
    tables.write_log(sources.feed_actions(sources.events(spark, folder)), path)
    return sources.read_log(spark, path, schemas.FEED)


def _first_days(spark: SparkSession, log: DataFrame) -> DataFrame:
    """All days before ``MERGE_FROM`` at once, the others one by one, two of them in the wrong order and one twice."""
    path = fresh_path(spark, "first_seen")
    start = clock.as_date(p.MERGE_FROM)
    last = log.agg(F.max("event_date").alias("d")).first()["d"]
    first_seen.build(log.filter(F.col("event_date") < F.lit(start)), path)
    days = [start + dt.timedelta(days=k) for k in range((last - start).days + 1)]
    for on in [*days[1::-1], *days[2:], *days[:1]]:
        first_seen.merge_day(log, path, on)
    return first_seen.stored(spark, path)


def first_seen_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    log = _log(spark, folder)
    return rounded(first_seen.daily_arrivals(_first_days(spark, log), log))


def first_seen_reports(spark: SparkSession, folder: str) -> DataFrame:
    """New users, first-day retention and the first and last point of the retention curve, from the table."""
    log = _log(spark, folder)
    path = fresh_path(spark, "first_seen")
    first_seen.build(log, path)
    table = first_seen.stored(spark, path)
    return (first_seen.new_users(table, p.NEW_USERS_AS_OF)
            .crossJoin(first_seen.retention_day1(table, log, p.RETENTION_AS_OF).select("cohort_size", "returned"))
            .crossJoin(first_seen.retention_curve(table, log, p.CURVE_AS_OF, p.CURVE_AGE).agg(
                F.max("cohort_size").alias("curve_size"), F.sum("users").alias("curve_visits"))))  # one row each


def cohort_matrix(spark: SparkSession, folder: str) -> DataFrame:
    log = _log(spark, folder)
    table, bits = fresh_path(spark, "first_seen"), fresh_path(spark, "activity")
    first_seen.build(log, table)
    users = first_seen.read(spark, table)
    bitmaps.write_activity(log, users, bits)
    return bitmaps.matrix(bitmaps.cohorts(users), bitmaps.read_activity(spark, bits))


def weekly_users(spark: SparkSession, folder: str) -> DataFrame:
    log = _log(spark, folder)
    table, bits = fresh_path(spark, "first_seen"), fresh_path(spark, "activity")
    first_seen.build(log, table)
    bitmaps.write_activity(log, first_seen.read(spark, table), bits)
    week = F.to_date(F.date_trunc("week", "date"))
    return bitmaps.distinct_users(bitmaps.read_activity(spark, bits), week).withColumnRenamed("period", "week")


def sketched_users(spark: SparkSession, folder: str) -> DataFrame:
    """Daily roll-up of stored quarter hours; with 2**18 cells the estimate is exact for the users of these tables."""
    path = fresh_path(spark, "sketches")
    sketches.write_buckets(sources.feed_actions(sources.events(spark, folder)), path, cells=18)
    daily = sketches.rolled_up(sketches.read_buckets(spark, path), F.to_date("ts"))
    return rounded(daily.withColumnRenamed("period", "date"))


def report_app_text_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The report's message after daily runs over an empty state, the last one twice."""
    log, root = _log(spark, folder), fresh_path(spark, "daily_state")
    messages = sources.message_actions(sources.events(spark, folder))
    daily_state.create(spark, root)
    for back in (1, 0, 0):
        daily_state.add_day(log, messages, clock.days_before(p.RETENTION_AS_OF, back), root)
    return reports.app_message(daily_state.arrivals(spark, root, p.RETENTION_AS_OF))


QUERIES = {
    "first_seen_arrivals": first_seen_arrivals,
    "first_seen_reports": first_seen_reports,
    "cohort_matrix": cohort_matrix,
    "weekly_users": weekly_users,
    "sketched_users": sketched_users,
    "report_app_text_stored": report_app_text_stored,
}
