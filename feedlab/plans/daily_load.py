"""Daily load: feed and messenger statistics, joined, sliced and written."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from feedlab.functions.clock import as_date, days_before, on_days
from feedlab.operators import slices
from feedlab.sinks.tables import write_slices


def joined_day(feed: DataFrame, messages: DataFrame, on: dt.date | str | None = None,
               how: str = "inner") -> DataFrame:
    """Per-user statistics of a day (all days without ``on``): three exchanges and no join."""
    if on is not None:
        feed, messages = (on_days(log, as_date(on), as_date(on)) for log in (feed, messages))
    return slices.user_day(slices.merged(slices.contributions(feed, messages)), how)


def joined_day_literal(feed: DataFrame, messages: DataFrame, on: dt.date | str) -> DataFrame:
    """The same from the literal statistics."""
    return slices.join_user_day(slices.feed_user_day(feed, on, literal=True),
                                slices.message_user_day_literal(messages, on))


def load_day(feed: DataFrame, messages: DataFrame, as_of: dt.date | str, path: str) -> None:
    """Write the slices of the day before ``as_of``; safe to run again."""
    joined = joined_day(feed, messages, days_before(as_of, 1))
    write_slices(slices.daily_slices(joined), path)


def load_days(feed: DataFrame, messages: DataFrame, path: str) -> None:
    """Write the slices of every day in the logs in one job, as a backfill."""
    write_slices(slices.daily_slices(joined_day(feed, messages)), path)
