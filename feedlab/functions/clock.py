"""Dates, time grids and labels. Nothing here reads the wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

# Label formats of the reports and charts.
LABEL_MONTH_FIRST = "MM/dd/yyyy"
LABEL_DAY_FIRST = "dd/MM/yyyy"
LABEL_DAY_HOUR = "dd/MM HH:mm"
LABEL_HOUR = "HH:mm"

QUARTER_HOUR = "15 minutes"
HOUR = "1 hour"
SECOND = "1 second"


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, str):
        return dt.date.fromisoformat(value)
    return value.date() if isinstance(value, dt.datetime) else value


def as_moment(value: dt.datetime | str) -> dt.datetime:
    return dt.datetime.fromisoformat(value) if isinstance(value, str) else value


def days_before(value: dt.date | str, days: int) -> dt.date:
    return as_date(value) - dt.timedelta(days=days)


def midnight(value: dt.date | str) -> dt.datetime:
    return dt.datetime.combine(as_date(value), dt.time())


def moment(value: dt.datetime) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day(time: str = "time") -> Column:
    return F.to_date(F.col(time))


PARTITION = "event_date"


def on_days(rows: DataFrame, first: dt.date | None, last: dt.date) -> DataFrame:
    """Rows of the days ``first`` to ``last``, both included; no lower end without ``first``.

    Reaches the scan as bounds on the raw timestamp, and prunes the folders of a
    log that is partitioned by ``event_date``.
    """
    for when in [day()] + ([F.col(PARTITION)] if PARTITION in rows.columns else []):
        if first is not None:
            rows = rows.filter(when >= F.lit(first))
        rows = rows.filter(when <= F.lit(last))
    return rows


def grid(time: str, step: str) -> Column:
    """Start of the ``step`` that holds ``time``; keeps the column zone-free."""
    return F.window(F.col(time), step)["start"]


def floor_moment(value: dt.datetime | str, minutes: int = 15) -> dt.datetime:
    value = as_moment(value)
    return value.replace(minute=value.minute - value.minute % minutes, second=0, microsecond=0)


def label(column: str, pattern: str) -> Column:
    return F.date_format(F.col(column), pattern)
