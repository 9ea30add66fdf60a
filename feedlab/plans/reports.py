"""Report texts, the numbers behind the report charts, and the audience file."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from feedlab.functions import clock, text
from feedlab.operators import activity, anomaly, cohorts
from feedlab.sinks.files import write_csv

# Message formats.
DAILY_TEXT = "Ключевые метрики за вчерашний день %s \nDAU %d\nПросмотры %d\nЛайки %d\nCTR %s"
APP_TEXT = ("Доброе утро,чат! Основные показатели приложения представлены в отчёте. \n"
            "Вчера к нам пришло %d новых юзеров\n"
            "Retention первого дня вчера составил %s%%\n"
            "Основную информацию об аудитории см. в прикреплённом файле.\n"
            "Хорошего рабочего дня!")
ALERT_TEXT = ("ALERT❗️Метрика %s:\n   - текущее значение %s;\n"
              "   - отклонение от предыдущего значения %s%%")


def daily_text(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    """One row: the message with yesterday's DAU, views, likes and CTR."""
    return activity.daily(feed, as_of).select(F.format_string(
        DAILY_TEXT, F.col("date").cast("string"), "dau", "views", "likes",
        F.coalesce(text.two_significant(F.col("ctr")), F.lit("nan"))).alias("message"))


def app_text(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    """One row: the message with yesterday's new users and first-day retention."""
    return app_message(cohorts.arrivals(feed, as_of))


def app_message(arrivals: DataFrame) -> DataFrame:
    """The message from new_users and retention_pct, of the log (``cohorts``) or of stored state (``daily_state``)."""
    return arrivals.select(F.format_string(
        APP_TEXT, "new_users",
        F.coalesce(text.two_decimals(F.col("retention_pct")), F.lit("nan"))).alias("message"))


def alert_text(feed: DataFrame, messages: DataFrame, as_of: dt.datetime | str,
               only_alerts: bool = False, dashboard: str | None = None) -> DataFrame:
    """One message per metric; all metrics unless ``only_alerts``.

    The deviation is in percent. ``dashboard`` adds a line with a link.
    """
    rows = anomaly.alerts(activity.metrics_15min(feed, messages, as_of))
    if only_alerts:
        rows = rows.filter(F.col("is_alert") == 1)
    shown = [F.coalesce(text.two_decimals(c), F.lit("nan"))
             for c in (F.col("value"), F.col("deviation") * 100)]
    message = F.format_string(ALERT_TEXT, "metric", *shown)
    if dashboard:
        message = F.concat(message, F.lit(f"\nОперативный дашборд см. по ссылке: {dashboard}"))
    return rows.select("metric", "ts", "is_alert", message.alias("message"))


def weekly_chart(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    """The last seven days with the axis label of the weekly charts."""
    return activity.daily(feed, as_of, days=7).select(
        "date", clock.label("date", clock.LABEL_MONTH_FIRST).alias("label"), "dau", "views", "likes", "ctr").orderBy("date")


def source_chart(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    return activity.dau_by_source(feed, as_of).select(
        "date", clock.label("date", clock.LABEL_DAY_FIRST).alias("label"), "organic", "ads", "other").orderBy("date")


def views_chart(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    return activity.views_per_user(feed, as_of).select(
        "date", clock.label("date", clock.LABEL_DAY_FIRST).alias("label"), "avg_views", "median_views").orderBy("date")


def peak_chart(actions: DataFrame, on: dt.date | str) -> DataFrame:
    return activity.peak_per_hour(actions, on).select(
        "hour", clock.label("hour", clock.LABEL_DAY_HOUR).alias("label"), "peak_users").orderBy("hour")


def retention_chart(feed: DataFrame, as_of: dt.date | str, age: int = 28) -> DataFrame:
    return cohorts.retention_curve(feed, as_of, age).select(
        "date", clock.label("date", clock.LABEL_DAY_FIRST).alias("label"), "users").orderBy("date")


def alert_chart(feed: DataFrame, messages: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Every metric with its bands over the closed buckets."""
    series = anomaly.long_series(activity.metrics_15min(feed, messages, as_of))
    return anomaly.iqr_bands(series).select(
        "metric", "ts", clock.label("ts", clock.LABEL_DAY_HOUR).alias("label"), "value", "up", "low").orderBy("metric", "ts")


def audience_csv(feed: DataFrame, path: str, k: int = 10_000) -> None:
    """Write the active audience as one CSV file."""
    write_csv(activity.active_audience(feed, k), path)

