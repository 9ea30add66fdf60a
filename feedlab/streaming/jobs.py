"""Streaming queries and their sinks. A batch that runs again replaces its own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from feedlab.operators import anomaly, slices
from feedlab.session import SETTINGS
from feedlab.sinks.tables import write_slices
from feedlab.state import partial_slices
from feedlab.streaming.recent import RECENT, Recent

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ALERTS = ("metric STRING, ts TIMESTAMP_NTZ, value DOUBLE, previous DOUBLE, q25 DOUBLE, q75 DOUBLE, iqr DOUBLE, "
          "up DOUBLE, low DOUBLE, is_alert INT, deviation DOUBLE")


def start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
          every: str | None = None) -> StreamingQuery:
    """Run ``each`` per micro-batch: all there is now, or periodically with ``every``."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def write_buckets(buckets: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Closed buckets to Parquet; the file sink commits each batch exactly once."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (buckets.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**trigger).start(path))


def alerts(closed: DataFrame, metrics: list[str], a: float = anomaly.FACTOR, n: int = anomaly.WINDOW) -> DataFrame:
    """Bands and flags of every closed bucket, as a stream.

    Each metric is its own series here: buckets without events of its log are not in it. The state of a metric is
    a ring of its last ``n`` values, so it does not grow.
    """
    series = anomaly.long_series(closed, metrics).select("metric", "ts", "value")
    seen = series.groupBy("metric").transformWithStateInPandas(
        Recent(n), outputStructType=RECENT, outputMode="Append", timeMode="None")
    return anomaly.judged(seen, a, n)


def write_alerts(found: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Alerts to Parquet; the file sink commits each batch exactly once, also after a restart.

    The ring needs the RocksDB state store. A stream takes its settings when it starts, so the session has
    that store named for the start only.
    """
    conf = found.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    try:
        return write_buckets(found, path, checkpoint, every)
    finally:
        conf.set(STATE_STORE, before)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Everything ``write_alerts`` has written."""
    return spark.read.schema(ALERTS).parquet(path)


def slice_batches(messages: DataFrame, feed_path: str, path: str) -> Callable[[DataFrame, int], None]:
    """Recompute the daily slices of the days a batch touches and replace them.

    The batch is stored first, by day, so a day is sliced from all its rows and
    only the folders of touched days are read. ``messages`` is a batch frame, its
    files fixed when it is made: messages that come later need ``start_slices``.
    """
    def each(feed: DataFrame, batch: int) -> None:
        spark = feed.sparkSession
        dated = (feed.filter(F.col("time").isNotNull())
                 .withColumn("event_date", F.to_date("time"))
                 .withColumn("batch", F.lit(batch).cast("long"))).persist()
        # a list of dates, as long as the batch has days
        days = [r.event_date for r in dated.select("event_date").distinct().collect()]
        (dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date", "batch").parquet(feed_path))
        dated.unpersist()
        if not days:
            return
        stored = (spark.read.schema(_ddl(dated)).option("basePath", feed_path)
                  .parquet(*[f"{feed_path}/event_date={d}" for d in days]))
        sent = messages.filter(F.to_date("time").isin(days))
        joined = slices.join_user_day(slices.feed_user_day(stored), slices.message_user_day(sent))
        write_slices(slices.daily_slices(joined), path)

    return each


def start_slices(feed: DataFrame, messages: DataFrame, store: str, path: str, checkpoint: str,
                 every: str | None = None) -> StreamingQuery:
    """Daily slices from two streams, in whichever order their rows come.

    ``store`` keeps partial sums of every user's day (``state.partial_slices``). A batch adds its rows to those of
    the days it touches and slices these days again from the sums, so the cost of a batch follows its own rows
    and the users and pairs of its days, not the rows that came before. A repeated batch changes nothing.
    """
    logs = [log.filter(F.col("time").isNotNull()) for log in (feed, messages)]
    partial_slices.create(feed.sparkSession, store)

    def each(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()
        if not rows.isEmpty():
            touched = partial_slices.merge(rows, store, batch)
            write_slices(slices.daily_slices(slices.user_day(touched)), path)
        rows.unpersist()

    return start(slices.contributions(*logs), each, checkpoint, every)


def _ddl(frame: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields)
