"""Time some jobs over a made table of events, larger than the test tables and skewed: one JSON line.

BENCH_EVENTS  rows            (default 20,000,000)
BENCH_CPUS    local cores     (default 8)
BENCH_ROOT    folder for the table and the state, kept; a new one under /tmp by default

One user sends a third of all events, one receiver gets a third of all messages; 200,000 users, 30 days.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlab import session, sources
from feedlab.operators import activity, cohorts, experiments, hypothesis, resampling, slices
from feedlab.plans import daily_load
from feedlab.sinks import tables
from feedlab.sources import schemas
from feedlab.state import bitmaps, first_seen, sketches
from feedlab.storage import checkpointed

DAYS = 30


def made(spark: SparkSession, rows: int) -> DataFrame:
    """The columns of ``events``, from hashes of the row number."""
    def drawn(tag: str, below: int):
        return F.pmod(F.xxhash64(F.lit(tag), "event_id"), F.lit(below))

    hot = drawn("hot", 3) == 0
    kind = F.element_at(F.array(*[F.lit(k) for k in ("view", "view", "click", "signup", "purchase")]), (drawn("kind", 5) + 1).cast("int"))
    other = F.when(drawn("receiver", 3) == 0, 5).otherwise(drawn("to", 200_000))
    second = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (drawn("at", DAYS * 86_400)).cast("decimal(18,6)"))
    return spark.range(rows).withColumnRenamed("id", "event_id").select(
        "event_id", (F.lit("2024-01-01").cast("timestamp_ntz") + second).alias("ts"),
        F.when(hot, 7).otherwise(drawn("user", 200_000)).cast("long").alias("user_id"), kind.alias("event_type"),
        F.lit(1.0).alias("value"), F.concat(F.lit('{"k": '), other.cast("string"), F.lit("}")).alias("props"))


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    root = os.environ.get("BENCH_ROOT") or tempfile.mkdtemp(prefix="feedlab-large-")
    spark = session.build("feedlab-large", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    made(spark, int(os.environ.get("BENCH_EVENTS", "20000000"))).write.parquet(f"{root}/events.parquet")
    events = sources.events(spark, root)
    feed, messages = sources.feed_actions(events), sources.message_actions(events)
    took: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        found = run()
        if isinstance(found, DataFrame):
            found.write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 2)

    feed.agg(F.count("*")).collect()
    timed("weekly_metrics", lambda: activity.daily(feed, "2024-01-22", days=7))
    timed("metrics_15min", lambda: activity.metrics_15min(feed, messages))
    timed("message_user_day", lambda: slices.message_user_day(messages))
    timed("daily_slices", lambda: slices.daily_slices(daily_load.joined_day(feed, messages)))
    timed("daily_slices by a join", lambda: slices.daily_slices(
        slices.join_user_day(slices.feed_user_day(feed), slices.message_user_day(messages))))
    timed("retention_curve", lambda: cohorts.retention_curve(feed, "2024-01-29"))
    timed("write_log", lambda: tables.write_log(feed, f"{root}/log"))
    log = sources.read_log(spark, f"{root}/log", schemas.FEED)
    timed("first_seen.build of 29 days", lambda: first_seen.build(log.filter("event_date < DATE '2024-01-30'"), f"{root}/first"))
    timed("first_seen.merge_day of one", lambda: first_seen.merge_day(log, f"{root}/first", "2024-01-30"))
    table = first_seen.stored(spark, f"{root}/first")
    timed("first_seen.retention_curve", lambda: first_seen.retention_curve(table, log, "2024-01-29"))
    timed("bitmaps.write_activity", lambda: bitmaps.write_activity(log, first_seen.read(spark, f"{root}/first"), f"{root}/bits"))
    timed("bitmaps.matrix", lambda: bitmaps.matrix(bitmaps.cohorts(table), bitmaps.read_activity(spark, f"{root}/bits")))
    timed("sketches.write_buckets", lambda: sketches.write_buckets(log, f"{root}/buckets"))
    timed("sketches.rolled_up by week", lambda: sketches.rolled_up(sketches.read_buckets(spark, f"{root}/buckets"), F.date_trunc("week", "ts")))
    users = checkpointed(experiments.user_ctr(feed, "2024-01-08", "2024-01-21", [1, 2]))
    timed("mann_whitney of users", lambda: hypothesis.mann_whitney(users, "ctr", (1, 2)))
    timed("A/A, 10,000 x 2 x 500", lambda: resampling.aa_simulation(users, (1, 2)))
    timed("Poisson bootstrap, 2,000 replicates", lambda: resampling.poisson_bootstrap(users, (1, 2)))
    timed("the same by counts", lambda: resampling.poisson_bootstrap_counts(users, (1, 2)))
    print(json.dumps({"metric": "large_runs_total", "value": round(sum(took.values()), 2), "unit": "sec",
                      "users": users.count(), "runs": took}))
    spark.stop()


if __name__ == "__main__":
    main()
