"""The named queries: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlab import sources
from feedlab.catalog import parameters as p, state_queries
from feedlab.catalog.shape import plain_buckets, rounded
from feedlab.functions import hashing
from feedlab.functions.ratios import ratio
from feedlab.operators import (activity, anomaly, cohorts, experiments, histograms, hypothesis,
                               resampling, slices)
from feedlab.plans import daily_load, reports
from feedlab.sinks import files, tables
from feedlab.sources import schemas
from feedlab.storage import checkpointed, fresh_path
from feedlab.streaming import buckets, jobs

Query = Callable[[SparkSession, str], DataFrame]


def _feed(spark: SparkSession, folder: str) -> DataFrame:
    return sources.feed_actions(sources.events(spark, folder))


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return sources.message_actions(sources.events(spark, folder))


def _on_feed(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(make(_feed(spark, folder)))


def _on_messages(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(make(_messages(spark, folder)))


def _on_both(make: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(make(_feed(spark, folder), _messages(spark, folder)))


def _ab_users(feed: DataFrame, pair: tuple[int, int] = p.AB_PAIR) -> DataFrame:
    return experiments.user_ctr(feed, *p.AB_WEEK, list(pair))


def _aa_users(feed: DataFrame) -> DataFrame:
    return experiments.user_ctr(feed, *p.AA_WEEK, list(p.AA_PAIR))


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a population of two groups large enough for samples of 500."""
    first, second = p.AA_PAIR
    status = F.when(F.col("o_orderstatus") == "F", first).when(F.col("o_orderstatus") == "O", second)
    return checkpointed(spark.read.parquet(f"{folder}/orders.parquet").select(
        status.alias("exp_group"), F.col("o_orderkey").cast("long").alias("user_id"),
        F.col("o_totalprice").cast("double").alias("price")))


def _simulation(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.aa_simulation(_orders(spark, folder), p.AA_PAIR, p.SAMPLE, p.ITERATIONS, "price", p.AA_SEED, p.HASH)


def aa_simulation(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_simulation(spark, folder))


def aa_false_positive_rate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(resampling.false_positive_rate(_simulation(spark, folder)))


def pvalue_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(resampling.pvalue_histogram(checkpointed(_simulation(spark, folder)), p.PVALUE_BINS))


def _sample(feed: DataFrame) -> DataFrame:
    users = checkpointed(_aa_users(feed).filter(F.col("ctr").isNotNull()).select("exp_group", "user_id"))
    return resampling.sample_per_group(users, p.SMALL_SAMPLE, p.ITERATIONS, list(p.AA_PAIR), p.AA_SEED, p.HASH)


def sample_500_orders(spark: SparkSession, folder: str) -> DataFrame:
    """How often each order is in a sample, and the sum of the iterations it is in: ten million draws in short."""
    drawn = resampling.sample_per_group(_orders(spark, folder), p.SAMPLE, p.ITERATIONS, list(p.AA_PAIR), p.AA_SEED, p.HASH)
    return drawn.groupBy("exp_group", "user_id").agg(F.count("iteration").alias("samples"),
                                                     F.sum("iteration").alias("iterations"))


def _bootstrap(feed: DataFrame) -> DataFrame:
    return resampling.poisson_bootstrap(_ab_users(feed), p.AB_PAIR, p.REPLICATES,
                                        seed=p.BOOTSTRAP_SEED, method=p.HASH)


def _counted_bootstrap(feed: DataFrame) -> DataFrame:
    """Replicates per group, and whether their mean is within four standard errors of the group's ratio.

    The expected weight of every user is the same, so the ratio of sums is what the replicates vary around.
    """
    users = checkpointed(_ab_users(feed))
    drawn = resampling.poisson_bootstrap_counts(users, p.AB_PAIR, p.REPLICATES, seed=p.BOOTSTRAP_SEED)
    whole = users.groupBy("exp_group").agg(ratio(F.sum("likes"), F.sum("views")).alias("whole"))
    about = drawn.groupBy("exp_group").agg(F.count("ctr").alias("replicates"), F.avg("ctr").alias("mean"),
                                           F.stddev_samp("ctr").alias("sd"))
    # a ratio of means of n users is off by the order of its variance: one more standard deviation / sqrt(n)
    size = users.groupBy("exp_group").agg(F.count("user_id").alias("n"))
    allowed = 4 * F.col("sd") / F.sqrt("replicates") + F.col("sd") / F.sqrt("n")
    return (about.join(whole, "exp_group").join(size, "exp_group")
            .select("exp_group", "replicates", F.round("whole", 6).alias("ctr"),
                    (F.abs(F.col("mean") - F.col("whole")) <= allowed).alias("is_near")))


def _differences(feed: DataFrame) -> DataFrame:
    return resampling.bootstrap_difference(_bootstrap(feed), p.AB_PAIR)


def _bucket_ctr(feed: DataFrame) -> DataFrame:
    return experiments.bucket_ctr(_ab_users(feed), p.BUCKETS, p.HASH)


def _native_bucket_ctr(feed: DataFrame) -> DataFrame:
    return experiments.bucket_ctr(_ab_users(feed), p.BUCKETS)


def hashed_users(spark: SparkSession, folder: str) -> DataFrame:
    """XXH64 with seed 0 of every user id, and the bucket it gives."""
    users = _feed(spark, folder).select("user_id").filter(F.col("user_id").isNotNull()).distinct()
    return users.select("user_id", F.lpad(F.lower(F.hex(hashing.xxh64(F.col("user_id")))), 16, "0").alias("hash"),
                        hashing.bucket(F.col("user_id"), p.BUCKETS).alias("bucket"))


# --- sources and sinks -------------------------------------------------------

def source_tsv(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "feed_user_day_tsv")
    files.write_tsv(slices.feed_user_day(_feed(spark, folder)), path)
    return sources.read_tsv(spark, path, schemas.FEED_USER_DAY)


def source_tsv_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose columns stand in different orders, with a column the schema does not name."""
    path = fresh_path(spark, "feed_user_day_by_name")
    rows = slices.feed_user_day(_feed(spark, folder))
    early = F.col("event_date") < p.LITERAL_DAY
    files.write_tsv(rows.filter(early).select("likes", "age", F.lit("x").alias("extra"), "user_id", "os", "event_date",
                                              "views", "gender"), f"{path}/a")
    files.write_tsv(rows.filter(~early).select("event_date", "views", "likes", "os", "gender", "age", "user_id"), f"{path}/b")
    return sources.read_tsv(spark, f"{path}/*", schemas.FEED_USER_DAY)


def partitioned_log(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "feed_log")
    tables.write_log(_feed(spark, folder), path)
    return rounded(activity.daily(sources.read_log(spark, path, schemas.FEED), p.AS_OF, days=7))


def sql_user_ctr(spark: SparkSession, folder: str) -> DataFrame:
    text = """
        SELECT exp_group, user_id,
               count_if(action = 'like') AS likes, count_if(action = 'view') AS views,
               try_divide(CAST(likes AS DOUBLE), views) AS ctr
        FROM {feed}
        WHERE to_date(time) BETWEEN :first AND :last AND exp_group IN (:a, :b)
        GROUP BY exp_group, user_id"""
    args = {"first": p.AB_WEEK[0], "last": p.AB_WEEK[1], "a": p.AB_PAIR[0], "b": p.AB_PAIR[1]}
    return rounded(sources.run_sql(spark, text, args, feed=_feed(spark, folder)))


def daily_slices_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "daily_slices")
    daily_load.load_days(_feed(spark, folder), _messages(spark, folder), path)
    # the same day again replaces itself
    daily_load.load_day(_feed(spark, folder), _messages(spark, folder), p.AS_OF, path)
    return tables.read_slices(spark, path)


def daily_slices_table(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "daily_slices_table")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.create_slices_table(spark, name, path)
    joined = daily_load.joined_day(_feed(spark, folder), _messages(spark, folder))
    tables.write_slices_table(slices.daily_slices(joined), name)
    return spark.table(name)


def daily_slices_table_again(spark: SparkSession, folder: str) -> DataFrame:
    """All days, then one of them again, in a session that overwrites whole tables by default."""
    path = fresh_path(spark, "daily_slices_table_again")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.create_slices_table(spark, name, path)
    rows = checkpointed(slices.daily_slices(daily_load.joined_day(_feed(spark, folder), _messages(spark, folder))))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        tables.write_slices_table(rows, name)
        tables.write_slices_table(rows.filter(F.col("event_date") == p.LITERAL_DAY), name)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    return spark.table(name)


def audience_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "audience_csv")
    reports.audience_csv(_feed(spark, folder), path, p.AUDIENCE)
    return rounded(spark.read.schema(
        "age INT, os STRING, gender INT, users BIGINT, actions_per_user DOUBLE")
        .option("header", True).csv(path))


# --- streams -----------------------------------------------------------------

def stream_metrics_15min(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "stream_metrics")
    feed = sources.feed_actions(sources.stream_events(spark, folder))
    jobs.write_buckets(buckets.feed_buckets(feed), f"{path}/buckets", f"{path}/state").awaitTermination()
    return rounded(spark.read.schema(
        "ts TIMESTAMP_NTZ, users_feed BIGINT, views BIGINT, likes BIGINT, ctr DOUBLE")
        .parquet(f"{path}/buckets"))


def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "stream_alerts")
    feed = sources.feed_actions(sources.stream_events(spark, folder))
    messages = sources.message_actions(sources.stream_events(spark, folder))
    sides = {"feed": (buckets.feed_buckets(feed), ["users_feed", "views", "likes", "ctr"]),
             "messages": (buckets.message_buckets(messages), ["users_message"])}
    running = [jobs.write_alerts(jobs.alerts(stream, metrics), f"{path}/{side}/alerts", f"{path}/{side}/state")
               for side, (stream, metrics) in sides.items()]
    for query in running:
        query.awaitTermination()
    found = [jobs.read_alerts(spark, f"{path}/{side}/alerts") for side in sides]
    return rounded(found[0].unionByName(found[1]).select("metric", "ts", "value", "up", "low", "is_alert"))


def stream_daily_slices(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "stream_slices")
    feed = sources.feed_actions(sources.stream_events(spark, folder))
    messages = sources.message_actions(sources.stream_events(spark, folder))
    jobs.start_slices(feed, messages, f"{path}/partials", f"{path}/slices", f"{path}/state").awaitTermination()
    return tables.read_slices(spark, f"{path}/slices")


QUERIES: dict[str, Query] = {
    # sources and sinks
    "source_tsv": source_tsv,
    "source_tsv_by_name": source_tsv_by_name,
    "partitioned_log": partitioned_log,
    "sql_user_ctr": sql_user_ctr,
    "daily_slices_sink": daily_slices_sink,
    "daily_slices_table": daily_slices_table,
    "daily_slices_table_again": daily_slices_table_again,
    "audience_csv": audience_csv,
    # daily metrics
    "daily_metrics": _on_feed(lambda feed: activity.daily(feed, p.AS_OF)),
    "weekly_metrics": _on_feed(lambda feed: activity.daily(feed, p.AS_OF, days=7)),
    "dau": _on_feed(lambda feed: activity.dau(feed, p.AS_OF)),
    "ctr_daily": _on_feed(lambda feed: activity.ctr_daily(feed, p.AS_OF)),
    "dau_by_source": _on_feed(lambda feed: activity.dau_by_source(feed, p.AS_OF)),
    "views_per_user": _on_feed(lambda feed: activity.views_per_user(feed, p.AS_OF)),
    "pccu_feed": _on_feed(lambda feed: activity.peak_per_hour(feed, p.PEAK_DAY)),
    "pccu_message": _on_messages(lambda messages: activity.peak_per_hour(messages, p.PEAK_DAY)),
    "pccu_feed_distinct": _on_feed(lambda feed: activity.peak_per_hour(feed, p.PEAK_DAY, distinct=True)),
    "active_audience": _on_feed(lambda feed: activity.active_audience(feed, p.AUDIENCE)),
    # daily load
    "feed_user_day": _on_feed(slices.feed_user_day),
    "feed_user_day_literal": _on_feed(lambda feed: slices.feed_user_day(feed, literal=True)),
    "message_user_day": _on_messages(slices.message_user_day),
    "message_user_day_literal": _on_messages(
        lambda messages: slices.message_user_day_literal(messages, p.LITERAL_DAY)),
    "feed_message_join": _on_both(daily_load.joined_day),
    "feed_message_join_literal": _on_both(
        lambda feed, messages: daily_load.joined_day_literal(feed, messages, p.LITERAL_DAY)),
    "feed_message_join_full": _on_both(lambda feed, messages: daily_load.joined_day(feed, messages, how="full")),
    "daily_slices_literal": _on_both(lambda feed, messages: slices.daily_slices(
        daily_load.joined_day_literal(feed, messages, p.LITERAL_DAY))),
    "slice_by_os": _on_both(lambda feed, messages: slices.slice_by(daily_load.joined_day(feed, messages), "os")),
    "slice_by_age": _on_both(lambda feed, messages: slices.slice_by(daily_load.joined_day(feed, messages), "age")),
    "slice_by_gender": _on_both(
        lambda feed, messages: slices.slice_by(daily_load.joined_day(feed, messages), "gender")),
    "daily_slices": _on_both(lambda feed, messages: slices.daily_slices(daily_load.joined_day(feed, messages))),
    "daily_slices_union": _on_both(
        lambda feed, messages: slices.daily_slices_union(daily_load.joined_day(feed, messages))),
    # cohorts
    "new_users": _on_feed(lambda feed: cohorts.new_users(feed, p.NEW_USERS_AS_OF)),
    "user_active_days": _on_feed(cohorts.user_active_days),
    "retention_day1": _on_feed(lambda feed: cohorts.retention_day1(feed, p.RETENTION_AS_OF)),
    "retention_curve": _on_feed(lambda feed: cohorts.retention_curve(feed, p.CURVE_AS_OF, p.CURVE_AGE)),
    # state kept between runs
    **state_queries.QUERIES,
    # 15-minute metrics and alerts
    "metrics_15min": _on_both(lambda feed, messages: plain_buckets(activity.metrics_15min(feed, messages))),
    "metrics_15min_closed": _on_both(
        lambda feed, messages: plain_buckets(activity.metrics_15min(feed, messages, p.ALERT_AS_OF))),
    "iqr_bands": _on_both(
        lambda feed, messages: anomaly.iqr_bands(anomaly.long_series(activity.metrics_15min(feed, messages)))),
    "iqr_bands_smoothed": _on_both(
        lambda feed, messages: anomaly.iqr_bands(
            anomaly.long_series(activity.metrics_15min(feed, messages)), smooth=True)),
    "iqr_bands_dense": _on_both(
        lambda feed, messages: anomaly.iqr_bands(anomaly.densify(
            anomaly.long_series(activity.metrics_15min(feed, messages))))),
    "alert_flags": _on_both(
        lambda feed, messages: anomaly.alerts(activity.metrics_15min(feed, messages, p.ALERT_AS_OF))),
    # reports
    "report_daily_text": _on_feed(lambda feed: reports.daily_text(feed, p.AS_OF)),
    "report_app_text": _on_feed(lambda feed: reports.app_text(feed, p.RETENTION_AS_OF)),
    "alert_text": _on_both(lambda feed, messages: reports.alert_text(feed, messages, p.ALERT_AS_OF)),
    "weekly_chart": _on_feed(lambda feed: reports.weekly_chart(feed, p.AS_OF)),
    "source_chart": _on_feed(lambda feed: reports.source_chart(feed, p.AS_OF)),
    "views_chart": _on_feed(lambda feed: reports.views_chart(feed, p.AS_OF)),
    "peak_chart": _on_feed(lambda feed: reports.peak_chart(feed, p.PEAK_DAY)),
    "retention_chart": _on_feed(lambda feed: reports.retention_chart(feed, p.CURVE_AS_OF, p.CURVE_AGE)),
    "alert_chart": _on_both(lambda feed, messages: reports.alert_chart(feed, messages, p.ALERT_AS_OF)),
    # experiments
    "user_ctr": _on_feed(_ab_users),
    "group_sizes": _on_feed(lambda feed: experiments.group_sizes(_aa_users(feed))),
    "welch_ctr": _on_feed(lambda feed: hypothesis.welch(_ab_users(feed), "ctr", p.AB_PAIR)),
    "linearized_likes": _on_feed(
        lambda feed: experiments.linearized_likes(checkpointed(_ab_users(feed)), p.AB_PAIR[0])),
    "welch_linearized_12": _on_feed(lambda feed: hypothesis.welch_linearized(_ab_users(feed), *p.AB_PAIR)),
    "welch_linearized_03": _on_feed(
        lambda feed: hypothesis.welch_linearized(_ab_users(feed, p.OTHER_PAIR), *p.OTHER_PAIR)),
    "bucket_ctr": _on_feed(_bucket_ctr),
    "bucket_ctr_xxhash64": _on_feed(_native_bucket_ctr),
    "hashed_users": hashed_users,
    "mann_whitney_bucket": _on_feed(
        lambda feed: hypothesis.mann_whitney(_bucket_ctr(feed), "bucket_ctr", p.AB_PAIR)),
    "mann_whitney_users": _on_feed(lambda feed: hypothesis.mann_whitney(_ab_users(feed), "ctr", p.AB_PAIR)),
    "ctr_histogram": _on_feed(
        lambda feed: histograms.histogram(checkpointed(_ab_users(feed)), "ctr", by="exp_group", members=p.AB_PAIR)),
    "ctr_histogram_by_group": _on_feed(
        lambda feed: histograms.histogram(checkpointed(_ab_users(feed)), "ctr", by="exp_group", members=p.AB_PAIR, common=True)),
    "bucket_histogram": _on_feed(
        lambda feed: histograms.histogram(checkpointed(_bucket_ctr(feed)), "bucket_ctr", by="exp_group", members=p.AB_PAIR)),
    # resampling
    "sample_n_per_group": _on_feed(_sample),
    "sample_500_orders": sample_500_orders,
    "aa_simulation": aa_simulation,
    "aa_false_positive_rate": aa_false_positive_rate,
    "pvalue_histogram": pvalue_histogram,
    "poisson_bootstrap": _on_feed(_bootstrap),
    "poisson_bootstrap_counts": _on_feed(_counted_bootstrap),
    "bootstrap_diff_ci": _on_feed(lambda feed: resampling.difference_interval(_differences(feed))),
    "bootstrap_histogram": _on_feed(
        lambda feed: histograms.histogram(checkpointed(_bootstrap(feed)), "ctr", by="exp_group", members=p.AB_PAIR)),
    "bootstrap_diff_histogram": _on_feed(
        lambda feed: histograms.histogram(checkpointed(_differences(feed)), "difference")),
    # streams
    "stream_metrics_15min": stream_metrics_15min,
    "stream_alerts": stream_alerts,
    "stream_daily_slices": stream_daily_slices,
}
