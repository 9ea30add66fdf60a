"""Interquartile-range bands over metric series on a time grid.

A series holds one row per metric and grid step (96 per day), so its length is
set by the calendar and not by the number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from feedlab.functions.ratios import ratio

# The metrics that are watched, the band factor and the window.
METRICS = ["users_feed", "users_message", "views", "likes", "ctr"]
FACTOR = 3
WINDOW = 5


def long_series(wide: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """(ts, metric, value) rows from one column per metric."""
    names = metrics or METRICS
    doubles = wide.select("ts", *[F.col(m).cast("double").alias(m) for m in names])
    return doubles.unpivot("ts", names, "metric", "value")


def _ordered() -> WindowSpec:
    return Window.partitionBy("metric").orderBy("ts")


def densify(series: DataFrame, step: str = "15 minutes") -> DataFrame:
    """Add the grid steps a series skips between its first and last row, with NULL values."""
    width = F.expr(f"INTERVAL {step}")
    gap_end = F.coalesce(F.lead("ts").over(_ordered()) - width, F.col("ts"))
    filled = (series.withColumn("_steps", F.sequence("ts", gap_end, width))
              .withColumn("_at", F.explode("_steps")))
    return filled.select(F.col("_at").alias("ts"), "metric",
                         F.when(F.col("_at") == F.col("ts"), F.col("value")).alias("value"))


def iqr_bands(series: DataFrame, a: float = FACTOR, n: int = WINDOW, smooth: bool = False) -> DataFrame:
    """Quartiles of the ``n`` rows before each row and the bands around them.

    NULL unless all ``n`` rows before are there and have a value. ``smooth``
    replaces the upper band by its centred and the lower by its trailing mean.
    """
    ordered = _ordered()
    before = ordered.rowsBetween(-n, -1)

    def quartile(q: float) -> Column:
        return F.when(F.count("value").over(before) == n, F.percentile("value", q).over(before))

    bands = (series
             .withColumn("q25", quartile(0.25))
             .withColumn("q75", quartile(0.75))
             .withColumn("iqr", F.col("q75") - F.col("q25"))
             .withColumn("up", F.col("q75") + a * F.col("iqr"))
             .withColumn("low", F.col("q25") - a * F.col("iqr")))
    if smooth:
        ahead = (n - 1) // 2
        bands = (bands
                 .withColumn("up", F.avg("up").over(ordered.rowsBetween(ahead - n + 1, ahead)))
                 .withColumn("low", F.avg("low").over(ordered.rowsBetween(1 - n, 0))))
    return bands


def _is_alert() -> Column:
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("up"))
    return F.coalesce(outside, F.lit(False)).cast("int")


def flagged(bands: DataFrame) -> DataFrame:
    """Add ``is_alert`` and the deviation from the row before."""
    return (bands
            .withColumn("is_alert", _is_alert())
            .withColumn("previous", F.lag("value").over(_ordered()))
            .withColumn("deviation", F.abs(1 - ratio("value", "previous"))))


def _quartile_of(values: Column, q: float, n: int) -> Column:
    """Interpolated quantile of an array, NULL unless it has ``n`` values."""
    ordered = F.array_sort(values)
    place = q * (n - 1)
    low, high = int(place), min(int(place) + 1, n - 1)
    between = F.get(ordered, F.lit(low)) * (low + 1 - place) + F.get(ordered, F.lit(high)) * (place - low)
    return F.when(F.size(F.filter(values, lambda v: v.isNotNull())) == n, between)


def judged(seen: DataFrame, a: float = FACTOR, n: int = WINDOW) -> DataFrame:
    """Bands and flags as ``flagged`` gives them, for rows that carry the values ``before`` them, oldest first."""
    before = F.col("before")
    bands = (seen.withColumn("previous", F.element_at(F.when(F.size(before) > 0, before), -1))
             .withColumn("q25", _quartile_of(before, 0.25, n)).withColumn("q75", _quartile_of(before, 0.75, n))
             .withColumn("iqr", F.col("q75") - F.col("q25"))
             .withColumn("up", F.col("q75") + a * F.col("iqr"))
             .withColumn("low", F.col("q25") - a * F.col("iqr")).drop("before"))
    return (bands.withColumn("is_alert", _is_alert())
            .withColumn("deviation", F.abs(1 - ratio("value", "previous"))))


def latest(rows: DataFrame) -> DataFrame:
    """Last row of every metric."""
    return (rows.withColumn("_next", F.lead("ts").over(_ordered()))
            .filter(F.col("_next").isNull()).drop("_next"))


def alerts(wide: DataFrame, a: float = FACTOR, n: int = WINDOW, smooth: bool = False,
           metrics: list[str] | None = None) -> DataFrame:
    """Bands and flag on the last bucket of every metric, all metrics in one pass."""
    return latest(flagged(iqr_bands(long_series(wide, metrics), a, n, smooth)))
