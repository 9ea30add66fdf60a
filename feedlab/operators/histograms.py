"""Equal-width histograms with a given or an automatic number of bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedlab.functions.ratios import ratio
from feedlab.operators.quantiles import attach, exact_quantiles, grouped
from feedlab.storage import checkpointed


def _quartile_range(rows: DataFrame, value: str, keys: list[str], members: list | None) -> DataFrame:
    quartiles = exact_quantiles(rows, value, [0.25, 0.75], keys[0] if keys else None, members)
    upper, lower = (F.max(F.when(F.col("prob") == q, F.col("quantile"))) for q in (0.75, 0.25))
    return quartiles.groupBy(*keys).agg((upper - lower).alias("iqr"))


def _auto_bins(stats: DataFrame) -> DataFrame:
    """Bin count from the Freedman-Diaconis, square-root and Sturges widths."""
    n, span = F.col("n").cast("double"), F.col("high") - F.col("low")
    by_spread = 2.0 * F.col("iqr") * F.pow(n, F.lit(-1.0 / 3.0))
    by_root = span / F.sqrt(n) / 2.0
    by_log = span / (F.log2(n) + 1.0)
    width = F.least(F.greatest(by_spread, by_root), by_log)
    return stats.withColumn("bins", F.when(width > 0, F.ceil(ratio(span, width))).otherwise(1).cast("int"))


def edges(rows: DataFrame, value: str, bins: int | str = "auto", by: str | None = None,
          members: list | None = None) -> DataFrame:
    """First and last edge, bin width and number of bins; one row per group."""
    known, keys = grouped(rows.filter(F.col(value).isNotNull()), by, members)
    stats = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).cast("double").alias("low"),
        F.max(value).cast("double").alias("high"))
    if bins == "auto":
        stats = _auto_bins(attach(stats, _quartile_range(known, value, keys, members), keys))
    else:
        stats = stats.withColumn("bins", F.lit(int(bins)))
    flat = F.col("low") == F.col("high")
    return (stats.filter(F.col("n") > 0)
            .withColumn("first", F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")))
            .withColumn("last", F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")))
            .select(*keys, "first", "last", "bins",
                    ((F.col("last") - F.col("first")) / F.col("bins")).alias("width")))


def histogram(rows: DataFrame, value: str, bins: int | str = "auto", by: str | None = None,
              members: list | None = None, common: bool = False) -> DataFrame:
    """Rows per bin, empty bins included; the last bin is closed.

    With ``by`` every group in ``members`` has its own edges, or all share them
    with ``common``. The edges are computed at once; ``rows`` is read more than
    once: pass a checkpointed frame if it is dear.
    """
    rows, shown = grouped(rows, by, members)
    keys = [] if common else shown
    # one row per group; kept, because both the counts and the empty bins need it
    grid = checkpointed(edges(rows, value, bins, None if common else by, members))
    x, index = F.col(value).cast("double"), F.col("bin")
    first, width = F.col("first"), F.col("width")
    spot = (attach(rows.filter(F.col(value).isNotNull()).select(*shown, value), grid, keys)
            .withColumn("bin", F.least(F.floor((x - first) / width), F.col("bins") - 1).cast("int"))
            # rounding may put a value next to an edge on its wrong side
            .withColumn("bin", F.when(x < first + index * width, index - 1)
                        .when((x >= first + (index + 1) * width) & (index < F.col("bins") - 1), index + 1)
                        .otherwise(index)))
    counts = spot.groupBy(*shown, "bin").agg(F.count(F.lit(1)).alias("rows"))
    groups = attach(rows.select(*shown).distinct(), grid, keys) if shown and common else grid
    every = groups.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)))
    end = F.when(index == F.col("bins") - 1, F.col("last")).otherwise(first + (index + 1) * width)
    return (every.join(counts, [*shown, "bin"], "left")
            .select(*shown, "bin", (first + index * width).alias("bin_start"), end.alias("bin_end"),
                    F.coalesce("rows", F.lit(0)).cast("long").alias("rows")))
