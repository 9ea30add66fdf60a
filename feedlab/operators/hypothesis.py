"""Two-sample tests. Only sufficient statistics reach the formulas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlab.functions.ratios import ratio
from feedlab.functions.tails import normal_pvalue, student_t_pvalue
from feedlab.operators.quantiles import parted

SIDES = ("1", "2")


def _in_group(value: str, group: str, side: int) -> Column:
    return F.when(F.col(group) == side, F.col(value))


def _welch_from_moments(moments: DataFrame, by: list[str]) -> DataFrame:
    """``moments`` has n, mean and var of both sides (suffixes 1 and 2)."""
    share1, share2 = F.col("var1") / F.col("n1"), F.col("var2") / F.col("n2")
    usable = (F.col("n1") > 1) & (F.col("n2") > 1)
    tested = (moments
              .withColumn("share1", F.when(usable, share1))
              .withColumn("share2", F.when(usable, share2))
              .withColumn("statistic", F.try_divide(F.col("mean1") - F.col("mean2"),
                                                    F.sqrt(F.col("share1") + F.col("share2"))))
              .withColumn("df", F.try_divide(
                  F.pow(F.col("share1") + F.col("share2"), 2),
                  F.pow("share1", 2) / (F.col("n1") - 1) + F.pow("share2", 2) / (F.col("n2") - 1))))
    return tested.select(*by, "n1", "n2", "mean1", "mean2", "statistic", "df",
                         student_t_pvalue(F.col("statistic"), F.col("df")).alias("pvalue"))


def welch(samples: DataFrame, value: str, pair: tuple[int, int], group: str = "exp_group",
          by: list[str] | None = None, nan_policy: str = "omit") -> DataFrame:
    """Welch's t-test of ``value`` between two groups, one row per ``by`` key.

    NULL values are left out, or make the whole test NULL with ``propagate``.
    """
    if nan_policy not in ("omit", "propagate"):
        raise ValueError("nan_policy is 'omit' or 'propagate'")
    by = by or []
    aggregates = []
    for side, member in zip(SIDES, pair):
        mine = _in_group(value, group, member)
        aggregates += [F.count(mine).alias(f"n{side}"), F.avg(mine).alias(f"mean{side}"),
                       F.var_samp(mine).alias(f"var{side}")]
    members = samples.filter(F.col(group).isin(list(pair)))
    missing = F.count_if(F.col(value).isNull()).alias("missing")
    moments = members.groupBy(*by).agg(*aggregates, missing)
    if nan_policy == "propagate":
        for side in SIDES:
            moments = moments.withColumn(f"mean{side}", F.when(F.col("missing") == 0, F.col(f"mean{side}")))
    return _welch_from_moments(moments, by)


def welch_linearized(users: DataFrame, control_group: int, test_group: int) -> DataFrame:
    """Welch's t-test of linearized likes without building the linearized column.

    With r the control CTR, mean and variance of likes - r * views follow from
    the means, variances and covariance of likes and views, so one scan gives
    both r and the test.
    """
    aggregates = []
    for side, member in zip(SIDES, (control_group, test_group)):
        likes, views = _in_group("likes", "exp_group", member), _in_group("views", "exp_group", member)
        aggregates += [F.count(likes).alias(f"n{side}"),
                       F.avg(likes).alias(f"likes{side}"), F.avg(views).alias(f"views{side}"),
                       F.var_samp(likes).alias(f"vl{side}"), F.var_samp(views).alias(f"vv{side}"),
                       F.covar_samp(likes, views).alias(f"lv{side}")]
    sums = (users.filter(F.col("exp_group").isin(control_group, test_group))
            .agg(*aggregates).withColumn("r", ratio("likes1", "views1")))
    r = F.col("r")

    def floored(variance: Column) -> Column:
        # likes exactly proportional to views: rounding may leave a variance just below zero
        return F.when(variance < 0, 0.0).otherwise(variance)

    for side in SIDES:
        sums = (sums
                .withColumn(f"mean{side}", F.col(f"likes{side}") - r * F.col(f"views{side}"))
                .withColumn(f"var{side}", floored(F.col(f"vl{side}") - 2 * r * F.col(f"lv{side}")
                                                  + r * r * F.col(f"vv{side}"))))
    return _welch_from_moments(sums, [])


def mann_whitney(samples: DataFrame, value: str, pair: tuple[int, int], group: str = "exp_group") -> DataFrame:
    """Two-sided Mann-Whitney U, normal approximation with tie and continuity correction.

    Works on counts per distinct value. The running count of the second group is
    taken inside value ranges (``quantiles.parted``); per-range totals then carry it
    across ranges, so no task sees more than one range.
    """
    first, second = (F.count_if(F.col(group) == member) for member in pair)
    counts = (samples.filter(F.col(group).isin(list(pair)) & F.col(value).isNotNull())
              .groupBy(value).agg(first.cast("double").alias("a"), second.cast("double").alias("b")))
    ranges = parted(counts, value)
    inside = Window.partitionBy("part").orderBy(value)
    below = F.sum("b").over(inside) - F.col("b")
    tied = F.col("a") + F.col("b")
    parts = (ranges
             .withColumn("wins", F.col("a") * (below + F.col("b") / 2))
             .withColumn("ties", F.pow(tied, 3) - tied)
             .groupBy("part").agg(F.sum("a").alias("a"), F.sum("b").alias("b"),
                                  F.sum("wins").alias("wins"), F.sum("ties").alias("ties")))
    # one row per shuffle partition from here on
    carried = F.sum("b").over(Window.orderBy("part")) - F.col("b")
    totals = (parts.withColumn("wins", F.col("wins") + F.col("a") * carried)
              .agg(F.coalesce(F.sum("a"), F.lit(0.0)).alias("n1"),
                   F.coalesce(F.sum("b"), F.lit(0.0)).alias("n2"),
                   F.sum("wins").alias("u1"), F.sum("ties").alias("ties")))
    n1, n2 = F.col("n1"), F.col("n2")
    n, product = n1 + n2, n1 * n2
    spread = F.sqrt(product / 12 * (n + 1 - F.try_divide(F.col("ties"), n * (n - 1))))
    larger = F.greatest(F.col("u1"), product - F.col("u1"))
    z = F.try_divide(larger - product / 2 - F.lit(0.5), F.when((n1 > 0) & (n2 > 0), spread))
    return (totals.withColumn("z", z)
            .select(n1.cast("long").alias("n1"), n2.cast("long").alias("n2"),
                    F.col("u1").alias("statistic"), "z", normal_pvalue(F.col("z")).alias("pvalue")))
