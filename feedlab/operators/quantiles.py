"""Exact quantiles of columns with any number of rows and distinct values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlab.storage import spread


def parted(values: DataFrame, x: str) -> DataFrame:
    """``values`` with ``part``, the number of the range of ``x`` a row lies in.

    The ranges are cut at approximate quantiles of ``x`` over the rows, from one mergeable summary that enters the
    plan as a scalar subquery. So the part is a function of the value, the same however often a task runs, and no
    range holds many more rows than another. ``values`` is in the plan twice; its shuffle is shared.
    """
    count = spread(values.sparkSession)
    probs = [k / count for k in range(1, count)] or [0.5]
    cuts = values.agg(F.percentile_approx(F.col(x).cast("double"), probs, 10 * count + 1000).alias("cuts")).scalar()
    stride = max(int(len(probs) ** 0.5), 1)
    at = F.col(x).cast("double")

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda cut: cut < at))

    # first among every stride-th cut, then among those up to the next such cut
    coarse = F.transform(F.sequence(F.lit(stride), F.lit(max(len(probs), stride)), F.lit(stride)),
                         lambda k: F.get("_cuts", k - 1))
    found = (values.withColumn("_cuts", cuts)
             .withColumn("_block", below(F.filter(coarse, lambda cut: cut.isNotNull())) * stride))
    return (found.withColumn("part", F.col("_block") + below(F.slice(F.col("_cuts"), F.col("_block") + 1, F.lit(stride))))
            .drop("_cuts", "_block"))


def grouped(rows: DataFrame, by: str | None, members: list | None) -> tuple[DataFrame, list[str]]:
    """Rows of the named groups, and the grouping columns.

    The groups are listed by the caller, so per-group statistics have at most
    that many rows and can be copied to every task.
    """
    if by is None:
        return rows, []
    if not members:
        raise ValueError(f"name the groups of {by}")
    return rows.filter(F.col(by).isin(list(members))), [by]


def attach(rows: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Add the statistics of the row's group; without groups they are one row, a scalar subquery."""
    if keys:
        return rows.join(F.broadcast(stats), keys)
    one = stats.select(F.struct(*stats.columns).alias("one")).scalar()
    return rows.withColumn("_one", one).select(*rows.columns, "_one.*")


def ranged_counts(rows: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Rows per distinct value, with the value range (``part``) each lies in."""
    counts = (rows.filter(F.col(value).isNotNull())
              .groupBy(*keys, F.col(value).cast("double").alias("x"))
              .agg(F.count(F.lit(1)).alias("rows")))
    return parted(counts, "x")


def exact_quantiles(rows: DataFrame, value: str, probs: list[float], by: str | None = None,
                    members: list | None = None) -> DataFrame:
    """Linearly interpolated quantiles, one row per group and probability.

    The value ranges are counted first, which tells the range that holds each
    wanted rank; only those ranges are ordered, one per task. Nothing runs at the
    call; the counts are in the plan more than once and their shuffle is shared.
    """
    rows, keys = grouped(rows, by, members)
    counts = ranged_counts(rows, value, keys)
    # one row per group and part
    whole = Window.partitionBy(*keys)
    parts = (counts.groupBy(*keys, "part").agg(F.sum("rows").alias("size"))
             .withColumn("start", F.sum("size").over(whole.orderBy("part")) - F.col("size"))
             .withColumn("n", F.sum("size").over(whole)))
    first, last = F.col("start"), F.col("start") + F.col("size") - 1
    wanted = (parts.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
              .withColumn("rank", F.col("prob") * (F.col("n") - 1))
              .filter(F.floor("rank").between(first, last) | F.ceil("rank").between(first, last)))
    # at most two parts per group and probability
    inside = Window.partitionBy(*keys, "prob", "part").orderBy("x")
    placed = (counts.join(F.broadcast(wanted), [*keys, "part"])
              .withColumn("upto", F.col("start") + F.sum("rows").over(inside)))

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("upto") > position, F.col("x")))

    ends = placed.groupBy(*keys, "prob", "rank").agg(
        at(F.floor("rank")).alias("lower"), at(F.ceil("rank")).alias("upper"))
    step = (F.col("upper") - F.col("lower")) * (F.col("rank") - F.floor("rank"))
    return ends.select(*keys, "prob", (F.col("lower") + step).alias("quantile"))
