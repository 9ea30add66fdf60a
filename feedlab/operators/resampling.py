"""Repeated sampling: A/A simulation and Poisson bootstrap.

All draws are hashes of keys (``functions.hashing``), so a lost executor or
another partitioning gives the same samples.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlab.functions import hashing
from feedlab.functions.ratios import ratio
from feedlab.operators.histograms import histogram
from feedlab.operators.hypothesis import welch
from feedlab.storage import spread

# Iterations, sample size, replicates, significance and bins.
ITERATIONS = 10_000
SAMPLE = 500
REPLICATES = 2_000
ALPHA = 0.05
PVALUE_BINS = 50

CHUNKS = 1024


def numbered(users: DataFrame, method: str = "xxhash64", chunks: int = CHUNKS) -> tuple[DataFrame, DataFrame]:
    """Number the users of every group 0 … N-1, and the group sizes.

    Users are dealt to hash chunks and numbered inside them; the chunk sizes
    (at most ``chunks`` rows per group) give each chunk its first number.
    ``users`` is read twice.
    """
    dealt = users.withColumn("chunk", hashing.bucket(F.col("user_id"), chunks, method, tag="chunk"))
    sizes = dealt.groupBy("exp_group", "chunk").agg(F.count(F.lit(1)).alias("size"))
    # chunks x groups rows at most, so every task may have a copy
    starts = F.broadcast(sizes.select(
        "exp_group", "chunk",
        (F.sum("size").over(Window.partitionBy("exp_group").orderBy("chunk")) - F.col("size")).alias("start")))
    place = F.row_number().over(Window.partitionBy("exp_group", "chunk").orderBy("user_id")) - 1
    ranked = (dealt.withColumn("place", place).join(starts, ["exp_group", "chunk"])
              .withColumn("number", F.col("start") + F.col("place"))
              .drop("chunk", "place", "start"))
    return ranked, sizes.groupBy("exp_group").agg(F.sum("size").alias("population"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _drawn(n: int, seed: int | str, method: str) -> Column:
    """``n`` different numbers below ``population`` for one iteration and group: the first ``n`` different ones of
    an endless sequence of draws, which makes every set of ``n`` equally likely.

    The sequence is a hash of its place, so it can be looked up to any length. A quarter more draws than ``n`` are
    enough for a population beyond 4 n; smaller ones look further, up to where a shortfall has a chance below
    1e-20 for a population of exactly ``n``. The caller raises for a smaller one.
    """
    def sequence(length: int) -> Column:
        number = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: hashing.hash_long(
            F.lit(seed), F.col("exp_group"), F.col("iteration"), i, method=method) % F.col("population"))
        return F.array_distinct(number)

    def first(length: int, otherwise: Column) -> Column:
        return _let(sequence(length), lambda d: F.when(F.size(d) >= n, F.slice(d, 1, n)).otherwise(otherwise))

    none = F.raise_error(F.lit(f"fewer than {n} different draws")).cast("array<bigint>")
    found = first(n + n // 4 + 60, first(5 * n + 100, first(64 * n + 2000, none)))
    return F.when(F.col("population") >= n, found)


def sample_per_group(users: DataFrame, n: int, iterations: int, groups: list[int],
                     seed: int | str = 0, method: str = "xxhash64") -> DataFrame:
    """``n`` users of each group without replacement, for every iteration.

    The work is iterations x n draws joined to numbered users, independent of
    how large the groups are. Raises where a listed group has fewer than ``n``
    users, or none at all.
    """
    ranked, sizes = numbered(users.filter(F.col("exp_group").isin(groups)), method)
    session = users.sparkSession
    listed = session.createDataFrame([(g, 0) for g in groups], "exp_group INT, population BIGINT")
    sizes = sizes.unionByName(listed).groupBy("exp_group").agg(F.sum("population").alias("population"))
    cells = (session.range(0, iterations, 1, spread(session))
             .select(F.col("id").alias("iteration"),
                     F.explode(F.array(*[F.lit(g) for g in groups])).alias("exp_group"))
             .join(F.broadcast(sizes), "exp_group"))  # one row per listed group
    short = F.raise_error(F.concat(F.lit(f"cannot sample {n} of "), F.col("population").cast("string")))
    whole = F.when(F.col("population") < n, short.cast("array<bigint>")).otherwise(F.col("drawn"))
    draws = (cells.withColumn("drawn", _drawn(n, seed, method))
             .select("iteration", "exp_group", F.explode(whole).alias("number")))
    # every drawn number has its user; the outer form keeps listed groups without any, so that they raise
    return draws.join(ranked, ["exp_group", "number"], "left").drop("number")


def aa_simulation(users: DataFrame, pair: tuple[int, int] = (2, 3), n: int = SAMPLE,
                  iterations: int = ITERATIONS, value: str = "ctr", seed: int | str = 0,
                  method: str = "xxhash64") -> DataFrame:
    """Welch p-value of every iteration of an A/A test.

    Users without a value are not sampled. ``users`` is read twice: pass a
    checkpointed frame if it is dear.
    """
    eligible = users.filter(F.col(value).isNotNull()).select("exp_group", "user_id", value)
    samples = sample_per_group(eligible, n, iterations, list(pair), seed, method)
    return welch(samples, value, pair, by=["iteration"]).select("iteration", "statistic", "pvalue")


def false_positive_rate(simulation: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Share of iterations with p <= alpha, in percent; a missing p is not significant."""
    hit = F.coalesce(F.col("pvalue") <= alpha, F.lit(False))
    return simulation.agg(F.count(F.lit(1)).alias("iterations"), F.count_if(hit).alias("significant"),
                          (ratio(F.count_if(hit), F.count(F.lit(1))) * 100).alias("share_pct"))


def pvalue_histogram(simulation: DataFrame, bins: int = PVALUE_BINS) -> DataFrame:
    return histogram(simulation, "pvalue", bins)


def poisson_bootstrap(users: DataFrame, pair: tuple[int, int], replicates: int = REPLICATES,
                      numerator: str = "likes", denominator: str = "views", seed: int | str = 0,
                      method: str = "xxhash64", partitions: int | None = None) -> DataFrame:
    """Group ratio under ``replicates`` Poisson(1) reweightings of the users.

    The weights live only inside a task: it sums them per group and replicate,
    so groups x replicates rows leave it. The users are spread out first,
    because their bytes say little about the work they make.
    """
    session = users.sparkSession
    wide = (users.filter(F.col("exp_group").isin(list(pair)))
            .select("exp_group", "user_id", numerator, denominator)
            .repartition(partitions or spread(session), "user_id"))
    weight = hashing.poisson_weight(
        hashing.uniform(F.lit(seed), F.col("user_id"), F.col("replicate"), method=method))
    return (wide.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
            .withColumn("weight", weight)
            .groupBy("exp_group", "replicate")
            .agg(ratio(F.sum(F.col("weight") * F.col(numerator)),
                       F.sum(F.col("weight") * F.col(denominator))).alias("ctr")))


def poisson_bootstrap_counts(users: DataFrame, pair: tuple[int, int], replicates: int = REPLICATES,
                             numerator: str = "likes", denominator: str = "views", seed: int | str = 0) -> DataFrame:
    """The same ratios by the sum of Poisson draws, at a cost that follows the different users, not all of them.

    Users alike in both counts are one row with their number c, and c Poisson(1) weights add up to one Poisson(c)
    draw. A row's draws for all replicates come from a generator keyed by the row itself, so neither partitions
    nor lost tasks change them. Other draws than ``poisson_bootstrap``, of the same distribution.
    """
    session = users.sparkSession
    counted = (users.filter(F.col("exp_group").isin(list(pair)))
               .groupBy("exp_group", F.col(numerator).cast("double").alias("top"),
                        F.col(denominator).cast("double").alias("bottom"))
               .agg(F.count(F.lit(1)).alias("users")).na.fill(0.0, ["top", "bottom"]))
    own = [F.lit(str(seed)), F.col("exp_group"), F.col("top"), F.col("bottom")]
    keyed = counted.select("exp_group", "top", "bottom", "users", F.xxhash64(*own).alias("key1"),
                           F.xxhash64(F.lit("second"), *own).alias("key2"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for group, top, bottom, count, *key in zip(*[c.to_pylist() for c in batch.columns]):
                generator = np.random.Generator(np.random.Philox(key=[k % (1 << 64) for k in key]))
                weight = generator.poisson(count, replicates)
                sums.setdefault(group, np.zeros((2, replicates)))
                sums[group] += weight * np.array([[top], [bottom]])
        for group, (top, bottom) in sums.items():
            yield pa.RecordBatch.from_pydict({
                "exp_group": pa.array([group] * replicates, pa.int32()), "replicate": pa.array(range(replicates), pa.int32()),
                "top": pa.array(top), "bottom": pa.array(bottom)})

    spread_out = keyed.repartition(spread(session), "key1")
    return (spread_out.mapInArrow(draw, "exp_group int, replicate int, top double, bottom double")
            .groupBy("exp_group", "replicate").agg(ratio(F.sum("top"), F.sum("bottom")).alias("ctr")))


def bootstrap_difference(bootstrap: DataFrame, pair: tuple[int, int], value: str = "ctr") -> DataFrame:
    """Second group minus first, per replicate."""
    first, second = (F.max(F.when(F.col("exp_group") == g, F.col(value))) for g in pair)
    return bootstrap.groupBy("replicate").agg((second - first).alias("difference"))


def difference_interval(differences: DataFrame, level: float = 0.95) -> DataFrame:
    """Range and central interval of the differences; one row per replicate comes in."""
    tail = (1.0 - level) / 2.0
    column = F.col("difference")
    return differences.agg(
        F.count(column).alias("replicates"), F.avg(column).alias("mean"),
        F.min(column).alias("min"), F.max(column).alias("max"),
        F.percentile(column, tail).alias("low"), F.percentile(column, 1.0 - tail).alias("high"),
    ).withColumn("crosses_zero", (F.col("min") <= 0) & (F.col("max") >= 0))
