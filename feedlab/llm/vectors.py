"""Vectors as whole numbers, in blocks that a task handles as one array, and exact distances between them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Steps of a unit: component x becomes floor(SCALE * x).
SCALE = 1024

#: Components beyond this size count as not finite: squared distances of 64 of them would not fit 64 bits.
LARGEST = float(1 << 16)


def whole_numbers(vectors: DataFrame, dims: int | None = None, column: str = "embedding") -> DataFrame:
    """vec_id, label, x (array of long), of the rows whose vector is there and finite.

    A vector is left out if it is null, empty, or holds a null, NaN, infinite or too large (``LARGEST``)
    component, and where ``dims`` is given, if it has another length. ``label`` is null where there is none.
    """
    x = F.col(column)
    good = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) <= LARGEST)) & (F.size(x) > 0)
    if dims is not None:
        good = good & (F.size(x) == dims)
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    return (vectors.filter(x.isNotNull() & good)
            .select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * SCALE)).alias("x")))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column of equal lengths as rows of int64."""
    flat = column.flatten().to_numpy(zero_copy_only=False) if len(column) else np.zeros(0)
    return flat.astype(np.int64, copy=False).reshape(len(column), dims)


def fits(dims: int, top: int) -> bool:
    """Whether squared distances of such numbers are exact as doubles, and so may be a matrix product."""
    return 4 * dims * top * top < 1 << 53


def squared(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Exact squared distances, points by centers."""
    top = int(max(np.abs(points).max(initial=0), np.abs(centers).max(initial=0)))
    kind = np.float64 if fits(points.shape[1], top) else np.int64
    p, c = points.astype(kind), centers.astype(kind)
    return ((p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def first_rows(frame: DataFrame, count: int, *order: Column) -> list:
    """The first rows in an order; equal vectors are equal rows, so ties by ``x`` leave nothing open."""
    return frame.orderBy(*order, "x").limit(count).collect()  # ``count`` rows at most


def with_total(rows: DataFrame, by: str, value: str, name: str, bound: int = 100_000, salts: int = 64) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows that share ``by`` (nulls together).

    Up to ``bound`` groups are copied to every task. More are joined, with every group's sum under
    ``salts`` keys, so that a group with a third of all rows is met in many tasks. ``rows`` is read twice or more.
    """
    totals = rows.groupBy(F.col(by).alias("_by")).agg(F.sum(value).alias(name))
    if totals.limit(bound + 1).count() <= bound:
        joined = rows.join(F.broadcast(totals), F.col(by).eqNullSafe(F.col("_by")), "left")
    else:
        dealt = totals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salted = rows.withColumn("_own", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
        joined = salted.join(dealt, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_own") == F.col("_salt")), "left")
    return joined.select(*rows.columns, name)
