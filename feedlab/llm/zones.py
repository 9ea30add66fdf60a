"""Centroids fitted over blocks of vectors in Hilbert order, each with the box it fills.

Vectors are laid along a Hilbert curve through the components that vary most, so vectors next to each other on
it are near each other in space. A block of consecutive vectors keeps its least and greatest value of every
component. The nearest and farthest point of that box from a centroid bound the distances of all the block's
vectors, and a centroid whose nearest point is beyond another's farthest is no candidate. A block with one
candidate gives its stored sum; in the others every vector is compared with the candidates, all at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlab.llm.common import bounded_batches, stored
from feedlab.llm.vectors import first_rows, matrix, squared, whole_numbers

#: Components the curve runs through at most, and steps of each along it (a power of two).
AXES = 16
BITS = 4

#: Vectors of a block at most.
BLOCK = 512


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve, as one row of bytes for each row of whole numbers below 2**bits.

    From the highest bit down, each axis either mirrors the lower bits of the first axis or swaps them with
    its own; a Gray code over the axes then gives the digits of the place.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for k in range(axes):
            high = (x[k] >> bit) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[k]) & low)
            x[0] ^= np.where(high, low, swap)
            x[k] ^= swap
    for k in range(1, axes):
        x[k] ^= x[k - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn
    digits = [(x[k] >> bit) & 1 for bit in range(bits - 1, -1, -1) for k in range(axes)]
    return np.packbits(np.stack(digits, axis=1).astype(np.uint8), axis=1)


def _spread(rows: DataFrame, dims: int) -> list[tuple[float, int, int]]:
    """(variance, least, greatest) of each component, over all rows; one row reaches the driver."""
    c = [F.get("x", F.lit(k)) for k in range(dims)]
    found = rows.agg(*[f(v).alias(f"{name}{k}") for k, v in enumerate(c)
                       for name, f in (("v", F.var_pop), ("a", F.min), ("z", F.max))]).first()
    return [(found[f"v{k}"], found[f"a{k}"], found[f"z{k}"]) for k in range(dims)]


def zone_blocks(rows: DataFrame, dims: int, axes: int = AXES, bits: int = BITS, size: int = BLOCK) -> DataFrame:
    """The vectors of ``rows`` (vec_id, x) in blocks along the curve, stored.

    A block has vec_ids, x (its vectors in bytes), low and high (its box), total (the sum). Vectors of the same
    place are dealt further by a hash of the row, so that copies of one vector need not meet in one task.
    """
    spread = _spread(rows, dims)
    if spread[0][0] is None:  # no rows
        return stored(rows.limit(0).selectExpr("array(vec_id) AS vec_ids", "binary('') AS x", "x AS low", "x AS high",
                                               "x AS total"), "zones")
    chosen = sorted(range(dims), key=lambda k: (-spread[k][0], k))[:axes]
    low = np.array([spread[k][1] for k in chosen], np.int64)
    width = np.array([spread[k][2] - spread[k][1] + 1 for k in chosen], np.int64)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dims)
            place = hilbert((x[:, chosen] - low) * (1 << bits) // width, bits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p.tobytes() for p in place], pa.binary())],
                                             names=["vec_id", "x", "place"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                some = batch.slice(start, size)
                x = matrix(some.column(1), dims)
                offsets = pa.array([0, len(x)], pa.int32())
                numbers = {"low": x.min(axis=0), "high": x.max(axis=0), "total": x.sum(axis=0)}
                yield pa.RecordBatch.from_pydict({
                    "vec_ids": pa.ListArray.from_arrays(offsets, pa.concat_arrays([some.column(0)])),
                    "x": pa.array([x.astype(np.int32).tobytes()], pa.binary()),
                    **{name: pa.array([v], pa.list_(pa.int64())) for name, v in numbers.items()}})

    along = (rows.select("vec_id", "x").mapInArrow(keyed, "vec_id bigint, x array<bigint>, place binary")
             .withColumn("copy", F.xxhash64("vec_id", "x"))
             .repartitionByRange("place", "copy").sortWithinPartitions("place", "copy").select("vec_id", "x"))
    return stored(along.mapInArrow(blocks, "vec_ids array<bigint>, x binary, low array<bigint>, high array<bigint>, "
                                           "total array<bigint>"), "zones")


def candidates(low: np.ndarray, high: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest, ties included, to a vector of the box."""
    short = np.maximum(np.maximum(low - centers, centers - high), 0)
    far = np.maximum(np.abs(centers - low), np.abs(centers - high))
    return np.flatnonzero((short * short).sum(axis=1) <= (far * far).sum(axis=1).min())


def _box(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(name)[row].values.to_numpy() for name in ("low", "high"))


def _vectors(batch: pa.RecordBatch, row: int, dims: int) -> np.ndarray:
    return np.frombuffer(batch.column("x")[row].as_py(), np.int32).reshape(-1, dims).astype(np.int64)


def _sums(centers: np.ndarray):
    """A function from blocks to a task's sum and count of every centroid in use."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros_like(centers), np.zeros(len(centers), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                asked = candidates(*_box(batch, row), centers)
                if len(asked) == 1:
                    total[asked[0]] += batch.column("total")[row].values.to_numpy()
                    count[asked[0]] += len(batch.column("vec_ids")[row])
                    continue
                x = _vectors(batch, row, centers.shape[1])
                owner = asked[squared(x, centers[asked]).argmin(axis=1)]
                np.add.at(total, owner, x)
                np.add.at(count, owner, 1)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(used.astype(np.int32)), "rows": pa.array(count[used]),
            "sums": pa.array(list(total[used]), pa.list_(pa.int64()))})

    return sums


@dataclass(frozen=True)
class Fitted:
    """Centroids, a row each, and the blocks they were fitted on."""

    centers: np.ndarray
    blocks: DataFrame

    def digest(self, cluster: int) -> str:
        """Of a centroid's components, as decimal numbers joined by commas."""
        return hashlib.sha256(",".join(map(str, self.centers[cluster].tolist())).encode()).hexdigest()


def fit(vectors: DataFrame, dims: int = 64, clusters: int = 8, rounds: int = 10, seed: int = 3) -> Fitted | None:
    """Centroids after ``rounds`` rounds over all vectors of ``dims`` components; None if there are none.

    They start as the vectors with the smallest sha256 of ``seed:vec_id`` (equal ids by content, null ids last).
    The driver holds the centroids and their sums only.
    """
    bounded_batches(vectors.sparkSession)
    rows = whole_numbers(vectors, dims).select("vec_id", "x")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = first_rows(rows.withColumn("drawn", drawn), clusters, F.col("drawn").asc_nulls_last())
    if not first:
        return None
    centers = np.array([r["x"] for r in first], np.int64)
    blocks = zone_blocks(rows, dims)
    sums = [F.sum(F.get("sums", F.lit(i))) for i in range(dims)]
    for _ in range(rounds):
        found = blocks.mapInArrow(_sums(centers), "cluster int, rows bigint, sums array<bigint>")
        centers = centers.copy()
        for r in found.groupBy("cluster").agg(F.sum("rows").alias("rows"), F.array(*sums).alias("sums")).collect():
            centers[r["cluster"]] = np.array(r["sums"], np.int64) // r["rows"]
    return Fitted(centers, blocks)


def assign(fitted: Fitted) -> DataFrame:
    """vec_id, cluster, distance (squared) of every vector."""
    centers = fitted.centers

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                asked = candidates(*_box(batch, row), centers)
                apart = squared(_vectors(batch, row, centers.shape[1]), centers[asked])
                best = apart.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_ids")[row].values, pa.array(asked[best].astype(np.int32)),
                     pa.array(apart[np.arange(len(best)), best])], names=["vec_id", "cluster", "distance"])

    return fitted.blocks.mapInArrow(nearest, "vec_id bigint, cluster int, distance bigint")


def cluster(vectors: DataFrame, dims: int = 64, clusters: int = 8, rounds: int = 10, seed: int = 3) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every vector kept.

    Vectors that are null, of another length than ``dims``, or hold a null or non-finite component are left out.
    Equal distances go to the smaller number; repeated ids and null ids get a row each; fewer vectors than
    ``clusters`` make fewer centroids; an empty table gives no rows; further columns are ignored.
    """
    spark = vectors.sparkSession
    names = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    fitted = fit(vectors, dims, clusters, rounds, seed)
    if fitted is None:
        return spark.createDataFrame([], f"vec_id bigint, distance bigint, {names}").select(
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    rows = stored(assign(fitted), "clusters")
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    whole = sum(sums.values())
    about = spark.createDataFrame([(k, s, whole, fitted.digest(k)) for k, s in sums.items()], names)
    return (rows.join(F.broadcast(about), "cluster")  # one row for each centroid
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
