"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedlab.storage import fresh_path

#: Bytes of text that vectorised steps take at once, so that their arrays stay small.
SLICE_BYTES = 2 << 20

#: Stands for a null id where ids are keys.
LOWEST = -(1 << 63)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder once, and read from there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Have Spark cut what it sends to Python by bytes too, not by rows alone: texts differ much in length."""
    for name, most in (("spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20),
                       ("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)):
        spark.conf.set(name, str(most))


def partitions(spark: SparkSession) -> int:
    """Partition count of a shuffle, at least one for each core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def with_keys(docs: DataFrame, **keys: Column) -> DataFrame:
    """The columns of ``docs`` as one struct ``row``, next to keys: no name of theirs can clash with another."""
    own = keys or dict(zip(("_id", "_hash"), document_key()))
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(held, *[value.alias(name) for name, value in own.items()])


def without_keys(kept: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` out of ``row`` again, some of them replaced, in their order."""
    return kept.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns],
                       *[value.alias(c) for c, value in changed.items() if c not in docs.columns])


def document_key() -> tuple[Column, Column]:
    """_id, _hash: a row's place in the order of documents, its doc_id (null first), then a hash of its text."""
    return (F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("_id"),
            F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_hash"))


def range_bounds(ids: DataFrame, count: int) -> list[int]:
    """Bounds that cut the ids into about ``count`` ranges: at most so many numbers, whatever the corpus."""
    shares = [k / count for k in range(1, count)]
    found = ids.agg(F.percentile_approx("_id", shares, 10_000).alias("b")).first()["b"] if shares else []
    return sorted(set(found or []))


def range_of(bounds: list[int]) -> Column:
    """How many bounds are at or below the id: first among every stride-th, then among those up to the next."""
    if not bounds:
        return F.lit(0)
    stride = max(int(len(bounds) ** 0.5), 1)
    every = F.array(*[F.lit(b) for b in bounds[stride - 1::stride]])
    block = F.size(F.filter(every, lambda b: b <= F.col("_id"))) * stride
    rest = F.slice(F.array(*[F.lit(b) for b in bounds]), block + 1, F.lit(stride))
    return (block + F.size(F.filter(rest, lambda b: b <= F.col("_id")))).cast("int")


def plain(array: pa.Array) -> pa.Array:
    """A string array without nulls, in the small-offset layout, starting at its first value."""
    array = array.cast(pa.string()).fill_null("")
    return pa.concat_arrays([array]) if array.offset == 0 else pa.array(array.to_pylist(), pa.string())


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls are empty."""
    array = plain(array)
    offsets = np.frombuffer(array.buffers()[1], np.int32, len(array) + 1) if len(array) else np.zeros(1, np.int32)
    held = array.buffers()[2] if len(array) else None
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in pieces of about ``size`` bytes of text (one row at least)."""
    if not batch.num_rows:
        return
    texts = batch.column(batch.schema.get_field_index(column))
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    owner = (np.cumsum(lengths) - lengths) // size
    cuts = np.flatnonzero(np.diff(owner)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)
