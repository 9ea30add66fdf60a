"""Results in the form in which engines can be compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, so that engines can be compared."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)}
    return df.select(*[F.round(c, 6).alias(c) if c in doubles else F.col(c) for c in df.columns])


def plain_buckets(df: DataFrame) -> DataFrame:
    """Outer-joined buckets for comparison: counts as doubles, the form data frames hold gaps in, and ISO dates."""
    counts = {"users_feed", "views", "likes", "users_message", "sent_message"}
    return (df.select(*[F.col(c).cast("double").alias(c) if c in counts else F.col(c) for c in df.columns])
            .withColumn("date", F.col("date").cast("string")))
