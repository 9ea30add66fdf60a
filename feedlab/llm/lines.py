"""Repeated passages of lines: overlapping three-line windows, hashed and compared over the whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedlab.llm.common import document_key, with_keys, without_keys

WINDOW = 3


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n", -1)


def windows(docs: DataFrame) -> DataFrame:
    """_id, _hash, at, h1, h2 of every three consecutive lines; h1 and h2 are 128 bits of the three.

    Documents of fewer lines have none.
    """
    def hashed(at: Column) -> Column:
        own = [F.get("lines", at + k) for k in range(WINDOW)]
        return F.struct(at.alias("at"), F.xxhash64(*own).alias("h1"), F.xxhash64(F.lit(1), *own[::-1]).alias("h2"))

    split = docs.select(*document_key(), _lines("text").alias("lines")).filter(F.size("lines") >= WINDOW)
    places = F.sequence(F.lit(0), F.size("lines") - WINDOW)
    return split.select("_id", "_hash", F.explode(F.transform(places, hashed)).alias("w")).select(
        "_id", "_hash", "w.at", "w.h1", "w.h2")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """_id, _hash, drop: the places of the lines that later occurrences of repeated windows cover.

    The first occurrence of a window (smallest document, then place) stays whole: a later one that overlaps it
    in the same document covers only what lies behind it.
    """
    every = windows(docs)
    place = F.struct("_id", "_hash", "at")
    first = (every.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .filter("first != last").select("h1", "h2", "first"))
    same = (F.col("_id") == F.col("first._id")) & (F.col("_hash") == F.col("first._hash"))
    start = F.when(same, F.greatest(F.col("at"), F.col("first.at") + WINDOW)).otherwise(F.col("at"))
    later = (every.join(first, ["h1", "h2"]).filter(~same | (F.col("at") > F.col("first.at")))
             .select("_id", "_hash", start.alias("start"), (F.col("at") + WINDOW).alias("end"))
             .filter("start < end"))
    merged = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["end"] - 1))))
    return (later.groupBy("_id", "_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
            .select("_id", "_hash", merged.alias("drop")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with all its columns, ``text`` without the lines that repeat an earlier passage.

    A passage is three lines or more that stand, one after another, anywhere else before: in an earlier
    document by (doc_id, hash of the text), or further up in the same one. Adds n_lines and n_removed. A null
    text is one empty line; documents of fewer than three lines stay as they are; rows alike in id and text
    are one document, and all of them keep what it keeps; a document may become empty; null ids come first;
    columns named n_lines or n_removed are replaced, others are kept.

    A hot passage costs one row per task before the shuffle (its first occurrence is a map-side minimum), and
    the join back to all occurrences is one that Spark may split. What a document gathers is bounded by its lines.
    """
    rows = with_keys(docs).withColumn("lines", F.split(F.coalesce(F.col("row.text").cast("string"), F.lit("")), "\n", -1))
    joined = rows.join(repeated_lines(docs), ["_id", "_hash"], "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    text = F.when(F.col("drop").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(kept, lambda at: F.get("lines", at)), "\n"))
    removed = F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop"))
    return without_keys(joined, docs, text=text, n_lines=F.size("lines").cast("long"), n_removed=removed.cast("long"))
