"""MinHash fingerprints of documents and near-duplicates from bands of them.

Shingles are five words in a row, hashed to 64 bits by sums over the bytes; a universal family h -> a h + b
(mod 2^64, a odd) gives the permutations, and their minima are found for all permutations at once in numpy. A
fingerprint keeps 16 mixed bits of each minimum; the share of equal places estimates the Jaccard similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlab.llm.bytesums import ByteSums, mixed
from feedlab.llm.common import bounded_batches, document_key, partitions, range_bounds, range_of

WORDS = 5
PERMUTATIONS = 128

#: Bands of the signature and minima in each. At a similarity of 0.8 all 32 differ with a chance below 1e-7.
BANDS, ROWS = 32, 4

#: Ranges of ids for each task.
RANGES = 8

#: Shingles whose values under all permutations are held together.
STEP = 1024

_SEED = np.random.default_rng(20240102)
_A = _SEED.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _SEED.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
_PLACE = _SEED.integers(0, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes of every ``words`` words in a row of the text, A-Z as a-z; of all words if there are fewer."""
    data = np.frombuffer(text.encode("utf-8", "replace").lower(), np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _BLANK[data], [True]])))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    word = ByteSums(data).ranges(starts, ends)
    size = min(words, len(word))
    joined = np.zeros(len(word) - size + 1, np.uint64)
    for k in range(size):
        joined += word[k:len(word) - size + 1 + k] * _PLACE[k]
    return mixed(joined + np.uint64(size))


def signature(hashes: np.ndarray) -> np.ndarray:
    """16 bits for each permutation; of no shingles, all ones."""
    if not len(hashes):
        return np.full(PERMUTATIONS, 0xFFFF, np.uint16)
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), STEP):
        values = np.multiply.outer(_A, hashes[at:at + STEP])
        values += _B[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (mixed(least) >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, after: str) -> str:
    """The text with its last half (rounded down) replaced by as many first characters of the next, or all."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """The rows in ranges of ascending doc_id: _range, _guest, _id, doc_id, text.

    The first row of each range is also sent, as a guest, to the range before it (that of the first range
    to the last), so every row has the one after it in its own partition. Only ids are looked at to find
    the ranges; one row for each range is looked up and sent twice. There are ``RANGES`` ranges for each task, so that
    tasks get nearly the same number of rows; equal ids are in one range.
    """
    spark = docs.sparkSession
    rows = docs.select(document_key()[0], F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = rows.select("_id")
    placed = range_of(range_bounds(ids, RANGES * partitions(spark)))
    heads = ids.groupBy(placed.alias("_range")).agg(F.min("_id").alias("_id"))
    order = Window.orderBy("_range")  # one row for each range
    to = F.coalesce(F.lag("_range").over(order), F.max("_range").over(Window.partitionBy(F.lit(0))))
    guests = (rows.join(F.broadcast(heads.select("_id", to.alias("_range"))), "_id")
              .groupBy("_range", "_id", "doc_id").agg(F.min("text").alias("text"))
              .select("_range", F.lit(True).alias("_guest"), "_id", "doc_id", "text"))
    return rows.select(placed.alias("_range"), F.lit(False).alias("_guest"), "_id", "doc_id", "text").union(guests)


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The next document is the one after in ascending (doc_id, text), null ids first, and after the last the
    first; a lone row is its own next. Null texts are empty; texts without words have the same
    fingerprint, all ones; repeated rows follow each other; further columns are ignored; no rows, no rows.
    """
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None  # range, id, text, signature of the row whose next is awaited
        for batch in batches:
            done = []
            for place, guest, doc, none, text in zip(batch["_range"], batch["_guest"], batch["_id"], batch["none"],
                                                     batch["text"]):
                own = signature(shingles(text))
                if before and before[0] == place:
                    done.append(_compared(*before[1:], text, own))
                before = None if guest else (place, None if none else doc, text, own)
            yield pd.DataFrame(done, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                              "near_edited", "near_next"]).astype({"doc_id": "Int64"})

    rows = with_next(docs).withColumn("none", F.col("doc_id").isNull()).drop("doc_id")
    return (rows.repartitionByRange(partitions(spark), "_range").sortWithinPartitions("_range", "_guest", "_id", "text")
            .mapInPandas(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                              "edited_fingerprint string, near_edited double, near_next double"))


def _compared(doc: int | None, text: str, own: np.ndarray, after: str, after_own: np.ndarray) -> tuple:
    changed = edited(text, after)
    other = own if changed == text else signature(shingles(changed))
    return (doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.astype(">u2").tobytes().hex(),
            other.astype(">u2").tobytes().hex(), likeness(own, other), likeness(own, after_own))


def signatures(docs: DataFrame) -> DataFrame:
    """class, doc_id, bands, shingles of one representative of each distinct text (the smallest doc_id)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    distinct = texts.groupBy("text").agg(F.min("doc_id").alias("doc_id"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes = [np.unique(shingles(t)) for t in batch["text"]]
            bands = [signature(h).view(np.uint64).view(np.int64) if len(h) else [] for h in hashes]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "bands": bands,
                                "shingles": [h.view(np.int64) for h in hashes]})

    return distinct.mapInPandas(run, "doc_id long, bands array<long>, shingles array<long>")


def similar_pairs(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """a, b, jaccard of all pairs of distinct texts that share a band and are verified to be alike.

    Texts stand for their copies by the smallest doc_id (see ``membership``); texts without words are in no pair.
    """
    rows = signatures(docs.filter("doc_id IS NOT NULL"))
    bands = rows.select("doc_id", F.posexplode("bands").alias("k", "band"))
    pairs = (bands.select(F.col("doc_id").alias("a"), "k", "band")
             .join(bands.select(F.col("doc_id").alias("b"), "k", "band"), ["k", "band"])
             .filter("a < b").select("a", "b").distinct())
    held = rows.select("doc_id", "shingles")
    both = (pairs.join(held.toDF("a", "x"), "a").join(held.toDF("b", "y"), "b")
            .withColumn("shared", F.size(F.array_intersect("x", "y"))))
    jaccard = F.col("shared") / (F.size("x") + F.size("y") - F.col("shared"))
    return both.select("a", "b", jaccard.alias("jaccard")).filter(F.col("jaccard") >= similarity)


def membership(docs: DataFrame) -> DataFrame:
    """doc_id, class: the smallest doc_id with the same text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("hash"))
    return texts.join(texts.groupBy("hash").agg(F.min("doc_id").alias("class")), "hash").select("doc_id", "class")
