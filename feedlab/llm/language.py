"""Language of texts by the nearest of several centroids per language, over weighted byte n-grams.

A text is lower-cased, everything but letters becomes a space, and its byte n-grams (with a space at both ends)
are counted in a fixed number of cells. Counts are damped by a logarithm, weighted by inverse document frequency
and scaled to unit length. Each language has several centroids, found by clustering its texts by cosine. A text
takes the language of the nearest centroid; one that is farther from it than nearly all texts the centroid was
learned from is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from feedlab.llm.common import bounded_batches

#: Cells that n-grams are counted in (a power of two), and the lengths of n-grams in bytes.
CELLS = 1 << 14
GRAMS = (1, 2, 3, 4)

#: Texts of each language whose vectors are clustered, at most: those with the smallest hashes.
SAMPLE = 400

#: Languages that are learned, at most: those with the most texts in the sample.
LANGUAGES = 1000

#: Centroids of a language, and rounds of clustering.
CLUSTERS = 4
ROUNDS = 8

#: Share of a language's texts below which a cluster is given up: its texts may be of another language.
MINOR = 0.05

#: Share of a centroid's own texts that lie beyond its distance limit.
BEYOND = 0.005

#: How sharply the score tells apart languages with nearly equal cosines.
SHARPNESS = 20.0

#: Bytes of a text that are counted at a time.
PIECE = 1 << 20

UNKNOWN = "und"
LETTER = r"\p{L}"

_FOLD = np.full(256, 32, np.uint8)  # ASCII letters in lower case, other ASCII as spaces
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123, dtype=np.uint8)
_FOLD[128:] = np.arange(128, 256, dtype=np.uint8)
_MIX = np.uint32(0x9E3779B1)


def cells(data: np.ndarray) -> np.ndarray:
    """The cell of every n-gram of folded bytes; n-grams with two spaces side by side, and a space alone, are left out."""
    found = []
    code = np.zeros(len(data), np.uint32)
    blank = data == 32
    double = np.zeros(len(data), bool)
    for n in range(1, max(GRAMS) + 1):
        kept = len(data) - n + 1
        if kept <= 0:
            break
        code = (code[:kept] << np.uint32(8)) | data[n - 1:]
        if n > 1:
            double = double[:kept] | (blank[n - 2:n - 2 + kept] & blank[n - 1:])
        if n in GRAMS:
            # all four bytes are in the code; the length goes into the hash, so that lengths do not meet in one cell
            mixed = (code[~(double if n > 1 else blank)] + np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) * _MIX
            found.append((mixed ^ (mixed >> np.uint32(15))) * _MIX >> np.uint32(32 - CELLS.bit_length() + 1))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Cells in use and their counts, of a whole text of any length; a null text is empty."""
    data = _FOLD[np.frombuffer(f" {(text or '').lower()} ".encode("utf-8", "replace"), np.uint8)]
    total = np.zeros(CELLS, np.int64)
    over = max(GRAMS) - 1
    for start in range(0, len(data), PIECE):
        total += np.bincount(cells(data[start:start + PIECE + over]), minlength=CELLS)
        if start:  # n-grams that lie in the overlap alone were counted with the piece before
            total -= np.bincount(cells(data[start:start + over]), minlength=CELLS)
    used = np.flatnonzero(total)
    return used, total[used]


def unit(used: np.ndarray, number: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The weights of the cells in use, scaled to length one."""
    weight = (1 + np.log(number)) * idf[used]
    length = np.sqrt((weight * weight).sum())
    return weight / length if length else weight


def clustered(rows: np.ndarray, count: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``count`` unit centroids of unit rows, and the least cosine that each one's texts may have.

    Starts from the row nearest to the mean, then again and again from the row farthest from those taken, in the
    middle half of the rows by that distance, so that odd rows do not found clusters.
    """
    def scaled(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.sqrt((x * x).sum(axis=-1, keepdims=True)), 1e-12)

    taken = [int((rows @ scaled(rows.mean(axis=0))).argmax())]
    while len(taken) < min(count, len(rows)):
        near = (rows @ rows[taken].T).max(axis=1)
        if near.min() > 1 - 1e-6:
            break
        taken.append(int(near.argsort(kind="stable")[len(rows) // 4]) if len(rows) > 4 * count else int(near.argmin()))
    centers = rows[np.unique(taken)]
    for _ in range(rounds):
        owner = (rows @ centers.T).argmax(axis=1)
        centers = np.stack([scaled(rows[owner == k].sum(axis=0)) for k in np.unique(owner)])
    for again in (True, False):
        owner = (rows @ centers.T).argmax(axis=1)
        size = np.bincount(owner, minlength=len(centers))
        centers = centers[size >= (min(MINOR * len(rows), size.max()) if again else 1)]
    near = rows @ centers.T
    owner = near.argmax(axis=1)
    return centers, np.array([np.quantile(near[owner == k, k], BEYOND) for k in range(len(centers))])


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    languages: list[str]  # in order
    owner: np.ndarray  # the language of each centroid
    centers: np.ndarray  # float32, a row each
    least: np.ndarray  # cosine below which a text of that centroid is rejected

    def judge(self, texts: list[str | None]) -> pd.DataFrame:
        """lang, score, cosine, rejected of each text, whether it has letters or not."""
        near = np.zeros((len(texts), len(self.owner)))
        for k, text in enumerate(texts):
            used, number = counts(text)
            near[k] = self.centers[:, used] @ unit(used, number, self.idf).astype(np.float32)
        lang = np.stack([near[:, self.owner == k].max(axis=1) for k in range(len(self.languages))], axis=1)
        best = lang.argmax(axis=1)
        row = np.arange(len(texts))
        at = np.where(self.owner == best[:, None], near, -np.inf).argmax(axis=1)
        share = 1 / np.exp(SHARPNESS * (lang - lang[row, best][:, None])).sum(axis=1)
        return pd.DataFrame({"lang": [self.languages[b] for b in best], "score": share.round(6),
                             "cosine": near[row, at].clip(0, 1).round(6), "rejected": near[row, at] < self.least[at]})


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows never learned from: crc32 of the id as text can be divided by 5; a null id cannot."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each cell occurs, and how many there are, over all rows; a number a cell reaches the driver."""

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(CELLS + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                total[counts(text.as_py())[0]] += 1
            rows += batch.num_rows
        total[CELLS] = rows
        known = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(known), "texts": pa.array(total[known])})

    found = np.zeros(CELLS + 1, np.int64)
    for r in (texts.select("text").mapInArrow(used, "cell bigint, texts bigint")
              .groupBy("cell").agg(F.sum("texts").alias("texts")).collect()):
        found[r["cell"]] = r["texts"]
    return found[:CELLS], int(found[CELLS])


def sampled(known: DataFrame, size: int) -> DataFrame:
    """lang, text of ``size`` rows of each language, those with the smallest hashes of id and text.

    The limit of each language is found on hashes alone, so no text is sorted that is not taken.
    """
    keyed = known.withColumn("key", F.xxhash64("doc_id", "text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key"))

    def smallest(rows: DataFrame) -> DataFrame:
        return rows.withColumn("place", place).filter(F.col("place") <= size)  # each task keeps that many a language

    limits = (smallest(keyed.select("lang", "key")).groupBy("lang").agg(F.max("key").alias("limit"), F.count("*").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(LANGUAGES))
    few = keyed.join(F.broadcast(limits), "lang").filter(F.col("key") <= F.col("limit"))  # a row a language
    return smallest(few).select("lang", "text")


def counted(texts: DataFrame) -> DataFrame:
    """lang, used, number: the cells of each text and their counts, a few hundred kilobytes however long it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([u for u, _ in found], pa.list_(pa.int32())),
                 pa.array([n for _, n in found], pa.list_(pa.int64()))], names=["lang", "used", "number"])

    return texts.select("lang", "text").mapInArrow(run, "lang string, used array<int>, number array<bigint>")


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from the rows with a language that are not held out and have a letter; None if there are none.

    Document frequencies come from all of them, centroids from ``sample`` texts of each language at most
    (all of a language with fewer, 1,000 at most), for ``LANGUAGES`` languages. Each language is clustered by itself,
    from cells and counts, not texts; only centroids reach the driver.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    known = (docs.filter(F.col("lang").isNotNull() & ~held_out() & F.col("text").rlike(LETTER))
             .select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")))
    found, rows = frequencies(known)
    if not rows:
        return None
    idf = np.log((1 + rows) / (1 + found)) + 1

    def centroids(texts: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(texts), CELLS), np.float32)
        for k, (used, number) in enumerate(zip(texts["used"], texts["number"])):
            x[k, used] = unit(np.asarray(used), np.asarray(number), idf)
        centers, least = clustered(x[np.lexsort(x[:, :64].T)])  # in an order of their own, whatever the partitions
        return pd.DataFrame({"lang": texts["lang"].iloc[0], "center": list(centers.astype(float)), "least": least})

    held = (counted(sampled(known, min(sample, 1000))).groupBy("lang")
            .applyInPandas(centroids, "lang string, center array<float>, least double").collect())  # a few a language
    held.sort(key=lambda r: (r["lang"], r["least"], r["center"]))
    languages = sorted({r["lang"] for r in held})
    return Model(idf, languages, np.array([languages.index(r["lang"]) for r in held]),
                 np.array([r["center"] for r in held], np.float32), np.array([r["least"] for r in held]))


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, and a struct of the model's judgement of every text with a letter, null for the others."""
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(model)  # centroids and weights: 64 KB for each of them

    @F.pandas_udf("lang string, score double, cosine double, rejected boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return shared.value.judge(texts.tolist())

    text = F.col("text").cast("string")
    return docs.select("doc_id", held_out().alias("held_out"), text.rlike(LETTER).alias("letters"),
                       judge(text).alias("found"))


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cosine, rejected of every row of ``docs``.

    The language is ``und``, the score 0 and the row rejected if the text is null, empty or has no letter, or if
    there was nothing to learn from. Otherwise the language is a learned one, also for rejected texts: those
    whose cosine with the nearest centroid is below that centroid's limit. The score is the share of the
    language among all, between 0 and 1. Ties go to the first language by name. Repeated rows are judged each;
    a null id is not held out; further columns are ignored; an empty table gives no rows.
    """
    model = fit(docs, sample)
    if model is None:
        return docs.select("doc_id", held_out().alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"),
                           F.lit(0.0).alias("score"), F.lit(0.0).alias("cosine"), F.lit(True).alias("rejected"))
    known = F.coalesce("letters", F.lit(False))

    def found(field: str, otherwise: object) -> F.Column:
        return F.when(known, F.col("found").getField(field)).otherwise(F.lit(otherwise))

    return judged(docs, model).select(
        "doc_id", "held_out", found("lang", UNKNOWN).alias("lang_pred"), found("score", 0.0).alias("score"),
        found("cosine", 0.0).alias("cosine"), found("rejected", True).alias("rejected"))
