"""Quality of texts by a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from feedlab.llm.common import bounded_batches, stored

#: Names of the statistics, in the order of the vector.
STATISTICS = ["chars", "words", "word_length", "upper", "digits", "symbols", "stops", "space", "newlines",
              "beyond_ascii", "distinct_words", "repeated_next", "distinct_pairs", "distinct_lines", "entropy"]

SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~!"
STOPS = b".,;:?'\"()-"

_KIND = np.zeros(256, np.int64)  # 0 other, 1 upper, 2 lower, 3 digit, 4 symbol, 5 stop, 6 space, 7 newline, 8 not ASCII
for _codes, _kind in ((range(65, 91), 1), (range(97, 123), 2), (range(48, 58), 3), (SYMBOLS, 4), (STOPS, 5),
                      (b" \t\r\x0b\x0c", 6), (b"\n", 7), (range(128, 256), 8)):
    _KIND[list(_codes)] = _kind


def _share(part: float, whole: float) -> float:
    """A share on the logit scale, kept finite at 0 and 1."""
    p = part / whole if whole else 0.0
    return float(np.log((p + 0.005) / (1.005 - p)))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text; a null text counts as empty."""
    data = (text or "").encode("utf-8", "replace")
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    kind = np.bincount(_KIND, weights=count, minlength=9)
    words = data.split()
    n, w = len(data), len(words)
    letters = kind[1] + kind[2]
    p = count[count > 0] / max(n, 1)
    nexts = list(zip(words, words[1:]))
    lines = [x for x in data.split(b"\n") if x]
    return [
        float(np.log1p(n)), float(np.log1p(w)), float(np.log1p(sum(map(len, words)) / w if w else 0.0)),
        _share(kind[1], letters), _share(kind[3], n), _share(kind[4], n), _share(kind[5], n), _share(kind[6], n),
        _share(kind[7], n), _share(kind[8], n), _share(len(set(words)), w),
        _share(sum(a == b for a, b in nexts), w), _share(len(set(nexts)), max(w - 1, 0)),
        _share(len(set(lines)), len(lines)), float(-(p * np.log2(p)).sum()) if n else 0.0,
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def statistics_column(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(t) for t in texts])


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussian classes: means, inverse Cholesky factors of the covariances, log terms."""

    center: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    whiten: tuple[np.ndarray, ...]  # inverse of the lower Cholesky factor: whitened rows give Mahalanobis distances
    constant: tuple[float, ...]  # log prior minus half the log determinant

    def log_density(self, x: np.ndarray, k: int) -> np.ndarray:
        z = (x - self.means[k]) @ self.whiten[k].T
        return self.constant[k] - 0.5 * (z * z).sum(axis=1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """Of class 1."""
        if len(self.means) < 2:
            return np.full(len(rows), self.constant[0])
        x = (rows - self.center) / self.scale
        margin = self.log_density(x, 1) - self.log_density(x, 0)
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def moments(rows: DataFrame) -> DataFrame:
    """label, cells: per class the upper triangle of sums of products of (1, ``x``); ``rows`` has label, x (array).

    Sums are partial before the shuffle, so what is shuffled does not grow with the rows.
    """
    values = [F.lit(1.0), *[F.get("x", F.lit(k)) for k in range(len(STATISTICS))]]
    sums = [F.sum(values[i] * values[j]) for i, j in zip(*np.triu_indices(len(values)))]
    return rows.groupBy("label").agg(F.array(*sums).alias("cells"))


def solve(cells: dict[int, np.ndarray], pooling: float, ridge: float) -> Discriminant:
    """The discriminant from the moment matrix of each class.

    Covariances shrink towards the pooled one by ``pooling`` and towards the identity (statistics are
    scaled to unit variance) by ``ridge``. With one class only, or none, every score is the same:
    1, 0, or one half.
    """
    d = len(STATISTICS)
    known = {k: m for k, m in cells.items() if k in (0, 1) and m[0, 0] > 0}
    if len(known) < 2:
        prior = {(): 0.5, (0,): 0.0, (1,): 1.0}[tuple(known)]
        return Discriminant(np.zeros(d), np.ones(d), (), (), (prior,))
    both = known[0] + known[1]
    n = both[0, 0]
    center = both[0, 1:] / n
    scale = np.sqrt(np.maximum(np.diag(both)[1:] / n - center**2, 0))
    scale[scale < 1e-9] = 1.0
    means, spread = [], []
    for k in (0, 1):
        m, size = known[k], known[k][0, 0]
        mean = m[0, 1:] / size
        spread.append((m[1:, 1:] - size * np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - center) / scale)
    pooled = (spread[0] + spread[1]) / n
    whiten, constant = [], []
    for k in (0, 1):
        size = known[k][0, 0]
        s = (1 - pooling) * spread[k] / size + pooling * pooled
        factor = np.linalg.cholesky((1 - ridge) * s + ridge * np.eye(d))
        whiten.append(np.linalg.inv(factor))
        constant.append(float(np.log(size / n) - np.log(np.diag(factor)).sum()))
    return Discriminant(center, scale, tuple(means), tuple(whiten), tuple(constant))


def held_out(doc_id: str) -> F.Column:
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4; a null id does not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(known: DataFrame, labels: DataFrame, pooling: float = 0.3, ridge: float = 0.05) -> Discriminant:
    """Learn from all documents with a label (``doc_id``, ``quality`` 0 or 1) that are not held out.

    ``known`` has doc_id and x, the statistics. Nothing is sampled: sums over all labelled rows are gathered on
    Spark, and 136 numbers a class reach the driver. Other labels, null labels and labels without a document are left
    out; a repeated label counts as often as it stands there.
    """
    wanted = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & ~held_out("id"))
    rows = known.select(F.col("doc_id").alias("id"), "x").join(wanted, "id").select("label", "x")
    upper = np.triu_indices(len(STATISTICS) + 1)
    cells: dict[int, np.ndarray] = {}
    for r in moments(rows).collect():  # at most two rows
        half = np.zeros((len(STATISTICS) + 1,) * 2)
        half[upper] = r["cells"]
        cells[r["label"]] = half + half.T - np.diag(np.diag(half))
    return solve(cells, pooling, ridge)


def described(docs: DataFrame) -> DataFrame:
    """doc_id, x: the statistics of every whole text."""
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", statistics_column("text").alias("x"))


def score(model: Discriminant, x: F.Column) -> F.Column:
    """Probability of class 1 for statistics ``x``, to six decimals."""

    @F.pandas_udf(DoubleType())
    def probability(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype=float)
        return pd.Series(model.probability(np.stack(rows.to_list())).round(6))

    return probability(x)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Null and empty texts are scored like others (all shares 0); repeated rows are scored each; further
    columns are ignored; no documents give no rows.
    """
    known = stored(described(docs), "statistics")  # 15 numbers a document, made once for fitting and scoring
    model = fit(known, labels)
    return known.select("doc_id", held_out("doc_id").alias("held_out"), score(model, F.col("x")).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns.

    Null and empty texts are judged like others. Statistics are made twice, as keeping them would mean to join
    them with the texts again.
    """
    model = fit(described(docs), labels)
    return docs.filter(score(model, statistics_column("text")) >= threshold)
