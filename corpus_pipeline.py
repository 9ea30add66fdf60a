"""A corpus pipeline: each stage reads what the one before it kept and stores what it keeps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlab.llm import decontamination, lines, pieces, quality, simhash
from feedlab.llm.common import table
from feedlab.storage import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among them, predicts to be good."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat a passage of three lines or more; n_chars follows the text."""
    found = lines.deduplicate(docs).select(*docs.columns)
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, words=3, radius=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item to 80 % or more."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"), share=0.8)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the hash of the text decoded from them."""
    import public_tokenizers

    vocabulary = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.round_trip(docs, vocabulary)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: Classifier, fingerprints and pieces are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = fresh_path(spark, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
