"""The queries of the subpackage: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedlab.llm import (anchors, chat, decontamination, language, lines, minhash, oracle, personal, pieces, quality,
                         repeats, simhash, token_files, zones)
from feedlab.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents"), keep=False)


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.deduplicate(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal.find(table(spark, folder, "documents"))


def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.compare_with_edit(table(spark, folder, "documents"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(rows.unionByName(chat.probe(spark))))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), words=3, radius=2)


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.round_trip(table(spark, folder, "documents"), vocabulary)


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_files.digests(spark, table(spark, folder, "documents"),
                               public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op11_codes(spark: SparkSession, folder: str) -> DataFrame:
    return anchors.compress(table(spark, folder, "embeddings"), parts=4, entries=256, rounds=4)


def op12_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op13_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return zones.cluster(table(spark, folder, "embeddings"), dims=64, clusters=8, rounds=10, seed=3)


QUERIES: dict[str, Query] = {
    "op1_repeats": op1_repeats,
    "op2_line_dedup": op2_line_dedup,
    "op3_pii": op3_pii,
    "op4_minhash": op4_minhash,
    "op5_decontamination": op5_decontamination,
    "op6_chat": op6_chat,
    "op7_simhash": op7_simhash,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_quality": op9_quality,
    "op10_token_files": op10_token_files,
    "op11_codes": op11_codes,
    "op12_language": op12_language,
    "op13_clusters": op13_clusters,
}

#: SQL of the queries that SQL can express; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op2_line_dedup": oracle.LINE_DEDUP,
    "op5_decontamination": oracle.DECONTAMINATION,
    "op11_codes": oracle.codes_sql(),
    "op13_clusters": oracle.centroids_sql(),
}
