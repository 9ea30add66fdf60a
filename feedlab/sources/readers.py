"""Readers for text files, tables, databases and SQL text."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def _header(spark: SparkSession, file: str) -> tuple[str, ...] | None:
    """Column names in the first line of a file; None for an empty file."""
    first = spark.read.text(file).head(1)
    return tuple(n.strip('"') for n in first[0][0].removeprefix("\ufeff").rstrip("\r").split("\t")) if first else None


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated files with a header row, bound to a declared schema by the names in each file's own header.

    Columns may stand in any order, and another one in each file; columns that the schema does not name are not
    read. Raises ``ValueError`` at the call for a header that lacks a declared column or names one twice, and fails
    when read for values that are not of the declared type. Names differ by more than case. Every file's first line
    is looked at before; files with the same header are one scan.
    """
    declared = spark.createDataFrame([], schema).schema
    known = {f.name.lower(): f for f in declared.fields}
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(8) as pool:
        headers = list(pool.map(lambda file: _header(spark, file), files))
    alike: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        if header is None:
            continue
        names = [n.lower() for n in header]
        missing, twice = sorted(set(known) - set(names)), sorted({n for n in names if names.count(n) > 1})
        if missing or twice:
            raise ValueError(f"{file}: header lacks {missing}, names twice {twice}")
        alike.setdefault(header, []).append(file)
    parts = []
    for header, same in alike.items():
        found = StructType([known.get(n.lower(), StructField(n, StringType())) for n in header])
        parts.append(spark.read.schema(found).option("sep", "\t").option("header", True).option("enforceSchema", False)
                     .option("mode", "FAILFAST").csv(same).select(*declared.names))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], declared)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, which may come from a parameter."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log stored by day; ``event_date`` is its folder."""
    return spark.read.schema(f"{schema}, event_date DATE").parquet(path)


def jdbc_options(url: str, query: str, column: str, lower: Any, upper: Any,
                 partitions: int, **options: str) -> dict[str, str]:
    """Options of a parallel read: ``partitions`` ranges of ``column``, read side by side."""
    return {"url": url, "dbtable": f"({query}) AS source", "partitionColumn": column,
            "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions), "fetchsize": "10000", **options}


def read_jdbc(spark: SparkSession, url: str, query: str, column: str, lower: Any, upper: Any,
              partitions: int, **options: str) -> DataFrame:
    """A database query, split by ranges of ``column``. Credentials come in ``options``."""
    return (spark.read.format("jdbc")
            .options(**jdbc_options(url, query, column, lower, upper, partitions, **options))
            .load())


def run_sql(spark: SparkSession, text: str, args: dict[str, Any] | None = None,
            **frames: DataFrame) -> DataFrame:
    """SQL text over named frames: ``{feed}`` in the text stands for ``feed=df``."""
    return spark.sql(text, args=args, **frames)
