"""Text files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedlab.storage import checkpointed

#: Rows of a report that is written as one file at most.
REPORT_ROWS = 1_000_000


def write_csv(report: DataFrame, path: str) -> None:
    """One CSV file with a header. Raises for more rows than one task should write. The report is computed once."""
    rows = checkpointed(report.limit(REPORT_ROWS + 1))
    if rows.count() > REPORT_ROWS:
        raise ValueError(f"a report of more than {REPORT_ROWS} rows; use write_tsv")
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_tsv(rows: DataFrame, path: str) -> None:
    """Tab-separated files with headers, as many as there are partitions."""
    rows.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
