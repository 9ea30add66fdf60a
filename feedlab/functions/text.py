"""Number formats of the report texts.

Texts are a few rows, so Python's own correctly rounded formats are used, vectorised.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType


def _format(values: pd.Series, pattern: str) -> pd.Series:
    return pd.Series([None if pd.isna(v) else format(v, pattern) for v in values], dtype=object)


@F.pandas_udf(StringType())
def _two_decimals(values: pd.Series) -> pd.Series:
    return _format(values, ".2f")


@F.pandas_udf(StringType())
def _two_significant(values: pd.Series) -> pd.Series:
    return _format(values, ".2")


def two_decimals(value: Column) -> Column:
    return _two_decimals(value.cast("double"))


def two_significant(value: Column) -> Column:
    """Two significant digits: 0.0534 -> 0.053, 1.0 -> 1.0, 12.3 -> 1.2e+01."""
    return _two_significant(value.cast("double"))
