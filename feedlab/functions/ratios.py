"""Counting and dividing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_action(kind: str, action: str = "action") -> Column:
    return F.col(action) == kind


def count_action(kind: str) -> Column:
    """Rows whose action is ``kind``."""
    return F.count_if(is_action(kind))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Float division; NULL where the denominator is zero."""
    top = F.col(numerator) if isinstance(numerator, str) else numerator
    bottom = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(top.cast("double"), bottom.cast("double"))
