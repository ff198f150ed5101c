"""Reshaping operators: exact dedup, unpivot, pivot, date spine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop rows identical in every column.  Hash aggregate on all columns
    with map-side partial aggregation: copies of a hot row collapse before the
    shuffle, so a key holding a third of the rows is not one task's input."""
    return df.distinct()


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name_col: str, value_col: str) -> DataFrame:
    """Wide → long in one pass (Expand), not one scan per value column."""
    return df.unpivot(list(ids), list(values), name_col, value_col)


def pivot_max(df: DataFrame, key: str, pivot_col: str, values: Sequence[str], measure: str) -> DataFrame:
    """max(measure) per key with one column per listed pivot value (the value
    list is given, so Spark does not run a job to discover it)."""
    return df.groupBy(key).pivot(pivot_col, list(values)).agg(F.max(measure))


def date_spine(spark, start: str, end_exclusive: str, column: str = "date_day") -> DataFrame:
    """One row per day in [start, end_exclusive)."""
    from funnelworks.functions.dates import date_spine as _spine

    return _spine(spark, start, end_exclusive, column)
