"""Predicates used by the quality rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def is_floating(data_type: T.DataType) -> bool:
    """Only floating columns can hold NaN."""
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def is_missing(column: Column, data_type: T.DataType) -> Column:
    """NULL, or NaN where the type has one."""
    if is_floating(data_type):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def within(column: Column, low: float, high: float) -> Column:
    """Inclusive range as two plain comparisons, which Parquet scans can use."""
    return (column >= F.lit(low)) & (column <= F.lit(high))
