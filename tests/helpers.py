"""Shared helpers: comparable rows and physical plans."""

from __future__ import annotations

import math


def cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def rows(table):
    """Rows in the table's own order, columns by name."""
    names = sorted(table.columns)
    return [tuple(cell(row[name]) for name in names) for row in table.collect()]


def bag(table):
    """Rows in a canonical order."""
    return sorted(rows(table), key=repr)


def plan(table) -> str:
    return table._jdf.queryExecution().explainString(
        table.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
