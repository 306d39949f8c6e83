"""Null, NaN and duplicate rules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tripflow.constants import CANONICAL_TYPES
from tripflow.functions.rules import is_floating
from tripflow.operators.columns import column, key_fields


def drop_null_keys(trips: DataFrame) -> DataFrame:
    """Drop trips with a NULL key field. (``dropna`` would drop NaN as well.)"""
    return _where_all(trips, [column(c).isNotNull() for c in key_fields(trips.columns)])


def drop_nan_keys(trips: DataFrame) -> DataFrame:
    """Drop trips with a NaN key field; NULL is not NaN and passes."""
    floating = [
        f.name
        for f in trips.schema.fields
        if f.name in key_fields(trips.columns) and is_floating(f.dataType)
    ]
    return _where_all(trips, [~F.isnan(column(c)) for c in floating])


def _where_all(trips: DataFrame, checks: list[Column]) -> DataFrame:
    return trips.where(reduce(Column.__and__, checks)) if checks else trips


def dedupe_keys(columns: Sequence[str]) -> list[str]:
    """The first two key fields, else the trip id, else nothing to dedupe on."""
    keys = key_fields(columns)
    if len(keys) >= 2:
        return keys[:2]
    return ["trip_id"] if "trip_id" in columns else []


def survivor_order(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Column order that ranks rows of one key.

    It covers every column outside the key and does not depend on the order of
    the input's columns. Rows that tie on all of them are identical.
    """
    rest = [c for c in columns if c not in keys]
    first = [c for c in CANONICAL_TYPES if c in rest]
    return first + sorted(c for c in rest if c not in first)


def needed_for(trips: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Leave out columns that neither the rules nor ``wanted`` need.

    Kept are the key fields and the survivor order up to its last needed column.
    Rows that tie on those agree in every needed column, so each needed value is
    the same as without pruning, and the duplicate shuffle carries less.
    """
    fields = key_fields(trips.columns)
    keys = dedupe_keys(trips.columns)
    needed = {*fields, *keys, *wanted}
    order = survivor_order(trips.columns, keys)
    while order and order[-1] not in needed:
        order.pop()
    kept = {*keys, *order}
    return trips.select([column(c) for c in trips.columns if c in kept])


def first_per_key(trips: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key: the lowest under ``survivor_order``, NULLs lowest.

    The choice is the same in every run and for every partitioning. ``min`` of a
    struct aggregates before the shuffle, so however many rows share a key, each
    map task sends one of them. Columns without an order (maps) are carried along; of
    rows that differ in nothing else, any may survive.
    """
    rest = survivor_order(trips.columns, keys)
    if not rest:
        return trips.distinct()
    ranked = [c for c in rest if "map<" not in trips.schema[c].dataType.simpleString()]
    order = F.struct(*[column(c) for c in ranked])
    if ranked == rest:
        lowest = F.min(order).alias("__lowest")
    else:
        lowest = F.min_by(F.struct(*[column(c) for c in rest]), order).alias("__lowest")
    kept = trips.groupBy(*[column(c) for c in keys]).agg(lowest)
    return kept.select(
        [
            column(c) if c in keys else F.col("__lowest").getField(c).alias(c)
            for c in trips.columns
        ]
    )


def dedupe_trips(trips: DataFrame) -> DataFrame:
    """One trip per pickup and dropoff time, or per trip id where times are missing."""
    keys = dedupe_keys(trips.columns)
    return first_per_key(trips, keys) if keys else trips


def clean_trips(trips: DataFrame) -> DataFrame:
    """Null rule, NaN rule, then duplicates."""
    return trips.transform(drop_null_keys).transform(drop_nan_keys).transform(dedupe_trips)
