"""Plausibility rules on distance, fare and idle trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripflow.constants import LIMITS, Limits
from tripflow.functions import within


def outlier_rules(columns: list[str], limits: Limits = LIMITS) -> dict[str, Column]:
    """Rules that apply to a table with these columns; each is true for good rows."""
    rules = {}
    distance, fare, minutes = map(F.col, ("trip_distance_km", "fare_amount", "trip_duration_min"))
    if "trip_distance_km" in columns:
        rules["distance"] = within(distance, limits.min_distance, limits.max_distance)
    if "fare_amount" in columns:
        rules["fare"] = within(fare, limits.min_fare, limits.max_fare)
    if "trip_distance_km" in columns and "trip_duration_min" in columns:
        rules["zero_distance"] = ~((distance == 0) & (minutes > limits.long_idle_minutes))
    return rules


def _apply(trips: DataFrame, names: tuple[str, ...], limits: Limits) -> DataFrame:
    for name, rule in outlier_rules(trips.columns, limits).items():
        if name in names:
            trips = trips.where(rule)
    return trips


def filter_distance(trips: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    return _apply(trips, ("distance",), limits)


def filter_fare(trips: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    return _apply(trips, ("fare",), limits)


def filter_zero_distance(trips: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Drop trips that went nowhere for long, or for an unknown time."""
    return _apply(trips, ("zero_distance",), limits)


def filter_outliers(trips: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    return _apply(trips, ("distance", "fare", "zero_distance"), limits)
