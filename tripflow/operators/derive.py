"""Derived time columns and the duration rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripflow.constants import LIMITS, TIME_COLUMNS, Limits
from tripflow.functions import day_name, trip_minutes, wall_clock, within


def parse_timestamps(trips: DataFrame) -> DataFrame:
    """Turn the time columns into wall-clock timestamps."""
    parsed = {
        f.name: wall_clock(F.col(f.name), f.dataType)
        for f in trips.schema.fields
        if f.name in TIME_COLUMNS
    }
    return trips.withColumns(parsed) if parsed else trips


def add_duration(trips: DataFrame) -> DataFrame:
    """``trip_duration_min``; NULL where a time column is missing."""
    if all(c in trips.columns for c in TIME_COLUMNS):
        minutes = trip_minutes(*[F.col(c) for c in TIME_COLUMNS])
    else:
        minutes = F.lit(None).cast("double")
    return trips.withColumn("trip_duration_min", minutes)


def add_hour(trips: DataFrame) -> DataFrame:
    """``hour_of_day`` of the pickup, 0 to 23."""
    return trips.withColumn("hour_of_day", _of_pickup(trips, F.hour))


def add_weekday(trips: DataFrame) -> DataFrame:
    """``day_of_week`` of the pickup, 1 = Sunday."""
    return trips.withColumn("day_of_week", _of_pickup(trips, F.dayofweek))


def add_day_name(trips: DataFrame) -> DataFrame:
    """``day_name`` of ``day_of_week``."""
    return trips.withColumn("day_name", day_name(F.col("day_of_week")))


def _of_pickup(trips: DataFrame, part) -> Column:
    if "pickup_datetime" in trips.columns:
        return part(F.col("pickup_datetime"))
    return F.lit(None).cast("int")


def add_time_columns(trips: DataFrame) -> DataFrame:
    """All derived columns, no rows dropped."""
    steps = (parse_timestamps, add_duration, add_hour, add_weekday, add_day_name)
    for step in steps:
        trips = step(trips)
    return trips


def duration_rule(limits: Limits = LIMITS, null_duration: str = "drop") -> Column:
    """Duration in range; ``null_duration='keep'`` also accepts an unknown one."""
    if null_duration not in ("drop", "keep"):
        raise ValueError(f"null_duration must be 'drop' or 'keep', not {null_duration!r}")
    minutes = F.col("trip_duration_min")
    in_range = within(minutes, limits.min_duration, limits.max_duration)
    return in_range if null_duration == "drop" else minutes.isNull() | in_range


def filter_duration(
    trips: DataFrame, limits: Limits = LIMITS, null_duration: str = "drop"
) -> DataFrame:
    return trips.where(duration_rule(limits, null_duration))


def derive_trips(
    trips: DataFrame, limits: Limits = LIMITS, null_duration: str = "drop"
) -> DataFrame:
    """Derived columns and the duration rule.

    The duration depends only on the two times, which are also the duplicate
    key, so Catalyst moves this filter below the duplicate shuffle by itself.
    """
    return add_time_columns(trips).transform(filter_duration, limits, null_duration)
