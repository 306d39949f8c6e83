"""Demand per clock hour and duplicate removal over a trip stream.

Event time is the pickup's wall-clock time taken as UTC, whatever the session zone. Hours and duplicate
keys are held as state until the watermark passes them, so state is bounded by the lateness, not by the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tripflow.constants import TIME_COLUMNS
from tripflow.operators.cleaning import dedupe_keys, dedupe_trips, first_per_key
from tripflow.operators.demand import demand_measures

LATENESS = "2 hours"
HOUR = "1 hour"


EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def as_instant(wall_clock: Column) -> Column:
    """The instant at which a UTC clock shows a wall-clock time; no session zone is read."""
    seconds = (wall_clock - F.expr(EPOCH)).cast("interval second").cast("decimal(20,6)")
    return F.timestamp_micros((seconds * 1_000_000).cast("bigint"))


def as_wall_clock(instant: Column) -> Column:
    """What a UTC clock shows at an instant on a whole second."""
    return F.expr(EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(instant).cast("decimal(18,6)"))


def with_event_time(trips: DataFrame) -> DataFrame:
    return trips.withColumn("pickup_ts", as_instant(F.col("pickup_datetime")))


def _by_clock_hour(timed: DataFrame, *more: Column) -> DataFrame:
    hours = timed.groupBy(F.window("pickup_ts", HOUR).alias("w")).agg(*demand_measures(), *more)
    return hours.select(
        as_wall_clock(F.col("w.start")).alias("hour_start"),
        as_wall_clock(F.col("w.end")).alias("hour_end"),
        *[c for c in hours.columns if c != "w"],
    )


def hourly_demand_stream(trips: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Demand of each clock hour, emitted once the hour can no longer change."""
    timed = with_event_time(trips).withWatermark("pickup_ts", lateness)
    return _by_clock_hour(timed)


def closed_hours(trips: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Batch form: the hours a stream over the same trips has closed.

    The latest pickup is found over the hours, in the same pass.
    """
    hours = _by_clock_hour(with_event_time(trips), F.max("pickup_datetime").alias("__latest"))
    latest = F.max("__latest").over(Window.partitionBy(F.lit(0)))
    closed = hours.withColumn("__closing", latest - F.expr(f"interval {lateness}"))
    return closed.where(F.col("hour_end") <= F.col("__closing")).drop("__latest", "__closing")


def dedupe_stream(trips: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Of the trips with one pickup and dropoff time, the one that ``dedupe_trips`` keeps.

    The lowest trip of a key so far is the key's state; it is emitted, once, when the watermark passes the
    pickup. Trips that arrive within the lateness may come in any order and in any batch without changing the
    result; later ones are dropped. Trips without a pickup time are dropped, as the null rule does.
    """
    if dedupe_keys(trips.columns) != list(TIME_COLUMNS):
        raise ValueError("a stream is deduplicated by its pickup and dropoff times")
    timed = with_event_time(trips.where(F.col("pickup_datetime").isNotNull())).withWatermark("pickup_ts", lateness)
    kept = first_per_key(timed, ["pickup_ts", *TIME_COLUMNS])
    return kept.drop("pickup_ts")


def closed_trips(trips: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Batch form: the unique trips a stream over the same trips has emitted."""
    latest = trips.agg((F.max("pickup_datetime") - F.expr(f"interval {lateness}")).alias("closing")).scalar()
    return dedupe_trips(trips).where(F.col("pickup_datetime") <= latest)


def drop_repeats_stream(trips: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Drop repeats of the two trip times that arrive within the lateness, without waiting for the watermark.

    The first arrival survives, so unlike ``dedupe_stream`` the choice depends on the order of arrival.
    """
    timed = with_event_time(trips).withWatermark("pickup_ts", lateness)
    return timed.dropDuplicatesWithinWatermark(list(TIME_COLUMNS)).drop("pickup_ts")
