"""Demand, duration and distance by hour, weekday and zone name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripflow.functions import weekend_label


def demand_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_trips"),
        F.avg("trip_duration_min").alias("avg_duration_min"),
        F.avg("trip_distance_km").alias("avg_distance_km"),
        F.sum("fare_amount").alias("total_revenue"),
        F.avg("fare_amount").alias("avg_fare_amount"),
    ]


def span_measures() -> list[Column]:
    return [
        f(c).alias(f"{label}_{c.removeprefix('trip_')}")
        for c in ("trip_duration_min", "trip_distance_km")
        for label, f in (("avg", F.avg), ("min", F.min), ("max", F.max))
    ]


def demand_by_hour(trips: DataFrame) -> DataFrame:
    return trips.groupBy("hour_of_day").agg(*demand_measures()).orderBy("hour_of_day")


def demand_by_day(trips: DataFrame) -> DataFrame:
    days = trips.groupBy("day_of_week", "day_name").agg(*demand_measures())
    return days.withColumn("is_weekend", weekend_label(F.col("day_of_week"))).orderBy("day_of_week")


def weekday_weekend(by_day: DataFrame) -> DataFrame:
    """Roll the weekday table up to weekday and weekend."""
    return (
        by_day.groupBy("is_weekend")
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.sum("total_revenue").alias("total_revenue"),
        )
        .orderBy("is_weekend")
    )


def duration_distance_by_hour(trips: DataFrame) -> DataFrame:
    return trips.groupBy("hour_of_day").agg(*span_measures()).orderBy("hour_of_day")


def duration_distance_by_zone(trips: DataFrame) -> DataFrame:
    """By pickup zone name; zones that share a name are one group."""
    return (
        trips.groupBy("pickup_zone_name")
        .agg(
            F.avg("trip_duration_min").alias("avg_duration_min"),
            F.avg("trip_distance_km").alias("avg_distance_km"),
            F.count(F.lit(1)).alias("trip_count"),
        )
        .orderBy(F.desc("trip_count"), F.asc_nulls_last("pickup_zone_name"))
    )


def peak_hour(by_hour: DataFrame) -> DataFrame:
    return by_hour.orderBy(F.desc("total_trips"), "hour_of_day").limit(1)


def busiest_day(by_day: DataFrame) -> DataFrame:
    return by_day.orderBy(F.desc("total_trips"), "day_of_week").limit(1)


def quietest_day(by_day: DataFrame) -> DataFrame:
    return by_day.orderBy(F.asc("total_trips"), "day_of_week").limit(1)


def hour_extremes(by_hour: DataFrame) -> DataFrame:
    """Peak hour, lowest hour, and the average number of trips in an hour."""
    most = F.max(F.struct("total_trips", -F.col("hour_of_day")))
    least = F.min(F.struct("total_trips", "hour_of_day"))
    picked = by_hour.agg(
        most.alias("most"), least.alias("least"), F.avg("total_trips").alias("avg_trips_per_hour")
    )
    return picked.select(
        (-F.col("most.col2")).alias("peak_hour"),
        F.col("most.total_trips").alias("peak_trips"),
        F.col("least.hour_of_day").alias("lowest_hour"),
        F.col("least.total_trips").alias("lowest_trips"),
        "avg_trips_per_hour",
    )
