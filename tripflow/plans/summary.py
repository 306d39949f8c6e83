"""The headline numbers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tripflow.operators.activity import top_zones, zone_columns
from tripflow.operators.demand import busiest_day, peak_hour
from tripflow.operators.rollup import rollup_by


def total_trips(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count(F.lit(1)).alias("total_trips"))


def summary(enriched: DataFrame) -> DataFrame:
    """Total trips and revenue, peak hour, busiest day and most active zone.

    One pass over the trips: they are grouped by hour, weekday and both zone
    ends at once, and the few groups are compared afterwards.
    """
    groups = rollup_by(
        enriched,
        {
            "hour": ["hour_of_day"],
            "day": ["day_of_week", "day_name"],
            "origin": zone_columns("pickup"),
            "destination": zone_columns("dropoff"),
            "all": [],
        },
        F.count(F.lit(1)).alias("trips"),
        F.sum("fare_amount").alias("revenue"),
    )
    at_pickup = F.col("grouping") == "origin"
    is_end = F.col("grouping").isin("origin", "destination")
    merged = groups.groupBy(
        F.when(is_end, "zone").otherwise(F.col("grouping")).alias("what"),
        "hour_of_day",
        "day_of_week",
        "day_name",
        F.when(at_pickup, F.col("pickup_zone_id"))
        .otherwise(F.col("dropoff_zone_id"))
        .alias("zone_id"),
        F.when(at_pickup, F.col("pickup_zone_name"))
        .otherwise(F.col("dropoff_zone_name"))
        .alias("zone_name"),
    ).agg(F.sum("trips").alias("trips"), F.sum("revenue").alias("revenue"))

    def highest(what: str, tie: str, *keep: str):
        # fewest negated trips = most trips, then the lowest tie column
        ranked = F.struct(
            (-F.col("trips")).alias("rank"),
            F.col(tie).isNull().alias("unknown"),
            F.col(tie).alias("tie"),
            *keep,
            "trips",
        )
        return F.min(F.when(F.col("what") == what, ranked))

    every = F.col("what") == "all"
    picked = merged.agg(
        F.coalesce(F.max(F.when(every, F.col("trips"))), F.lit(0).cast("bigint")).alias(
            "total_trips"
        ),
        F.max(F.when(every, F.col("revenue"))).alias("total_revenue"),
        highest("hour", "hour_of_day").alias("hour"),
        highest("day", "day_of_week", "day_name").alias("day"),
        highest("zone", "zone_id", "zone_name").alias("zone"),
    )
    return picked.select(
        "total_trips",
        F.col("hour.tie").alias("peak_hour"),
        F.col("hour.trips").alias("peak_hour_trips"),
        F.col("day.day_name").alias("busiest_day"),
        F.col("day.trips").alias("busiest_day_trips"),
        F.col("zone.tie").alias("most_active_zone_id"),
        F.col("zone.zone_name").alias("most_active_zone"),
        F.col("zone.trips").alias("most_active_zone_trips"),
        "total_revenue",
    )


def summary_of_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The headline numbers as name and text rows, from finished result tables."""
    rows = [_headline(tables["totals"], "total trips", "total_trips")]
    if "trips_by_hour" in tables:
        rows.append(_headline(peak_hour(tables["trips_by_hour"]), "peak hour", "hour_of_day"))
    if "trips_by_day" in tables:
        rows.append(_headline(busiest_day(tables["trips_by_day"]), "busiest day", "day_name"))
    if "zones_activity" in tables:
        first = top_zones(tables["zones_activity"], "total_activity", ["zone_id", "zone_name"], 1)
        rows.append(_headline(first, "most active zone", "zone_name"))
    rows.append(_headline(tables["totals"], "total revenue", "total_revenue"))
    return reduce(DataFrame.unionByName, rows)


def _headline(table: DataFrame, name: str, value: str) -> DataFrame:
    return table.select(F.lit(name).alias("headline"), F.col(value).cast("string").alias("value"))
