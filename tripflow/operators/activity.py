"""Trip ends by zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripflow.constants import TOP_ACTIVITY, TOP_ENDS
from tripflow.operators.rollup import rollup_by

END_LABELS = {"pickup": "origin", "dropoff": "destination"}


def zone_columns(end: str) -> list[str]:
    return [f"{end}_zone_id", f"{end}_zone_name"]


def trips_by_end(trips: DataFrame, end: str) -> DataFrame:
    """Trips, revenue and average fare per pickup or dropoff zone."""
    label = END_LABELS[end]
    return trips.groupBy(*zone_columns(end)).agg(
        F.count(F.lit(1)).alias(f"total_trips_{label}"),
        F.sum("fare_amount").alias(f"total_revenue_{label}"),
        F.avg("fare_amount").alias(f"avg_fare_{label}"),
    )


def top_zones(zones: DataFrame, measure: str, keys: list[str], n: int) -> DataFrame:
    """The ``n`` highest zones; ties go to the lower zone id."""
    ties = [F.asc_nulls_last(c) for c in keys]
    return zones.orderBy(F.desc(measure), *ties).limit(n)


def top_origin_zones(trips: DataFrame, n: int = TOP_ENDS) -> DataFrame:
    stats = trips_by_end(trips, "pickup")
    return top_zones(stats, "total_trips_origin", zone_columns("pickup"), n)


def top_destination_zones(trips: DataFrame, n: int = TOP_ENDS) -> DataFrame:
    stats = trips_by_end(trips, "dropoff")
    return top_zones(stats, "total_trips_destination", zone_columns("dropoff"), n)


def combine_ends(by_end: DataFrame) -> DataFrame:
    """Merge per-end rows of ``rollup_by`` into one row per zone."""
    at_pickup = F.col("grouping") == "origin"
    merged = by_end.select(
        F.when(at_pickup, F.col("pickup_zone_id")).otherwise(F.col("dropoff_zone_id")).alias("zone_id"),
        F.when(at_pickup, F.col("pickup_zone_name"))
        .otherwise(F.col("dropoff_zone_name"))
        .alias("zone_name"),
        "total_trips",
        "total_revenue",
        "priced_trips",
    )
    return (
        merged.groupBy("zone_id", "zone_name")
        .agg(
            F.sum("total_trips").alias("total_activity"),
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("priced_trips").alias("__priced"),
        )
        .withColumn("avg_fare", F.try_divide(F.col("total_revenue"), F.col("__priced")))
        .drop("__priced")
    )


def revenue_by_zone(trips: DataFrame) -> DataFrame:
    """Activity of every zone: a trip counts once at each of its two ends."""
    by_end = rollup_by(
        trips,
        {label: zone_columns(end) for end, label in END_LABELS.items()},
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("fare_amount").alias("total_revenue"),
        F.count("fare_amount").alias("priced_trips"),
    )
    zones = combine_ends(by_end)
    return zones.orderBy(
        F.desc_nulls_last("total_revenue"), F.asc_nulls_last("zone_id"), F.asc_nulls_last("zone_name")
    )


def zone_activity(trips: DataFrame, n: int = TOP_ACTIVITY) -> DataFrame:
    """The most active zones."""
    return top_zones(revenue_by_zone(trips), "total_activity", ["zone_id", "zone_name"], n)


def most_active_zone(trips: DataFrame) -> DataFrame:
    return zone_activity(trips, 1)
