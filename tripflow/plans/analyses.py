"""The analyses by name, with the columns each of them needs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tripflow.operators import activity, demand, revenue

MEASURES = frozenset({"trip_duration_min", "trip_distance_km", "fare_amount"})


@dataclass(frozen=True)
class Analysis:
    build: Callable[[DataFrame], DataFrame]
    requires: frozenset[str]


def _analysis(build: Callable[[DataFrame], DataFrame], *columns: str) -> Analysis:
    return Analysis(build, frozenset(columns))


ANALYSES = {
    "trips_by_hour": _analysis(demand.demand_by_hour, "hour_of_day", *MEASURES),
    "trips_by_day": _analysis(demand.demand_by_day, "day_of_week", "day_name", *MEASURES),
    "top_origin_zones": _analysis(
        activity.top_origin_zones, "pickup_zone_id", "pickup_zone_name", "fare_amount"
    ),
    "top_destination_zones": _analysis(
        activity.top_destination_zones, "dropoff_zone_id", "dropoff_zone_name", "fare_amount"
    ),
    "zones_activity": _analysis(
        activity.zone_activity,
        "pickup_zone_id",
        "pickup_zone_name",
        "dropoff_zone_id",
        "dropoff_zone_name",
        "fare_amount",
    ),
    "trip_duration_stats": _analysis(
        demand.duration_distance_by_hour, "hour_of_day", "trip_duration_min", "trip_distance_km"
    ),
    "duration_by_zone": _analysis(
        demand.duration_distance_by_zone,
        "pickup_zone_name",
        "trip_duration_min",
        "trip_distance_km",
    ),
    "revenue_analysis": _analysis(revenue.revenue_by_payment, "payment_type", "fare_amount"),
}


def run_analyses(enriched: DataFrame) -> tuple[dict[str, DataFrame], dict[str, list[str]]]:
    """Results that the columns allow, and the missing columns of the others."""
    present = set(enriched.columns)
    results, unmet = {}, {}
    for name, analysis in ANALYSES.items():
        missing = sorted(analysis.requires - present)
        if missing:
            unmet[name] = missing
        else:
            results[name] = analysis.build(enriched)
    return results, unmet
