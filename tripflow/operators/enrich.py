"""Zone enrichment of both trip ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripflow.constants import DEFAULT_GRID_ZONES
from tripflow.operators.boxes import attach_boxes, attach_grid, trip_grid
from tripflow.operators.lookup import attach_location_names, attach_lookup, attach_nothing
from tripflow.sources.zones import ZoneSource, zone_files

ENDS = ("pickup", "dropoff")


def resolve_zone_source(
    spark: SparkSession,
    trips: DataFrame,
    *,
    lookup_path: str | None = None,
    boxes_path: str | None = None,
    num_zones: int = DEFAULT_GRID_ZONES,
) -> ZoneSource:
    """The lookup file, else the box file, else a grid over the trips."""
    found = zone_files(spark, lookup_path=lookup_path, boxes_path=boxes_path)
    return found or ZoneSource("grid", grid=trip_grid(trips, num_zones))


def enrich_end(trips: DataFrame, zones: ZoneSource, end: str, **box_options) -> DataFrame:
    """Attach the zone of one end, by what the trips and the source offer.

    Coordinates with a grid or boxes come first, then location ids with or without
    a lookup, then NULL zones. The choice reads column names only.
    """
    present = set(trips.columns)
    if {f"{end}_longitude", f"{end}_latitude"} <= present:
        if zones.grid is not None:
            return attach_grid(trips, zones.grid, end, **box_options)
        if zones.boxes is not None:
            return attach_boxes(trips, zones.boxes, end, **box_options)
    if f"{end}_location_id" not in present:
        return attach_nothing(trips, end)
    if zones.lookup is not None:
        return attach_lookup(trips, zones.lookup, end)
    return attach_location_names(trips, end)


def enrich_trips(trips: DataFrame, zones: ZoneSource, **box_options) -> DataFrame:
    """Attach pickup and dropoff zones; each end is decided on its own."""
    for end in ENDS:
        trips = enrich_end(trips, zones, end, **box_options)
    return trips


def zone_coverage(enriched: DataFrame) -> DataFrame:
    """Trips, and how many of them have a named zone at each end."""
    return enriched.agg(
        F.count(F.lit(1)).alias("total_trips"),
        *[F.count(f"{end}_zone_name").alias(f"with_{end}_zone") for end in ENDS],
    )
