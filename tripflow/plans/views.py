"""Temp views for Spark SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripflow.sources.zones import ZoneSource


def register_views(curated: DataFrame, enriched: DataFrame, zones: ZoneSource) -> list[str]:
    """Register ``trips_curated``, ``trips_enriched`` and, if there is one, ``zones``."""
    views = {"trips_curated": curated, "trips_enriched": enriched}
    zone_table = zones.lookup if zones.lookup is not None else zones.boxes
    if zone_table is not None:
        views["zones"] = zone_table
    for name, table in views.items():
        table.createOrReplaceTempView(name)
    return list(views)
