"""Readers of trip files and zone files."""

from tripflow.sources.trips import scan_files, scan_trips, trip_files
from tripflow.sources.zones import (
    ZoneFileError,
    ZoneSource,
    check_zone_boxes,
    check_zone_lookup,
    read_zone_boxes,
    read_zone_lookup,
    zone_files,
)

__all__ = [
    "ZoneFileError",
    "ZoneSource",
    "check_zone_boxes",
    "check_zone_lookup",
    "read_zone_boxes",
    "read_zone_lookup",
    "scan_files",
    "scan_trips",
    "trip_files",
    "zone_files",
]
