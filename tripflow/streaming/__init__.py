"""Structured Streaming forms of demand, duplicate removal and zone lookup."""

from tripflow.streaming.demand import (
    closed_hours,
    closed_trips,
    dedupe_stream,
    drop_repeats_stream,
    hourly_demand_stream,
)
from tripflow.streaming.runs import drain, file_stream, scratch_dir
from tripflow.streaming.zones import start_zone_stream

__all__ = [
    "closed_hours",
    "closed_trips",
    "dedupe_stream",
    "drain",
    "drop_repeats_stream",
    "file_stream",
    "hourly_demand_stream",
    "scratch_dir",
    "start_zone_stream",
]
