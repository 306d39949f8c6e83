"""Fixed values that results depend on.

Everything in this module is a plain lookup value: names, codes, labels,
limits and formats. No logic lives here.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: source column -> canonical column --------------------------
COLUMN_ALIASES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "trip_distance": "trip_distance_km",
    "total_amount": "fare_amount",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}

# --- fixed values: canonical type of each canonical column that is cast -------
# The order is also the order in which rows of one duplicate key are ranked.
CANONICAL_TYPES = {
    "trip_id": "bigint",
    "fare_amount": "double",
    "trip_distance_km": "double",
    "payment_type": "int",
    "pickup_location_id": "int",
    "dropoff_location_id": "int",
    "passenger_count": "int",
    "pickup_longitude": "double",
    "pickup_latitude": "double",
    "dropoff_longitude": "double",
    "dropoff_latitude": "double",
}

TIME_COLUMNS = ("pickup_datetime", "dropoff_datetime")

# --- fixed values: words that mark a key field, one rule per key field --------
KEY_FIELD_WORDS = (
    ("pickup", "time"),
    ("dropoff", "time"),
    ("distance",),
    ("fare", "amount"),
)

# --- fixed values: the only text form of a time that is read (yyyy-MM-dd HH:mm:ss)
TIME_TEXT_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

# --- fixed values: weekday numbers start at 1 = Sunday ------------------------
DAY_NAMES = (
    "Sunday",
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
)
UNKNOWN_DAY = "Unknown"
WEEKEND_DAYS = (1, 7)

# --- fixed values: payment code -> label --------------------------------------
PAYMENT_LABELS = {
    0: "Unknown/Not Specified",
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}
MISSING_PAYMENT_LABEL = "Unknown/Not Specified"

# --- fixed values: columns shown in previews ----------------------------------
CURATED_PREVIEW_COLUMNS = (
    "pickup_datetime",
    "dropoff_datetime",
    "trip_duration_min",
    "hour_of_day",
    "day_of_week",
    "day_name",
    "trip_distance_km",
    "fare_amount",
    "passenger_count",
)
ENRICHED_PREVIEW_COLUMNS = (
    "pickup_datetime",
    "hour_of_day",
    "day_name",
    "pickup_zone_name",
    "dropoff_zone_name",
    "trip_duration_min",
    "trip_distance_km",
    "fare_amount",
)

# --- fixed values: result name -> stored table name, and -> exported file name
RESULT_TABLES = {
    "trips_by_hour": "trips_by_hour",
    "trips_by_day": "trips_by_day",
    "zones_activity": "zones_activity",
    "trip_duration_stats": "trip_duration_stats",
    "revenue_analysis": "revenue_analysis",
}
EXPORT_NAMES = {
    "trips_by_hour": "hourly_demand",
    "trips_by_day": "daily_demand",
    "zones_activity": "zone_activity",
    "revenue_analysis": "revenue_analysis",
}
RESULT_DATABASE = "taxi_analysis"

# --- fixed values: session settings -------------------------------------------
SESSION_DEFAULTS = {
    "spark.app.name": "tripflow",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


@dataclass(frozen=True)
class Limits:
    """Inclusive plausibility limits of a trip."""

    min_distance: float = 0.1
    max_distance: float = 200.0
    min_duration: float = 1.0
    max_duration: float = 180.0
    min_fare: float = 0.0
    max_fare: float = 1000.0
    long_idle_minutes: float = 30.0


@dataclass(frozen=True)
class Bounds:
    """Coordinate rectangle a grid falls back to when the data has none."""

    min_longitude: float = -74.05
    max_longitude: float = -73.75
    min_latitude: float = 40.55
    max_latitude: float = 40.95


LIMITS = Limits()
DEFAULT_BOUNDS = Bounds()
DEFAULT_GRID_ZONES = 20
TOP_ENDS = 10
TOP_ACTIVITY = 20
