"""The whole report from one pass over the trips."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripflow.constants import (
    DEFAULT_GRID_ZONES,
    EXPORT_NAMES,
    LIMITS,
    RESULT_TABLES,
    TOP_ACTIVITY,
    TOP_ENDS,
    Limits,
)
from tripflow.functions import weekend_label
from tripflow.operators import demand
from tripflow.operators.activity import END_LABELS, combine_ends, top_zones, zone_columns
from tripflow.operators.boxes import trip_grid
from tripflow.operators.cleaning import needed_for
from tripflow.operators.enrich import ENDS, enrich_trips
from tripflow.operators.quality import (
    cleaned_rows,
    data_quality_rate,
    dataset_overview,
    funnel_of_groups,
    null_profile,
    quality_groups,
)
from tripflow.operators.revenue import order_revenue
from tripflow.operators.rollup import rollup_by
from tripflow.plans.preprocess import ANALYSIS_COLUMNS, curate_trips, plausible_trips, standard_trips
from tripflow.plans.summary import summary_of_tables
from tripflow.sinks import FORMATS, TableStore, export, save_results
from tripflow.sources import ZoneSource, scan_trips, zone_files

GROUPINGS = {
    "hour": ["hour_of_day"],
    "day": ["day_of_week", "day_name"],
    "origin": zone_columns("pickup"),
    "destination": zone_columns("dropoff"),
    "zone_name": ["pickup_zone_name"],
    "payment": ["payment_type"],
    "all": [],
}

ZONE_GROUPINGS = ("origin", "destination", "zone_name")

# With a lookup, coordinates are not used and need not be shuffled.
ID_COLUMNS = ("payment_type", "pickup_location_id", "dropoff_location_id")


def report_groups(enriched: DataFrame, *more: Column) -> DataFrame:
    """Every grouping the report needs, with all measures: a few rows per zone.

    Groupings whose columns are absent are left out. ``more`` are further measures.
    """
    present = set(enriched.columns)
    groupings = {name: keys for name, keys in GROUPINGS.items() if present.issuperset(keys)}
    return rollup_by(
        enriched,
        groupings,
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("fare_amount").alias("total_revenue"),
        F.count("fare_amount").alias("priced_trips"),
        F.avg("fare_amount").alias("avg_fare_amount"),
        *demand.span_measures(),
        *more,
    )


def coverage_measures() -> list[Column]:
    return [F.count(f"{end}_zone_name").alias(f"with_{end}_zone") for end in ENDS]


def report_tables(
    groups: DataFrame, zone_groups: DataFrame | None = None, top_ends: int = TOP_ENDS, top_activity: int = TOP_ACTIVITY
) -> dict[str, DataFrame]:
    """All result tables from the output of ``report_groups``.

    ``zone_groups``, if given, are the groups that the tables about zones are made from.
    """
    zone_groups = groups if zone_groups is None else zone_groups
    present = set(groups.columns)

    def part(name: str) -> DataFrame:
        source = zone_groups if name in ZONE_GROUPINGS else groups
        return source.where(F.col("grouping") == name)

    def has(*names: str) -> bool:
        return all(present.issuperset(GROUPINGS[name]) for name in names)

    measures = ["total_trips", "avg_duration_min", "avg_distance_km", "total_revenue", "avg_fare_amount"]
    tables = {}
    if has("hour"):
        tables["trips_by_hour"] = part("hour").select("hour_of_day", *measures).orderBy("hour_of_day")
        spans = [f"{f}_{c}" for c in ("duration_min", "distance_km") for f in ("avg", "min", "max")]
        tables["trip_duration_stats"] = (
            part("hour").select("hour_of_day", *spans).orderBy("hour_of_day")
        )
    if has("day"):
        tables["trips_by_day"] = (
            part("day")
            .select("day_of_week", "day_name", *measures)
            .withColumn("is_weekend", weekend_label(F.col("day_of_week")))
            .orderBy("day_of_week")
        )
        tables["weekday_weekend"] = demand.weekday_weekend(tables["trips_by_day"])
    for end, label in END_LABELS.items():
        if has(label):
            stats = part(label).select(
                *zone_columns(end),
                F.col("total_trips").alias(f"total_trips_{label}"),
                F.col("total_revenue").alias(f"total_revenue_{label}"),
                F.col("avg_fare_amount").alias(f"avg_fare_{label}"),
            )
            tables[f"top_{label}_zones"] = top_zones(
                stats, f"total_trips_{label}", zone_columns(end), top_ends
            )
    if has("origin", "destination"):
        ends = zone_groups.where(F.col("grouping").isin(*END_LABELS.values()))
        zones = combine_ends(ends)
        order = ["zone_id", "zone_name"]
        tables["zones_activity"] = top_zones(zones, "total_activity", order, top_activity)
        tables["revenue_by_zone"] = zones.orderBy(F.desc_nulls_last("total_revenue"), *order)
    if has("zone_name"):
        tables["duration_by_zone"] = (
            part("zone_name")
            .select(
                "pickup_zone_name",
                "avg_duration_min",
                "avg_distance_km",
                F.col("total_trips").alias("trip_count"),
            )
            .orderBy(F.desc("trip_count"), F.asc_nulls_last("pickup_zone_name"))
        )
    if has("payment"):
        tables["revenue_analysis"] = order_revenue(
            part("payment").withColumnRenamed("avg_fare_amount", "avg_revenue_per_trip")
        )
        tables["payment_distribution"] = (
            part("payment")
            .select("payment_type", F.col("total_trips").alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first("payment_type"))
        )
    if has("hour"):
        tables["hour_extremes"] = demand.hour_extremes(tables["trips_by_hour"])
    if has("day"):
        tables["quietest_day"] = demand.quietest_day(tables["trips_by_day"])
    if present.issuperset(f"with_{end}_zone" for end in ENDS):
        tables["zone_coverage"] = part("all").select("total_trips", *[f"with_{end}_zone" for end in ENDS])
    tables["totals"] = part("all").select("total_trips", "total_revenue", "avg_fare_amount")
    return tables


# Results whose row count the calendar or a top-n bounds; each becomes one file.
SMALL_RESULTS = frozenset(
    {
        "trips_by_hour",
        "trips_by_day",
        "trip_duration_stats",
        "weekday_weekend",
        "top_origin_zones",
        "top_destination_zones",
        "zones_activity",
        "hour_extremes",
        "quietest_day",
        "zone_coverage",
        "summary",
        "totals",
    }
)


@dataclass(frozen=True)
class Report:
    """What a run produced: tables by name, where they were exported, store status."""

    tables: Mapping[str, DataFrame]
    exports: Mapping[str, str]
    stored: Mapping[str, str]


def run_report(
    spark: SparkSession,
    trips_path: str,
    out: str,
    *,
    lookup_path: str | None = None,
    boxes_path: str | None = None,
    num_zones: int = DEFAULT_GRID_ZONES,
    curated_path: str | None = None,
    store: TableStore | None = None,
    format: str = "csv",
    limits: Limits = LIMITS,
    null_duration: str = "drop",
    unmatched: str = "keep",
    top_ends: int = TOP_ENDS,
    top_activity: int = TOP_ACTIVITY,
    profile: bool = True,
) -> Report:
    """Scan, curate, enrich, analyse, export and store.

    The trips are read once for the results: all groupings come out of a single
    aggregation, which is written below ``out`` and is all the result tables
    read. ``profile`` adds the data-quality tables: the unique trips are then written
    below ``out``, and funnel and curated trips both come from them; overview and null profile
    are counts over the raw trips without a shuffle. ``curated_path`` also writes the curated trips and continues from
    the written table; where zones come from coordinates, the curated trips are always
    written, if need be below ``out``, so that they are made once.

    Tables that need no zone count all curated trips. ``unmatched='keep'`` gives trips
    without a zone a NULL zone in the others; ``'drop'`` leaves trips out of these that
    have no zone at either end. ``out``, ``curated_path`` and the store must be
    on storage that all executors share. Arguments are checked before anything runs.
    """
    if format.lower() not in FORMATS:
        raise ValueError(f"unsupported format: {format}")
    for name, value, allowed in (("unmatched", unmatched, ("keep", "drop")), ("null_duration", null_duration, ("keep", "drop"))):
        if value not in allowed:
            raise ValueError(f"{name} must be one of {allowed}, not {value!r}")
    raw = scan_trips(spark, trips_path)
    zones = zone_files(spark, lookup_path=lookup_path, boxes_path=boxes_path)
    by_id = zones is not None and zones.kind == "lookup" and not curated_path
    columns = ID_COLUMNS if by_id else ANALYSIS_COLUMNS
    tables: dict[str, DataFrame] = {}
    if profile:
        tables["dataset_overview"] = dataset_overview(raw)
        tables["null_profile"] = null_profile(raw)
        # One duplicate shuffle gives the funnel and the curated trips.
        needed = needed_for(standard_trips(raw), columns)
        unique = _staged(quality_groups(needed), f"{out}/staged/quality_groups")
        funnel = funnel_of_groups(unique, limits, null_duration)
        tables["quality_funnel"] = _staged(funnel, f"{out}/staged/quality_funnel")
        tables["data_quality_rate"] = data_quality_rate(tables["quality_funnel"])
        curated = plausible_trips(cleaned_rows(unique), limits, null_duration)
    else:
        curated = curate_trips(raw, limits, null_duration, columns=columns)
    if curated_path or not by_id:
        curated = _staged(curated, curated_path or f"{out}/staged/curated")
    zones = zones or ZoneSource("grid", grid=trip_grid(curated, num_zones))
    # Location ids that a lookup does not know keep their trips either way.
    options = {} if zones.kind == "lookup" else {"unmatched": "keep"}
    enriched = enrich_trips(curated, zones, **options)
    groups = _staged(report_groups(enriched, *coverage_measures()), f"{out}/staged/groups")
    zone_groups = None
    if unmatched == "drop" and zones.kind != "lookup":
        known = [F.col(f"{end}_zone_id").isNotNull() for end in ENDS]
        zone_groups = _staged(report_groups(enriched.where(known[0] & known[1])), f"{out}/staged/zone_groups")
    tables.update(report_tables(groups, zone_groups, top_ends, top_activity))
    tables["summary"] = summary_of_tables(tables)

    exports = {}
    for name, table in tables.items():
        target = f"{out}/{EXPORT_NAMES.get(name, name)}.{format.lower()}"
        export(table, target, format, single_file=name in SMALL_RESULTS)
        exports[name] = target
    stored = save_results(tables, store, RESULT_TABLES) if store else {}
    return Report(tables, exports, stored)


def _staged(table: DataFrame, path: str) -> DataFrame:
    """Write a table once and go on from the written copy."""
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.parquet(path)
