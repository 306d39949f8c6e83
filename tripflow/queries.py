"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripflow import adapters
from tripflow.operators import (
    activity,
    boxes,
    cleaning,
    columns,
    demand,
    derive,
    enrich,
    lookup,
    outliers,
    quality,
    revenue,
)
from tripflow.plans import monthly, preprocess, report, summary
from tripflow.sinks import TableLog, TableStore, export, read_table, save_table
from tripflow.sources import ZoneSource, read_zone_lookup, scan_trips
from tripflow.streaming import (
    closed_hours,
    dedupe_stream,
    drain,
    file_stream,
    hourly_demand_stream,
    scratch_dir,
    start_zone_stream,
)

Query = Callable[[SparkSession, str], DataFrame]

TIMES = ("pickup_datetime", "dropoff_datetime")


def rounded(result: DataFrame) -> DataFrame:
    """Round floating aggregates, whose last bits depend on summation order.

    Nine decimal places absorb these bits; what remains is an exact decimal, so that a value
    on half of the sixth place is rounded alike in every run.
    """

    def value(field: T.StructField):
        if not isinstance(field.dataType, T.DoubleType):
            return field.name
        exact = F.col(field.name).cast("decimal(38,9)")
        return F.round(exact, 6).cast("double").alias(field.name)

    return result.select([value(f) for f in result.schema.fields])


def _over(table: Query, *steps: Callable[[DataFrame], DataFrame]) -> Query:
    """A query that applies ``steps`` to ``table``."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        result = table(spark, sf)
        for step in steps:
            result = step(result)
        return result

    return run


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.trips_raw(spark, sf)


def _standard(spark: SparkSession, sf: str) -> DataFrame:
    return preprocess.standard_trips(_raw(spark, sf))


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    return derive.add_time_columns(_standard(spark, sf))


def _curated(spark: SparkSession, sf: str) -> DataFrame:
    return preprocess.curate_trips(_raw(spark, sf))


def _curated_with(raw: Query, *used: str) -> Query:
    """Curated trips with only the columns that are used next to times, distance and fare."""
    return lambda spark, sf: preprocess.curate_trips(raw(spark, sf), columns=used)


def _lookup_source(spark: SparkSession, sf: str) -> ZoneSource:
    return ZoneSource("lookup", lookup=adapters.zone_lookup(spark, sf))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.enrich_trips(_curated(spark, sf), _lookup_source(spark, sf))


def _enriched_with(raw: Query, *used: str) -> Query:
    curated = _curated_with(raw, *used)
    return lambda spark, sf: enrich.enrich_trips(curated(spark, sf), _lookup_source(spark, sf))


_fares = _curated_with(_raw)
_fares_by_id = _curated_with(_raw, "trip_id")
_located = _curated_with(_raw, "trip_id", "pickup_location_id")
_payments = _curated_with(_raw, "payment_type")
_zoned = _enriched_with(_raw, "pickup_location_id", "dropoff_location_id", "payment_type")
_by_hour = _over(_fares, demand.demand_by_hour)
_by_day = _over(_fares, demand.demand_by_day)
_by_payment = _over(_payments, revenue.revenue_by_payment)

_volume_points = _curated_with(adapters.trips_volume, "trip_id", "pickup_longitude", "pickup_latitude")
_volume_fares = _curated_with(adapters.trips_volume)
_volume_payments = _curated_with(adapters.trips_volume, "payment_type")
_volume_zoned = _enriched_with(
    adapters.trips_volume, "pickup_location_id", "dropoff_location_id", "payment_type"
)


def _trip_ids_only(spark: SparkSession, sf: str) -> DataFrame:
    return _standard(spark, sf).drop("dropoff_datetime", "trip_distance_km", "fare_amount")


def _clean_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _standard(spark, sf).transform(cleaning.drop_null_keys).transform(cleaning.drop_nan_keys)


def _zone_of(trips: DataFrame, zones: DataFrame, end: str, **options) -> DataFrame:
    point = [f"{end}_longitude", f"{end}_latitude"]
    return boxes.attach_boxes(trips, zones, end, **options).select(
        "trip_id", *point, f"{end}_zone_id", f"{end}_zone_name"
    )


def _keeping(*names: str) -> Callable[[DataFrame], DataFrame]:
    return lambda table: table.select("trip_id", *names)


def scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan_trips(spark, f"{sf}/lineitem.parquet")


def parse_text_times(spark: SparkSession, sf: str) -> DataFrame:
    trips = columns.standardize_columns(adapters.trips_text_times(spark, sf))
    return derive.parse_timestamps(trips).select("trip_id", *TIMES)


def pickup_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.attach_lookup(_curated(spark, sf), adapters.zone_lookup(spark, sf), "pickup")


def dropoff_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.attach_lookup(_curated(spark, sf), adapters.zone_lookup(spark, sf), "dropoff")


def zone_names_from_ids(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.enrich_trips(_curated(spark, sf), ZoneSource("ids")).select(
        "trip_id", *activity.zone_columns("pickup"), *activity.zone_columns("dropoff")
    )


def pickup_point(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_of(_curated(spark, sf), adapters.zone_boxes(spark, sf), "pickup")


def dropoff_point(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_of(_curated(spark, sf), adapters.zone_boxes(spark, sf), "dropoff")


def pickup_point_keep(spark: SparkSession, sf: str) -> DataFrame:
    zones = adapters.zone_boxes(spark, sf)
    return _zone_of(_curated(spark, sf), zones, "pickup", unmatched="keep")


def pickup_point_many(spark: SparkSession, sf: str) -> DataFrame:
    zones = adapters.many_boxes(spark, sf)
    return _zone_of(_curated(spark, sf), zones, "pickup", unmatched="keep")


def pickup_point_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    zones = adapters.many_boxes(spark, sf)
    return _zone_of(_curated(spark, sf), zones, "pickup", join="merge")


def enriched_by_box(spark: SparkSession, sf: str) -> DataFrame:
    source = ZoneSource("boxes", boxes=adapters.zone_boxes(spark, sf))
    return enrich.enrich_trips(_curated(spark, sf), source)


def by_box_volume(spark: SparkSession, sf: str) -> DataFrame:
    trips = _volume_points(spark, sf)
    return _zone_of(trips, adapters.many_boxes(spark, sf), "pickup", unmatched="keep")


def by_grid_volume(spark: SparkSession, sf: str) -> DataFrame:
    trips = _volume_points(spark, sf)
    return _on_grid(trips)


def dedupe_text_ids(spark: SparkSession, sf: str) -> DataFrame:
    named = _raw(spark, sf).withColumn("trip_id", F.concat(F.lit("t-"), F.col("trip_id").cast("string")))
    trips = preprocess.standard_trips(named)
    return cleaning.dedupe_trips(trips.drop("dropoff_datetime", "trip_distance_km", "fare_amount"))


def raw_without_fare(spark: SparkSession, sf: str) -> DataFrame:
    return columns.standardize_columns(adapters.trips_total_amount(spark, sf)).select("trip_id", "fare_amount")


def zones_of_grid(spark: SparkSession, sf: str) -> DataFrame:
    grid = boxes.grid_zones(_curated(spark, sf))
    bounds = ("min_longitude", "max_longitude", "min_latitude", "max_latitude")
    return grid.select("zone_id", "zone_name", *[F.round(c, 9).alias(c) for c in bounds])


def enriched_by_grid(spark: SparkSession, sf: str) -> DataFrame:
    return _on_grid(_curated(spark, sf))


def _on_grid(trips: DataFrame) -> DataFrame:
    return boxes.attach_grid(trips, boxes.trip_grid(trips), "pickup", unmatched="keep").select(
        "trip_id", "pickup_longitude", "pickup_latitude", "pickup_zone_id", "pickup_zone_name"
    )


def streamed_hours(spark: SparkSession, sf: str) -> DataFrame:
    """The curated trips as a stream of files, with the hours that it wrote."""
    scratch = scratch_dir(spark, "hours")
    trips = _fares(spark, sf)
    trips.write.parquet(f"{scratch}/trips")
    arriving = spark.readStream.schema(trips.schema).parquet(f"{scratch}/trips")
    return rounded(drain(hourly_demand_stream(arriving), scratch))


def _landed(spark: SparkSession, trips: DataFrame, name: str, late: bool = False):
    """(scratch folder, trips with their arrival batch, batch numbers), the trips written once."""
    scratch = scratch_dir(spark, name)
    adapters.with_arrival(trips, late).write.parquet(f"{scratch}/trips")
    arriving = spark.read.parquet(f"{scratch}/trips")
    return scratch, arriving, adapters.arrival_batches(arriving)


def streamed_hours_in_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Hours of trips that arrive in batches, out of order, some of them too late to count."""
    scratch, arriving, batches = _landed(spark, _fares_by_id(spark, sf), "late-hours", late=True)
    adapters.land(arriving, f"{scratch}/landed", batches)
    stream = file_stream(spark, arriving.drop("arrival_batch").schema, f"{scratch}/landed", files_per_batch=1)
    return rounded(drain(hourly_demand_stream(stream), scratch))


def streamed_unique_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicates that arrive in any order and in several batches, with a restart in between."""
    scratch, arriving, batches = _landed(spark, _clean_keys(spark, sf), "unique-trips")
    schema = arriving.drop("arrival_batch").schema
    for some in (batches[:2], batches[2:]):
        adapters.land(arriving, f"{scratch}/landed", some)
        found = drain(dedupe_stream(file_stream(spark, schema, f"{scratch}/landed", files_per_batch=1)), scratch)
    return found


def streamed_zone_names(spark: SparkSession, sf: str) -> DataFrame:
    """Zone names from a lookup of which a new version is published after the third batch."""
    scratch, arriving, batches = _landed(spark, _located(spark, sf), "zone-names")
    log = TableLog(spark, f"{scratch}/lookup")
    names = adapters.zone_lookup(spark, sf)
    renamed = names.withColumn("zone_name", F.concat("zone_name", F.lit(" (2)")))
    schema = arriving.drop("arrival_batch").schema
    for run, table, some in (("first", names, batches[:3]), ("second", renamed, batches[3:])):
        table.write.mode("overwrite").parquet(log.folder(run))
        log.publish(run, "overwrite", {None: log.folder(run)})
        adapters.land(arriving, f"{scratch}/landed", some)
        stream = file_stream(spark, schema, f"{scratch}/landed", files_per_batch=1)
        start_zone_stream(stream, log, f"{scratch}/named", f"{scratch}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{scratch}/named").select("trip_id", "pickup_zone_id", "pickup_zone_name", "pickup_borough")


def curated_in_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Raw trips that come in three sets of files, taken in one after the other, kept by day."""
    scratch = scratch_dir(spark, "monthly")
    raw = _raw(spark, sf)
    for part in range(3):
        raw.where(F.col("trip_id") % 3 == part).write.mode("append").parquet(f"{scratch}/trips")
        monthly.add_files(spark, f"{scratch}/trips", f"{scratch}/curated", period="yyyy-MM-dd")
    return monthly.curated_months(spark, f"{scratch}/curated")


def stored_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table that is replaced, added to, and added to again by a run that is repeated."""
    store = TableStore("trips", scratch_dir(spark, "store"), versioned=True)
    trips = _curated(spark, sf).select("trip_id", "payment_type", "fare_amount")
    save_table(trips, store, "fares", run="old")
    save_table(trips.where("trip_id % 2 = 0"), store, "fares", run="even")
    for _ in range(2):
        save_table(trips.where("trip_id % 2 = 1"), store, "fares", "append", run="odd")
    return read_table(spark, store, "fares")


def exported_array(spark: SparkSession, sf: str) -> DataFrame:
    """The revenue table, written as one JSON array and read again."""
    path = f"{scratch_dir(spark, 'export')}/revenue.json"
    table = _over(_by_payment, rounded)(spark, sf)
    export(table, path, "json_array")
    return spark.read.schema(table.schema).option("multiLine", True).json(path)


def unlike_files(spark: SparkSession, sf: str) -> DataFrame:
    """Trips from files of three kinds: whole passenger counts, fractional ones, and text with another column."""
    folder = f"{scratch_dir(spark, 'unlike')}/trips"
    raw = _raw(spark, sf).select("trip_id", "PULocationID", "fare_amount", "passenger_count")
    kinds = (
        raw,
        raw.withColumn("passenger_count", F.col("passenger_count").cast("double")),
        raw.withColumn("passenger_count", F.col("passenger_count").cast("string")).withColumn("note", F.lit("text")),
    )
    for part, rows in enumerate(kinds):
        rows.where(F.col("trip_id") % 3 == part).write.mode("append").parquet(folder)
    return scan_trips(spark, folder)


def checked_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup file in which some rows are broken: those are left out."""
    path = f"{scratch_dir(spark, 'lookup')}/lookup"
    names = adapters.zone_lookup(spark, sf)
    key = F.col("location_id")
    number = F.when(key % 7 == 0, F.concat(F.lit("no "), key.cast("string"))).otherwise(key.cast("string"))
    last = F.concat(F.lit(","), "service_zone")
    ending = F.when(key % 7 == 1, "").when(key % 7 == 2, F.concat(last, F.lit(",more"))).otherwise(last)
    lines = names.coalesce(1).select(F.concat(F.concat_ws(",", number, "borough", "zone_name"), ending).alias("value"))
    header = spark.createDataFrame([("LocationID,Borough,Zone,service_zone",)], "value string")
    header.union(lines).coalesce(1).write.text(path)
    return read_zone_lookup(spark, path)


def _funnel(table: Query) -> Query:
    return _over(table, preprocess.standard_trips, quality.quality_funnel)


QUERIES: dict[str, Query] = {
    # sources
    "scan_trips": scan,
    "trips_raw": _raw,
    "zone_lookup": adapters.zone_lookup,
    "dataset_overview": _over(_raw, quality.dataset_overview),
    "dataset_preview": _over(_raw, quality.preview),
    # columns, keys and duplicates
    "standardize_columns": _over(_raw, columns.standardize_columns),
    "drop_null_keys": _over(_standard, cleaning.drop_null_keys),
    "drop_nan_keys": _over(_standard, cleaning.drop_nan_keys),
    "dedupe_trips": _over(_clean_keys, cleaning.dedupe_trips),
    "dedupe_by_trip_id": _over(_trip_ids_only, cleaning.dedupe_trips),
    "dedupe_by_text_id": dedupe_text_ids,
    "total_amount_fare": raw_without_fare,
    "clean_trips": _over(_standard, cleaning.clean_trips),
    # derived columns
    "parse_timestamps": parse_text_times,
    "trip_duration": _over(_timed, _keeping(*TIMES, "trip_duration_min")),
    "hour_of_day": _over(_timed, _keeping("hour_of_day")),
    "day_of_week": _over(_timed, _keeping("day_of_week")),
    "day_name": _over(_timed, _keeping("day_name")),
    "derive_trips": _over(_standard, derive.derive_trips),
    # range rules
    "filter_duration": _over(_timed, derive.filter_duration, _keeping("trip_duration_min")),
    "filter_duration_keep_null": _over(
        _timed,
        lambda t: derive.filter_duration(t, null_duration="keep"),
        _keeping("trip_duration_min"),
    ),
    "filter_distance": _over(_timed, outliers.filter_distance, _keeping("trip_distance_km")),
    "filter_fare": _over(_timed, outliers.filter_fare, _keeping("fare_amount")),
    "filter_zero_distance": _over(
        _timed,
        outliers.filter_zero_distance,
        _keeping("trip_distance_km", "trip_duration_min"),
    ),
    "filter_outliers": _over(
        _timed,
        outliers.filter_outliers,
        _keeping("trip_distance_km", "trip_duration_min", "fare_amount"),
    ),
    # data quality
    "null_profile": _over(_raw, quality.null_profile),
    "quality_funnel": _funnel(_raw),
    "data_quality_rate": _over(_funnel(_raw), quality.data_quality_rate, rounded),
    "curated_trips": _curated,
    "curated_preview": _over(_curated, quality.curated_preview),
    # zones
    "enrich_pickup_lookup": pickup_lookup,
    "enrich_dropoff_lookup": dropoff_lookup,
    "enriched_trips": _enriched,
    "enriched_preview": _over(_enriched, quality.enriched_preview),
    "zone_name_fallback": zone_names_from_ids,
    "zone_of_pickup_point": pickup_point,
    "zone_of_dropoff_point": dropoff_point,
    "zone_first_match": pickup_point_keep,
    "zone_of_point_many_boxes": pickup_point_many,
    "zone_of_point_shuffled": pickup_point_shuffled,
    "enriched_by_box": enriched_by_box,
    "coordinate_bounds": _over(_curated, boxes.coordinate_bounds),
    "grid_zones": zones_of_grid,
    "enriched_by_grid": enriched_by_grid,
    "zone_coverage": _over(_zoned, enrich.zone_coverage),
    # demand
    "demand_by_hour": _over(_by_hour, rounded),
    "demand_by_day": _over(_by_day, rounded),
    "weekday_weekend": _over(_by_day, demand.weekday_weekend, rounded),
    "peak_hour": _over(_by_hour, demand.peak_hour, rounded),
    "busiest_day": _over(_by_day, demand.busiest_day, rounded),
    "quietest_day": _over(_by_day, demand.quietest_day, rounded),
    "hour_extremes": _over(_by_hour, demand.hour_extremes, rounded),
    "duration_distance_by_hour": _over(_fares, demand.duration_distance_by_hour, rounded),
    "duration_distance_by_zone": _over(_zoned, demand.duration_distance_by_zone, rounded),
    # zone activity
    "top_origin_zones": _over(_zoned, activity.top_origin_zones, rounded),
    "top_destination_zones": _over(_zoned, activity.top_destination_zones, rounded),
    "zone_activity": _over(_zoned, activity.zone_activity, rounded),
    "most_active_zone": _over(_zoned, activity.most_active_zone, rounded),
    "revenue_by_zone": _over(_zoned, activity.revenue_by_zone, rounded),
    # revenue
    "payment_distribution": _over(_payments, revenue.payment_distribution),
    "payment_names": _over(
        _payments, revenue.add_payment_name, _keeping("payment_type", "payment_type_name")
    ),
    "revenue_by_payment": _over(_by_payment, rounded),
    "total_revenue": _over(_by_payment, revenue.total_revenue, rounded),
    "revenue_per_trip": _over(_fares, revenue.revenue_per_trip, rounded),
    "revenue_split": _over(_payments, revenue.revenue_split, rounded),
    # whole jobs
    "total_trips": _over(_zoned, summary.total_trips),
    "summary": _over(_zoned, summary.summary, rounded),
    "report_groups": _over(_zoned, report.report_groups, rounded),
    # the hourly stream, run to its end, and its batch form
    "stream_hourly_demand": streamed_hours,
    "closed_hours": _over(_fares, closed_hours, rounded),
    # streams in several batches
    "stream_hourly_batches": streamed_hours_in_batches,
    "stream_dedupe_trips": streamed_unique_trips,
    "stream_zone_names": streamed_zone_names,
    # files and tables that change
    "scan_unlike_files": unlike_files,
    "zone_lookup_checked": checked_lookup,
    "incremental_curation": curated_in_steps,
    "stored_table": stored_table,
    "json_array_export": exported_array,
    # the same jobs on the largest table
    "curated_trips_volume": _over(adapters.trips_volume, preprocess.curate_trips),
    "quality_funnel_volume": _funnel(adapters.trips_volume),
    "enriched_by_box_volume": by_box_volume,
    "enriched_by_grid_volume": by_grid_volume,
    "demand_by_hour_volume": _over(_volume_fares, demand.demand_by_hour, rounded),
    "demand_by_day_volume": _over(_volume_fares, demand.demand_by_day, rounded),
    "zone_activity_volume": _over(_volume_zoned, activity.zone_activity, rounded),
    "revenue_by_payment_volume": _over(_volume_payments, revenue.revenue_by_payment, rounded),
    "summary_volume": _over(_volume_zoned, summary.summary, rounded),
    "report_groups_volume": _over(_volume_zoned, report.report_groups, rounded),
}


def in_utc(query: Query) -> Query:
    """The test tables hold UTC times; fix the session zone before planning."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf)

    return run


def all_queries() -> dict[str, Query]:
    return {name: in_utc(query) for name, query in QUERIES.items()}
