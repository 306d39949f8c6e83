from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import bag, plan, rows
from tripflow import adapters
from tripflow.operators import cleaning, columns, quality
from tripflow.plans.preprocess import curate_trips, plausible_trips, standard_trips

NAN = float("nan")
SCHEMA = (
    "trip_id bigint, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
    "trip_distance_km double, fare_amount double, payment_type int"
)
T0 = dt.datetime(2025, 1, 1, 8, 0)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_standardize_renames_only_free_names(spark):
    both = spark.createDataFrame([(1.0, 2.0)], "total_amount double, fare_amount double")
    assert columns.standardize_columns(both).columns == ["total_amount", "fare_amount"]
    total = spark.createDataFrame([(1.0,)], "total_amount double")
    assert columns.standardize_columns(total).columns == ["fare_amount"]
    ids = spark.createDataFrame([(1, 2, 3)], "PULocationID int, DOLocationID int, pulocationid2 int")
    assert columns.standardize_columns(ids).columns == [
        "pickup_location_id",
        "dropoff_location_id",
        "pulocationid2",
    ]


def test_standardize_keeps_odd_names(spark):
    odd = spark.createDataFrame([(1, 2)], "`a.b` int, `c ``d` int")
    assert columns.standardize_columns(odd).columns == ["a.b", "c `d"]


def test_conform_casts_and_nulls_unreadable(spark):
    text = spark.createDataFrame([("1.5", "2"), ("x", "y")], "fare_amount string, payment_type string")
    got = columns.conform_types(text)
    assert dict(got.dtypes) == {"fare_amount": "double", "payment_type": "int"}
    assert bag(got) == [(1.5, 2), (None, None)]


@pytest.mark.parametrize(
    ("names", "keys"),
    [
        (
            ["fare_amount", "trip_distance", "tpep_dropoff_datetime", "tpep_pickup_datetime"],
            ["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount"],
        ),
        (["Pickup_Time", "pickup_time_2", "FareAmount"], ["Pickup_Time", "FareAmount"]),
        (["total_amount", "vendor"], []),
    ],
)
def test_key_fields(names, keys):
    assert columns.key_fields(names) == keys


def test_available_keeps_order_of_request(spark):
    table = spark.createDataFrame([(1, 2)], "b int, a int")
    assert columns.available(table, ["a", "missing", "b"]).columns == ["a", "b"]


def test_null_and_nan_rules_are_separate(spark):
    trips = spark.createDataFrame(
        [(1, at(0), at(5), NAN, 1.0, 1), (2, at(0), None, 1.0, 1.0, 1), (3, at(0), at(5), 1.0, None, 1)],
        SCHEMA,
    )
    assert [r[0] for r in cleaning.drop_null_keys(trips).collect()] == [1]
    assert [r[0] for r in cleaning.drop_nan_keys(trips).collect()] == [2, 3]


def test_survivor_is_lowest_with_nulls_first(spark):
    trips = spark.createDataFrame(
        [(2, at(0), at(5), 1.0, 9.0, 1), (1, at(0), at(5), 3.0, 9.0, 1), (1, at(0), at(5), 3.0, 9.0, None)],
        SCHEMA,
    )
    assert cleaning.dedupe_trips(trips).collect() == [(1, at(0), at(5), 3.0, 9.0, None)]


def test_dedupe_by_id_when_times_are_missing(spark):
    trips = spark.createDataFrame([(1, 5.0), (1, 4.0), (2, 1.0), (None, 1.0), (None, 2.0)], "trip_id bigint, tip double")
    assert bag(cleaning.dedupe_trips(trips)) == bag(
        spark.createDataFrame([(1, 4.0), (2, 1.0), (None, 1.0)], "trip_id bigint, tip double")
    )


def test_no_key_no_dedupe(spark):
    trips = spark.createDataFrame([(1.0,), (1.0,)], "tip double")
    assert cleaning.dedupe_trips(trips).count() == 2


@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_survivors_do_not_depend_on_partitioning(spark, small, partitions):
    raw = adapters.trips_raw(spark, small)
    want = bag(curate_trips(raw))
    assert bag(curate_trips(raw.repartition(partitions, F.rand(partitions)))) == want


def test_survivors_do_not_depend_on_column_order(spark, small):
    raw = adapters.trips_raw(spark, small)
    assert bag(curate_trips(raw.select(*reversed(raw.columns)))) == bag(curate_trips(raw))


def test_pruned_columns_keep_their_values(spark, small):
    raw = adapters.trips_raw(spark, small).withColumn("extra", F.rand(3))
    full = curate_trips(raw)
    pruned = curate_trips(raw, columns=["pickup_location_id"])
    assert "extra" not in pruned.columns and "passenger_count" not in pruned.columns
    assert bag(pruned) == bag(full.select(*pruned.columns))


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A third of all rows share one key; each map task may send one of them."""
    n = 30_000
    trips = spark.range(n, numPartitions=6).select(
        (F.lit(n) - F.col("id")).alias("trip_id"),
        F.expr(f"timestamp_ntz'2025-01-01 00:00:00' + interval '1' second * if(id % 3 = 0, 0, id)").alias(
            "pickup_datetime"
        ),
        F.expr("timestamp_ntz'2025-03-01 00:00:00'").alias("dropoff_datetime"),
        F.lit(1.0).alias("trip_distance_km"),
        F.lit(2.0).alias("fare_amount"),
    )
    kept = cleaning.dedupe_trips(trips)
    assert kept.count() == n - n // 3 + 1
    hot = kept.where("pickup_datetime = timestamp_ntz'2025-01-01 00:00:00'").collect()
    assert [r["trip_id"] for r in hot] == [3]
    before_shuffle = plan(kept).split("Exchange", 2)[1]
    assert "partial_min" in plan(kept) and "SortAggregate" in before_shuffle


def test_null_profile_counts_null_and_nan(spark):
    table = spark.createDataFrame([(1, NAN, "a"), (None, None, None), (2, 1.0, "b")], "i int, d double, s string")
    assert bag(quality.null_profile(table)) == [("d", 2), ("i", 1), ("s", 1)]


def test_funnel_equals_steps_run_one_by_one(spark, small):
    from tripflow.operators.derive import derive_trips
    from tripflow.operators.outliers import filter_distance, filter_fare, filter_zero_distance

    trips = standard_trips(adapters.trips_raw(spark, small))
    by_step = {r["step"]: r["rows_after"] for r in quality.quality_funnel(trips).collect()}
    cleaned = cleaning.clean_trips(trips)
    derived = derive_trips(cleaned)
    far = filter_distance(derived)
    fair = filter_fare(far)
    assert by_step["raw"] == trips.count()
    assert by_step["not_nan fare_amount"] == cleaning.drop_nan_keys(cleaning.drop_null_keys(trips)).count()
    assert by_step["dedupe"] == cleaned.count()
    assert by_step["duration"] == derived.count()
    assert by_step["distance"] == far.count()
    assert by_step["fare"] == fair.count()
    assert by_step["zero_distance"] == filter_zero_distance(fair).count()


def test_funnel_without_times_or_ids(spark):
    trips = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (NAN, 1.0)], "trip_distance_km double, fare_amount double")
    funnel = {r["step"]: (r["rows_before"], r["rows_after"], r["rows_failing"]) for r in quality.quality_funnel(trips, null_duration="keep").collect()}
    assert funnel["raw"] == (3, 3, 0)
    assert funnel["not_null trip_distance_km"] == (3, 2, 1)
    assert funnel["not_nan trip_distance_km"] == (2, 1, 1)
    assert funnel["distance"] == (1, 1, 0)


def test_funnel_of_empty_table(spark):
    funnel = quality.quality_funnel(spark.createDataFrame([], SCHEMA))
    assert {r["rows_after"] for r in funnel.collect()} == {0}
    assert quality.data_quality_rate(funnel).first()["quality_rate"] is None


def test_overview_and_preview(spark, small):
    raw = adapters.trips_raw(spark, small)
    overview = quality.dataset_overview(raw).collect()
    assert [r["column_name"] for r in overview] == raw.columns
    assert {r["total_records"] for r in overview} == {1039}
    first = rows(quality.preview(raw))
    assert rows(quality.preview(raw.repartition(5))) == first and len(first) == 5


def test_text_ids_stay_and_tell_trips_apart(spark):
    from tripflow.operators.cleaning import dedupe_trips
    from tripflow.operators.columns import conform_types

    trips = conform_types(spark.createDataFrame([("a-1", 1.0), ("b-2", 2.0), ("c-3", 3.0)], "trip_id string, tip double"))
    assert sorted(r["trip_id"] for r in dedupe_trips(trips).collect()) == ["a-1", "b-2", "c-3"]
    narrow = conform_types(spark.createDataFrame([(1,)], "trip_id int"))
    assert narrow.schema["trip_id"].dataType.simpleString() == "bigint"


def test_columns_without_an_order_are_carried(spark):
    from tripflow.operators.cleaning import dedupe_trips

    trips = spark.createDataFrame([(1, 5.0, {"k": "b"}), (1, 4.0, {"k": "a"})], "trip_id bigint, tip double, more map<string,string>")
    assert [tuple(r) for r in dedupe_trips(trips).collect()] == [(1, 4.0, {"k": "a"})]


def test_one_shuffle_gives_funnel_and_curated_trips(spark, small):
    trips = standard_trips(adapters.trips_raw(spark, small))
    for case in (trips, trips.drop("dropoff_datetime", "trip_distance_km"), trips.drop("dropoff_datetime", "trip_distance_km", "fare_amount", "trip_id")):
        groups = quality.quality_groups(case)
        assert bag(plausible_trips(quality.cleaned_rows(groups), null_duration="keep")) == bag(
            curate_trips(case, null_duration="keep")
        )
        assert bag(quality.funnel_of_groups(groups)) == bag(quality.quality_funnel(case))
