from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tripflow.constants import Limits
from tripflow.functions import day_name, payment_label, trip_minutes
from tripflow.operators import derive, outliers

TIMES = "pickup_datetime {0}, dropoff_datetime {0}"


def parsed(spark, values, kind="string"):
    table = spark.createDataFrame(values, TIMES.format(kind))
    return [tuple(r) for r in derive.parse_timestamps(table).collect()]


def test_text_times(spark):
    good, day = "2025-02-03 04:05:06", dt.datetime(2025, 2, 3, 4, 5, 6)
    bad = ["2025-02-03", "2025-02-03 04:05:06.5", "n/a", "", None, "2025-02-30 00:00:00", " " + good]
    assert parsed(spark, [(good, b) for b in bad]) == [(day, None)] * len(bad)


@pytest.mark.parametrize("zone", ["UTC", "America/Mexico_City", "Asia/Kolkata"])
def test_wall_clock_does_not_depend_on_the_session_zone(spark, zone_of_session, zone):
    zone_of_session(zone)
    pickup, dropoff = dt.datetime(2025, 3, 9, 1, 30), dt.datetime(2025, 3, 9, 3, 30)
    for kind, values in {
        "timestamp_ntz": (pickup, dropoff),
        "string": (str(pickup), str(dropoff)),
    }.items():
        table = spark.createDataFrame([values], TIMES.format(kind))
        row = derive.add_time_columns(table).first()
        assert (row["hour_of_day"], row["trip_duration_min"]) == (1, 120.0)
        assert (row["day_of_week"], row["day_name"]) == (1, "Sunday")


def test_zoned_timestamps_are_read_in_the_session_zone(spark, zone_of_session):
    zone_of_session("America/New_York")
    table = spark.sql(
        "select timestamp'2025-07-01 17:30:00' pickup_datetime, timestamp'2025-07-01 18:00:00' dropoff_datetime"
    )
    assert derive.add_time_columns(table).first()["hour_of_day"] == 17


def test_minutes_round_half_up_on_whole_seconds(spark):
    seconds = [*range(-130, 400), 10_799, 10_800, 10_801, 86_399, 10_000_019]
    start = dt.datetime(2025, 1, 1)
    table = spark.createDataFrame(
        [(s, start, start + dt.timedelta(seconds=s)) for s in seconds],
        "s bigint, p timestamp_ntz, d timestamp_ntz",
    ).select("s", trip_minutes(F.col("p"), F.col("d")).alias("m"))
    for s, minutes in table.collect():
        exact = (Decimal(s) / 60).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert minutes == float(exact), s


def test_fractions_are_cut_at_both_ends(spark):
    table = spark.createDataFrame(
        [(dt.datetime(2025, 1, 1, 0, 0, 0, 900_000), dt.datetime(2025, 1, 1, 0, 0, 2, 100_000))],
        TIMES.format("timestamp_ntz"),
    )
    assert derive.add_duration(table).first()["trip_duration_min"] == 0.03
    old = spark.createDataFrame(
        [(dt.datetime(1960, 1, 1, 0, 0, 0, 900_000), dt.datetime(1960, 1, 1, 0, 0, 2, 100_000))],
        TIMES.format("timestamp_ntz"),
    )
    assert derive.add_duration(old).first()["trip_duration_min"] == 0.03


def test_missing_time_column(spark):
    table = spark.createDataFrame([(dt.datetime(2025, 1, 1, 7),)], "pickup_datetime timestamp_ntz")
    derived = derive.add_time_columns(table)
    assert derived.first()["trip_duration_min"] is None and derived.first()["hour_of_day"] == 7
    assert derive.derive_trips(table).count() == 0
    assert derive.derive_trips(table, null_duration="keep").count() == 1
    none = derive.add_time_columns(spark.createDataFrame([(1,)], "x int")).first()
    assert (none["hour_of_day"], none["day_of_week"], none["day_name"]) == (None, None, "Unknown")


def test_unknown_null_duration_mode():
    with pytest.raises(ValueError):
        derive.duration_rule(null_duration="maybe")


def test_day_names(spark):
    numbers = spark.createDataFrame([(n,) for n in [1, 2, 7, 0, 8, None]], "n int")
    assert [r[0] for r in numbers.select(day_name(F.col("n"))).collect()] == [
        "Sunday", "Monday", "Saturday", "Unknown", "Unknown", "Unknown",
    ]


def test_payment_labels(spark):
    codes = spark.createDataFrame([(c,) for c in [None, 0, 1, 2, 3, 4, 5, 6, 7, -1]], "c int")
    assert [r[0] for r in codes.select(payment_label(F.col("c"))).collect()] == [
        "Unknown/Not Specified", "Unknown/Not Specified", "Credit Card", "Cash", "No Charge",
        "Dispute", "Unknown", "Voided Trip", "Other (7)", "Other (-1)",
    ]


BELOW, ABOVE = -1e-9, 1e-9


@pytest.mark.parametrize(
    ("name", "low", "high"),
    [("trip_distance_km", 0.1, 200.0), ("fare_amount", 0.0, 1000.0), ("trip_duration_min", 1.0, 180.0)],
)
def test_limits_are_inclusive(spark, name, low, high):
    values = [low + BELOW, low, high, high + ABOVE, None, float("nan")]
    table = spark.createDataFrame([(v,) for v in values], f"{name} double")
    rule = derive.filter_duration if name == "trip_duration_min" else outliers.filter_outliers
    assert [r[0] for r in rule(table).collect()] == [low, high]


def test_zero_distance_rule(spark):
    table = spark.createDataFrame(
        [(0.0, 30.0), (0.0, 30.1), (0.0, None), (None, 5.0), (None, 50.0), (1.0, 99.0)],
        "trip_distance_km double, trip_duration_min double",
    )
    assert outliers.filter_zero_distance(table).collect() == [(0.0, 30.0), (None, 5.0), (1.0, 99.0)]


def test_own_limits(spark):
    table = spark.createDataFrame([(1.0,), (5.0,)], "fare_amount double")
    assert outliers.filter_fare(table, Limits(min_fare=2.0)).collect() == [(5.0,)]
