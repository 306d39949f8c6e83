"""Curated trips kept by month."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import bag
from tripflow import adapters
from tripflow.plans import monthly
from tripflow.plans.preprocess import curate_trips, preprocess
from tripflow.sinks import TableLog

TRIP = "trip_id bigint, tpep_pickup_datetime string, tpep_dropoff_datetime string, trip_distance double, fare_amount double"


def trip(n, day, minutes=10, fare=9.0):
    return (n, f"{day} 10:00:{n % 60:02}", f"{day} 10:{minutes}:{n % 60:02}", 2.0, fare)


def land(spark, folder, rows, schema=TRIP):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "trips"), str(tmp_path / "curated")


def test_any_order_of_files_gives_the_full_run(spark, small, places):
    raw = adapters.trips_raw(spark, small)
    for part in (2, 0, 1):
        raw.where(F.col("trip_id") % 3 == part).write.mode("append").parquet(places[0])
        monthly.add_files(spark, *places, period="yyyy-MM-dd")
    assert bag(monthly.curated_months(spark, places[1])) == bag(curate_trips(raw))
    assert len({line.part for line in TableLog(spark, places[1]).current()}) == 30


def test_a_new_month_touches_no_other(spark, places):
    land(spark, places[0], [trip(1, "2025-01-05"), trip(2, "2025-02-05")])
    assert monthly.add_files(spark, *places) == ["2025-01", "2025-02"]
    before = {line.part: line.folder for line in TableLog(spark, places[1]).current()}
    land(spark, places[0], [trip(3, "2025-03-05")])
    assert monthly.add_files(spark, *places) == ["2025-03"]
    after = {line.part: line.folder for line in TableLog(spark, places[1]).current()}
    assert {part: after[part] for part in before} == before and set(after) == {*before, "2025-03"}
    assert monthly.add_files(spark, *places) == []
    assert bag(monthly.curated_months(spark, places[1])) == bag(preprocess(spark, places[0]))


def test_adding_reads_the_months_it_writes_only(spark, places, monkeypatch):
    land(spark, places[0], [trip(1, "2025-01-05"), trip(2, "2025-02-05")])
    monthly.add_files(spark, *places)
    land(spark, places[0], [trip(3, "2025-02-07")])
    read = []
    first = monthly.first_per_key
    monkeypatch.setattr(monthly, "first_per_key", lambda rows, keys: read.extend(rows.inputFiles()) or first(rows, keys))
    assert monthly.add_files(spark, *places) == ["2025-02"]
    stored = [file for file in read if "/curated/" in file]
    assert stored and all("2025-02" in file for file in stored)
    assert len([file for file in read if "/trips/" in file]) == 1


def test_duplicates_across_files_and_survivors_that_fail_a_rule(spark, places):
    """A lower duplicate that arrives later replaces the stored one, even if it is then out of range."""
    land(spark, places[0], [trip(5, "2025-01-05"), trip(7, "2025-01-06")])
    monthly.add_files(spark, *places)
    low = (4, *trip(5, "2025-01-05")[1:4], 2000.0)
    land(spark, places[0], [low, trip(7, "2025-01-06")])
    assert monthly.add_files(spark, *places) == ["2025-01"]
    assert [r.trip_id for r in monthly.unique_trips(spark, places[1]).orderBy("trip_id").collect()] == [4, 7]
    assert bag(monthly.curated_months(spark, places[1])) == bag(preprocess(spark, places[0]))
    assert [r.trip_id for r in monthly.curated_months(spark, places[1]).collect()] == [7]


def test_a_run_that_dies_is_repeated(spark, places, monkeypatch):
    land(spark, places[0], [trip(1, "2025-01-05")])
    monthly.add_files(spark, *places)
    land(spark, places[0], [trip(2, "2025-01-06")])

    def killed(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(TableLog, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            monthly.add_files(spark, *places)
    assert [r.trip_id for r in monthly.unique_trips(spark, places[1]).collect()] == [1]
    assert monthly.add_files(spark, *places) == ["2025-01"]
    assert monthly.unique_trips(spark, places[1]).count() == 2


def test_unreadable_times_missing_columns_and_empty_files(spark, places):
    land(spark, places[0], [(1, "soon", "later", 2.0, 9.0), (2, None, "2025-01-05 10:00:00", 2.0, 9.0)])
    assert monthly.add_files(spark, *places) == [monthly.UNREADABLE]
    more = spark.createDataFrame([(*trip(3, "2025-01-05"), "new")], TRIP + ", note string")
    more.coalesce(1).write.mode("append").parquet(places[0])
    land(spark, places[0], [])
    assert monthly.add_files(spark, *places) == ["2025-01"]
    land(spark, places[0], [])
    assert monthly.add_files(spark, *places) == [] == monthly.add_files(spark, *places)
    got = monthly.unique_trips(spark, places[1])
    assert sorted((r.trip_id, r.note) for r in got.collect()) == [(1, None), (3, "new")]
    assert bag(monthly.curated_months(spark, places[1])) == bag(preprocess(spark, places[0]))


def test_trips_without_times_have_no_month(spark, places):
    spark.createDataFrame([(1,)], "trip_id bigint").write.parquet(places[0])
    with pytest.raises(ValueError, match="month"):
        monthly.add_files(spark, *places)
    with pytest.raises(FileNotFoundError):
        monthly.curated_months(spark, places[1])
    with pytest.raises(FileNotFoundError):
        monthly.add_files(spark, places[1], places[1])
