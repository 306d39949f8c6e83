"""Shapes of physical plans that decide how a job scales."""

from __future__ import annotations

import re

import pytest

from helpers import plan
from tripflow import adapters
from tripflow.operators import demand
from tripflow.plans.preprocess import curate_trips
from tripflow.plans.report import report_groups
from tripflow.queries import all_queries

PYTHON = re.compile(r"ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", list(all_queries()))
def test_no_cross_join_and_no_python(spark, small, name):
    text = plan(all_queries()[name](spark, small))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert not PYTHON.search(text)


@pytest.fixture
def trip_file(spark, small, tmp_path):
    path = str(tmp_path / "trips")
    adapters.trips_raw(spark, small).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def exchanges(text: str) -> int:
    return len(re.findall(r"^\s*[:+\-| ]*Exchange \(", text, re.M))


def test_filters_and_columns_reach_the_scan(spark, trip_file):
    text = plan(demand.demand_by_hour(curate_trips(trip_file, columns=[])))
    scan = text[text.index("Scan parquet") :]
    schema = re.search(r"ReadSchema: struct<(.*?)>\n", scan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "trip_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount",
    }
    pushed = re.search(r"PushedFilters: \[(.*?)\]", scan).group(1)
    for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount"):
        assert f"IsNotNull({name})" in pushed


def test_curation_shuffles_once_and_filters_duration_before(spark, trip_file):
    text = plan(curate_trips(trip_file))
    assert exchanges(text) == 1
    below = text[text.index("(2) Filter") : text.index("(3) Project")]
    assert "dropoff" in below and "180.0" in below


def test_activity_reads_the_trips_once(spark, small):
    for name in ("zone_activity", "summary", "report_groups"):
        text = plan(all_queries()[name](spark, small))
        assert text.count("events.parquet") == 1, name


def test_lookup_is_broadcast(spark, small):
    text = plan(all_queries()["enriched_trips"](spark, small))
    assert text.count("BroadcastHashJoin LeftOuter") >= 2 and "SortMergeJoin" not in text


def test_boxes_are_matched_without_moving_trips(spark, trip_file, small):
    from tripflow.operators.boxes import attach_boxes
    from tripflow.operators.columns import standardize_columns

    trips = standardize_columns(trip_file)
    matched = attach_boxes(trips, adapters.zone_boxes(spark, small), "pickup")
    text = plan(matched)
    assert "Join" not in text and exchanges(text) == 0
    many = plan(attach_boxes(trips, adapters.many_boxes(spark, "/root/testdata/sf0.01"), "pickup"))
    assert "BroadcastHashJoin Inner" in many


def test_groupings_share_one_aggregation(spark, trip_file):
    text = plan(report_groups(demand_ready(trip_file)))
    assert text.count("Expand") >= 1 and exchanges(text) == 2


def demand_ready(trips):
    from tripflow.operators.enrich import enrich_trips
    from tripflow.sources import ZoneSource

    return enrich_trips(curate_trips(trips), ZoneSource("ids"))
