from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import cell
from tripflow import adapters
from tripflow.constants import RESULT_TABLES
from tripflow.operators.enrich import enrich_trips
from tripflow.plans.analyses import ANALYSES, run_analyses
from tripflow.plans.preprocess import curate_trips, preprocess
from tripflow.plans.report import report_groups, report_tables, run_report
from tripflow.plans.summary import summary, summary_of_tables
from tripflow.plans.views import register_views
from tripflow.queries import rounded
from tripflow.sinks import TableStore
from tripflow.sources import ZoneSource


def ordered(table):
    result = rounded(table)
    return result.columns, [tuple(map(cell, row)) for row in result.collect()]


@pytest.fixture(scope="module")
def enriched(spark):
    sf = "/root/testdata/sf0.001"
    source = ZoneSource("lookup", lookup=adapters.zone_lookup(spark, sf))
    table = enrich_trips(curate_trips(adapters.trips_raw(spark, sf)), source).cache()
    yield table
    table.unpersist()


def test_one_pass_tables_equal_the_single_analyses(enriched):
    """Same columns, rows and order, whichever way a table is made."""
    tables = report_tables(report_groups(enriched))
    results, unmet = run_analyses(enriched)
    assert not unmet and set(results) == set(ANALYSES) <= set(tables)
    for name, result in results.items():
        assert ordered(tables[name]) == ordered(result), name


def test_analyses_report_missing_columns(enriched):
    results, unmet = run_analyses(enriched.drop("payment_type", "dropoff_zone_name"))
    assert unmet == {
        "top_destination_zones": ["dropoff_zone_name"],
        "zones_activity": ["dropoff_zone_name"],
        "revenue_analysis": ["payment_type"],
    }
    assert "trips_by_hour" in results


def test_report_without_zones_and_payments(enriched):
    bare = enriched.select("hour_of_day", "fare_amount", "trip_distance_km", "trip_duration_min")
    assert set(report_tables(report_groups(bare))) == {"trips_by_hour", "trip_duration_stats", "hour_extremes", "totals"}


def test_summary_of_no_trips(enriched):
    row = summary(enriched.where("false")).first()
    assert row["total_trips"] == 0 and row["peak_hour"] is None


@pytest.fixture(scope="module")
def trip_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("trips")
    adapters.trips_raw(spark, "/root/testdata/sf0.001").repartition(3).write.mode("overwrite").parquet(
        str(folder)
    )
    return str(folder)


def test_whole_run(spark, trip_dir, enriched, tmp_path):
    lookup = tmp_path / "lookup.csv"
    zones = adapters.zone_lookup(spark, "/root/testdata/sf0.001").collect()
    lookup.write_text(
        "LocationID,Borough,Zone,service_zone\n" + "".join(",".join(map(str, z)) + "\n" for z in zones)
    )
    out = str(tmp_path / "out")
    report = run_report(
        spark, trip_dir, out, lookup_path=str(lookup), store=TableStore("db", f"{out}/store")
    )
    hourly = spark.read.csv(report.exports["trips_by_hour"], header=True, inferSchema=True)
    assert report.exports["trips_by_hour"].endswith("/hourly_demand.csv")
    assert hourly.columns == [
        "hour_of_day", "total_trips", "avg_duration_min", "avg_distance_km", "total_revenue", "avg_fare_amount",
    ]
    assert set(report.exports) == set(report.tables) >= {"quality_funnel", "zones_activity", "totals"}
    assert {k for k, v in report.stored.items() if v == "saved"} == set(RESULT_TABLES)
    expected = run_analyses(enriched)[0]
    for name in ("trips_by_day", "zones_activity", "revenue_analysis"):
        assert ordered(report.tables[name]) == ordered(expected[name]), name
    headlines = {r["headline"]: r["value"] for r in summary_of_tables(report.tables).collect()}
    one = summary(enriched).first()
    assert headlines["total trips"] == str(one["total_trips"])
    assert headlines["peak hour"] == str(one["peak_hour"])
    assert headlines["busiest day"] == one["busiest_day"]
    assert headlines["most active zone"] == one["most_active_zone"]
    last = report.tables["quality_funnel"].orderBy("step_no").collect()[-1]
    assert last["rows_after"] == one["total_trips"]


def test_run_with_boxes_and_curated_table(spark, trip_dir, tmp_path):
    boxes = tmp_path / "boxes.csv"
    adapters.zone_boxes(spark, "/root/testdata/sf0.001").coalesce(1).write.csv(str(boxes), header=True)
    report = run_report(
        spark, trip_dir, str(tmp_path / "out"), boxes_path=str(boxes), lookup_path=str(tmp_path / "no.csv"),
        curated_path=str(tmp_path / "curated"), format="json", profile=False,
    )
    assert spark.read.parquet(str(tmp_path / "curated")).count() == preprocess(spark, trip_dir).count()
    trips = preprocess(spark, trip_dir).count()
    assert report.tables["totals"].first()["total_trips"] == trips == 798
    coverage = report.tables["zone_coverage"].first()
    assert coverage["total_trips"] == trips > coverage["with_pickup_zone"] > 499
    assert report.exports["zone_coverage"].endswith("zone_coverage.json")
    dropped = run_report(
        spark, trip_dir, str(tmp_path / "dropped"), boxes_path=str(boxes), profile=False, unmatched="drop"
    )
    assert dropped.tables["totals"].first()["total_trips"] == trips
    activity = dropped.tables["duration_by_zone"].agg(F.sum("trip_count")).first()[0]
    assert activity == 499
    assert report.exports["zones_activity"].endswith("zone_activity.json")


def test_run_with_a_grid(spark, trip_dir, tmp_path):
    report = run_report(spark, trip_dir, str(tmp_path / "out"), profile=False)
    zones = [r["zone_id"] for r in report.tables["zones_activity"].collect()]
    assert sorted(z for z in zones if z) == list(range(1, 17))
    assert report.tables["totals"].first()["total_trips"] == 798


def test_arguments_are_checked_first(spark, tmp_path):
    for wrong in ({"format": "xlsx"}, {"unmatched": "some"}, {"null_duration": "some"}):
        with pytest.raises(ValueError):
            run_report(spark, "/no/such/place", str(tmp_path / "out"), **wrong)
    assert not (tmp_path / "out").exists()


def test_views(spark, enriched):
    names = register_views(enriched, enriched, ZoneSource("ids"))
    assert names == ["trips_curated", "trips_enriched"]
    count = spark.sql("select count(*) from trips_enriched where pickup_borough is not null").first()[0]
    assert 0 < count <= enriched.count()
