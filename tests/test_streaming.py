from __future__ import annotations

from types import SimpleNamespace

import pytest

from helpers import bag
from pyspark.sql import functions as F

from tripflow import adapters
from tripflow.operators.cleaning import dedupe_trips
from tripflow.operators.lookup import attach_lookup
from tripflow.plans.preprocess import curate_trips
from tripflow.queries import rounded
from tripflow.sinks import TableLog
from tripflow.streaming import (
    closed_hours,
    closed_trips,
    dedupe_stream,
    drain,
    drop_repeats_stream,
    file_stream,
    hourly_demand_stream,
    scratch_dir,
    start_zone_stream,
)


@pytest.fixture(scope="module")
def curated(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curated"))
    table = curate_trips(adapters.trips_raw(spark, "/root/testdata/sf0.001"))
    table.write.mode("overwrite").parquet(path)
    return path


def drained(spark, stream, tmp_path):
    """Run a stream over all files there are and read what it wrote."""
    out = str(tmp_path / "out")
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    assert query.awaitTermination(300)
    return spark.read.parquet(out)


def source(spark, path):
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def test_stream_equals_batch(spark, curated, tmp_path):
    written = drained(spark, hourly_demand_stream(source(spark, curated)), tmp_path)
    batch = closed_hours(spark.read.parquet(curated))
    assert bag(rounded(written)) == bag(rounded(batch)) and batch.count() > 100


def test_first_arrivals(spark, curated, tmp_path):
    trips = spark.read.parquet(curated)
    twice = str(tmp_path / "twice")
    trips.unionByName(trips).repartition(1).write.parquet(twice)
    written = drained(spark, drop_repeats_stream(source(spark, twice)), tmp_path)
    assert bag(written) == bag(trips)


COPIES = "trip_id bigint, at string, fare_amount double, batch int"


def arrivals(spark, rows):
    """Trips of ten minutes with their arrival batch; ``at`` is a time of one day."""
    table = spark.createDataFrame(rows, COPIES)
    start = F.concat(F.lit("2025-03-01 "), "at").cast("timestamp_ntz")
    return table.select(
        "trip_id",
        start.alias("pickup_datetime"),
        (start + F.expr("interval 10 minutes")).alias("dropoff_datetime"),
        F.lit(1.0).alias("trip_distance_km"),
        "fare_amount",
        F.lit(10.0).alias("trip_duration_min"),
        F.col("batch").alias("arrival_batch"),
    )


def run_in_batches(spark, arriving, make, folder, runs):
    """Land the batches of each run and drain the stream; every run restarts from the checkpoint."""
    schema = arriving.drop("arrival_batch").schema
    for batches in runs:
        adapters.land(arriving, f"{folder}/landed", batches)
        found = drain(make(file_stream(spark, schema, f"{folder}/landed", files_per_batch=1)), str(folder))
    return found


DUPLICATES = [
    (5, "10:00:00", 9.0, 0),
    (3, "10:00:00", 9.0, 1),  # lower id, in a later batch
    (4, "10:00:00", 9.0, 2),
    (1, "11:30:00", 2.0, 2),
    (1, "11:30:00", 1.0, 0),  # same id, lower fare, in an earlier batch
    (1, "11:30:00", 3.0, 1),
    (7, "11:45:00", 1.0, 1),
    (2, "10:00:00", 9.0, 5),  # too late: its key has been emitted
    (8, "20:00:00", 1.0, 3),
    (9, "23:00:00", 1.0, 4),
    (10, "23:30:00", 1.0, 5),
    (11, "23:30:00", 1.0, 5),
]


@pytest.mark.parametrize("runs", [[range(6)], [range(2), range(2, 6)], [[0], [1], [2], [3], [4], [5]]])
def test_survivors_do_not_depend_on_arrival(spark, tmp_path, runs):
    arriving = arrivals(spark, DUPLICATES)
    found = run_in_batches(spark, arriving, dedupe_stream, tmp_path, runs)
    in_time = arriving.where("trip_id != 2").drop("arrival_batch")
    assert bag(found) == bag(closed_trips(in_time))
    assert sorted((r.trip_id, r.fare_amount) for r in found.collect()) == [(1, 1.0), (3, 9.0), (7, 1.0), (8, 1.0)]


def test_unique_trips_of_many_batches_with_a_restart(spark, small, tmp_path):
    """At least five batches, copies spread over them."""
    trips = curate_trips(adapters.trips_raw(spark, small), columns=["trip_id"])
    copies = F.explode(F.array(*[F.lit(float(k)) for k in range(3)]))
    trips = trips.withColumn("more", copies).withColumn("fare_amount", F.col("fare_amount") + F.col("more")).drop("more")
    arriving = adapters.with_arrival(trips)
    batches = adapters.arrival_batches(arriving)
    assert len(batches) >= 5
    found = run_in_batches(spark, arriving, dedupe_stream, tmp_path, [batches[:3], batches[3:]])
    assert bag(found) == bag(closed_trips(trips))
    assert found.count() > 500 and bag(found) == bag(dedupe_trips(found))


def test_stream_needs_the_times_as_keys(spark):
    with pytest.raises(ValueError, match="times"):
        dedupe_stream(spark.createDataFrame([(1,)], "trip_id bigint"))


@pytest.mark.parametrize("restart", [False, True])
def test_hours_of_many_batches_with_late_trips(spark, small, tmp_path, restart):
    trips = curate_trips(adapters.trips_raw(spark, small), columns=["trip_id"])
    arriving = adapters.with_arrival(trips, late=True)
    batches = adapters.arrival_batches(arriving)
    assert len(batches) >= 5
    runs = [batches[:4], batches[4:]] if restart else [batches]
    found = run_in_batches(spark, arriving, hourly_demand_stream, tmp_path, runs)
    late = F.col("trip_id") % adapters.LATE_EVERY == 0
    on_time, closed = bag(rounded(closed_hours(trips.where(~late)))), bag(rounded(found))
    assert set(on_time) <= set(closed) and len(closed) - len(on_time) <= 3
    assert trips.where(late).count() > 5 and bag(rounded(closed_hours(trips))) != closed


def test_changed_lookup_is_seen_by_the_next_batch(spark, small, tmp_path):
    names = adapters.zone_lookup(spark, small)
    log = TableLog(spark, str(tmp_path / "lookup"))
    arriving = arrivals(spark, [(k, f"1{k}:00:00", 1.0, k) for k in range(4)])
    arriving = arriving.withColumn("pickup_location_id", F.lit(3))
    schema = arriving.drop("arrival_batch").schema

    def run(batches):
        adapters.land(arriving, str(tmp_path / "landed"), batches)
        stream = file_stream(spark, schema, str(tmp_path / "landed"), files_per_batch=1)
        start_zone_stream(stream, log, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
        return {r.trip_id: r.pickup_zone_name for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    with pytest.raises(Exception, match="no lookup"):
        run([0])
    for version, batches, want in (("one", [], {0: "NATION_3 one"}), ("two", [1, 2], {1: "NATION_3 two", 2: "NATION_3 two"}), ("three", [3], {3: "NATION_3 three"})):
        renamed = names.withColumn("zone_name", F.concat("zone_name", F.lit(f" {version}")))
        renamed.write.parquet(log.folder(version))
        log.publish(version, "overwrite", {None: log.folder(version)})
        got = run(batches)
        assert {k: got[k] for k in want} == want
    assert got[0] == "NATION_3 one" and len(got) == 4


def test_a_cluster_needs_a_shared_folder():
    def session(master, folder=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_dir(session("spark://host:7077"), "x")
    assert scratch_dir(session("yarn", "hdfs://a/b/"), "x").startswith("hdfs://a/b/tripflow/x-")



def test_stream_lookup(spark, curated, small, tmp_path):
    lookup = adapters.zone_lookup(spark, small)
    written = drained(spark, attach_lookup(source(spark, curated), lookup, "pickup"), tmp_path)
    assert bag(written) == bag(attach_lookup(spark.read.parquet(curated), lookup, "pickup"))


def test_hours_do_not_move_with_the_session_zone(spark, zone_of_session, tmp_path):
    text = [("2025-03-09 01:30:00",), ("2025-03-09 02:30:00",), ("2025-03-09 03:30:00",), ("2025-03-09 09:00:00",)]
    trips = spark.createDataFrame(text, "t string").selectExpr(
        "cast(t as timestamp_ntz) as pickup_datetime", "1.0D as trip_duration_min", "1.0D as trip_distance_km", "1.0D as fare_amount"
    )
    path = str(tmp_path / "trips")
    trips.write.parquet(path)
    found = []
    for k, zone in enumerate(("UTC", "America/New_York")):
        zone_of_session(zone)
        (tmp_path / str(k)).mkdir()
        batch = closed_hours(spark.read.parquet(path))
        found.append([str(r["hour_start"]) for r in batch.orderBy("hour_start").collect()])
        written = drained(spark, hourly_demand_stream(source(spark, path)), tmp_path / str(k))
        assert bag(rounded(written)) == bag(rounded(batch))
    assert found[0] == found[1] and [h[11:13] for h in found[0]] == ["01", "02", "03"]
