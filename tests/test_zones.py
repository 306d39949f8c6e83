from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import bag, plan
from tripflow import adapters
from tripflow.operators import boxes, enrich, lookup
from tripflow.plans.preprocess import curate_trips
from tripflow.sources import ZoneFileError, ZoneSource, check_zone_boxes, check_zone_lookup, read_zone_boxes, read_zone_lookup, zone_files

BOX = (
    "zone_id int, zone_name string, min_longitude double, max_longitude double, "
    "min_latitude double, max_latitude double"
)
POINT = "trip_id bigint, pickup_longitude double, pickup_latitude double"
INF, NAN = float("inf"), float("nan")


def brute_force(points, zones):
    """Lowest zone containing each point; NaN ranks above every number, as in Spark."""

    def key(v):
        return (1, 0.0) if v != v else (0, v)

    found = []
    for trip, x, y in points:
        hits = [
            z[0]
            for z in zones
            if None not in (x, y, *z[2:])
            and key(z[2]) <= key(x) <= key(z[3])
            and key(z[4]) <= key(y) <= key(z[5])
        ]
        found.append((trip, min(hits, default=None)))
    return sorted(found, key=repr)


def attached(spark, points, zones, **options):
    trips = spark.createDataFrame(points, POINT)
    table = spark.createDataFrame(zones, BOX)
    result = boxes.attach_boxes(trips, table, "pickup", unmatched="keep", **options)
    return sorted(
        [(r["trip_id"], r["pickup_zone_id"]) for r in result.collect()], key=repr
    )


WAYS = {"indexed": {}, "joined": {"join": "broadcast"}, "merged": {"join": "merge"}}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("seed", [1, 2])
def test_boxes_equal_brute_force(spark, way, seed):
    r = random.Random(seed)
    zones = []
    for i in range(60):
        x, y, scale = r.uniform(-75, -73), r.uniform(40, 41), 10 ** r.uniform(-4, 0.5)
        zones.append((i, f"z{i}", x, x + r.random() * scale, y, y + r.random() * scale))
    edges = [(z[2], z[5]) for z in zones]
    points = [(i, *p) for i, p in enumerate(edges)]
    points += [(1000 + i, r.uniform(-75, -73), r.uniform(40, 41)) for i in range(300)]
    assert attached(spark, points, zones, **WAYS[way]) == brute_force(points, zones)


@pytest.mark.parametrize("way", WAYS)
def test_odd_boxes_and_points(spark, way):
    zones = [
        (5, "world", -INF, INF, -INF, INF),
        (4, "point", 1.0, 1.0, 2.0, 2.0),
        (3, "far", 1e6, 2e6, 1e6, 2e6),
        (2, "reversed", 5.0, 4.0, 0.0, 1.0),
        (1, "unknown", None, 4.0, 0.0, 1.0),
        (6, "nan edge", 0.0, NAN, 0.0, NAN),
    ]
    points = [
        (1, 1.0, 2.0), (2, 1.5e6, 1.5e6), (3, 600.0, 700.0), (4, NAN, 1.0), (5, None, 1.0),
        (6, 4.5, 0.5), (7, -INF, INF), (8, NAN, NAN), (9, 3e6, 0.0),
    ]
    assert attached(spark, points, zones, **WAYS[way]) == brute_force(points, zones)


@pytest.mark.parametrize("way", WAYS)
def test_no_boxes(spark, way):
    assert attached(spark, [(1, 0.0, 0.0)], [], **WAYS[way]) == [(1, None)]


@pytest.mark.parametrize("way", WAYS)
def test_shared_edge_goes_to_the_lower_id_and_identical_trips_stay(spark, way):
    zones = [(2, "B", 0.0, 1.0, 1.0, 2.0), (1, "A", 0.0, 1.0, 0.0, 1.0)]
    points = [(1, 0.5, 1.0)] * 3 + [(2, 0.5, 1.5)]
    assert attached(spark, points, zones, **WAYS[way]) == [(1, 1)] * 3 + [(2, 2)]


def test_unmatched_trips(spark):
    trips = spark.createDataFrame([(1, 0.5, 0.5), (2, 9.0, 9.0)], POINT)
    zones = spark.createDataFrame([(1, "A", 0.0, 1.0, 0.0, 1.0)], BOX)
    assert boxes.attach_boxes(trips, zones, "pickup").count() == 1
    assert boxes.attach_boxes(trips, zones, "pickup", unmatched="keep").count() == 2
    with pytest.raises(ValueError):
        boxes.attach_boxes(trips, zones, "pickup", unmatched="other")


def test_zero_signs_and_other_values_stay(spark):
    trips = spark.createDataFrame([(1, -0.0, 0.0, -0.0)] * 4 + [(2, None, 1.0, 1.0)], POINT + ", fare_amount double")
    zones = spark.createDataFrame([(1, "A", 0.0, 1.0, 0.0, 1.0)], BOX)
    for way in WAYS.values():
        got = boxes.attach_boxes(trips, zones, "pickup", unmatched="keep", **way).orderBy("trip_id").collect()
        assert [r["pickup_zone_id"] for r in got] == [1, 1, 1, 1, None]
        assert all(str(r["fare_amount"]) == "-0.0" == str(r["pickup_longitude"]) for r in got[:4])


def test_plans_are_lazy_and_merged_on_request(spark, small):
    trips = curate_trips(adapters.trips_raw(spark, small))
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    merged = boxes.attach_boxes(trips, adapters.many_boxes(spark, small), "pickup", join="merge")
    grid = boxes.attach_grid(trips, boxes.trip_grid(trips), "pickup")
    reads = len(status.getJobIdsForGroup("building"))
    spark.sparkContext.setJobGroup("running", "running")
    assert reads <= 3  # the adapters read Parquet footers
    assert plan(merged).count("SortMergeJoin") >= 2 and "BroadcastHashJoin" not in plan(merged).split("Initial")[0].replace("nation", "")
    assert grid.count() > 0


@pytest.mark.parametrize("seed", [3, 4])
def test_grid_arithmetic_equals_its_boxes(spark, seed):
    r = random.Random(seed)
    points = [(i, round(r.uniform(-1, 1), 2), round(r.uniform(-1, 1), 2)) for i in range(300)]
    points += [(900, None, 0.0), (901, NAN, 0.0), (902, -1.0, 1.0), (903, 1.0, -1.0)]
    trips = spark.createDataFrame(points, POINT)
    grid = boxes.trip_grid(trips, 49)
    want = boxes.attach_boxes(trips, boxes.zones_of_grid(grid), "pickup", unmatched="keep")
    assert bag(boxes.attach_grid(trips, grid, "pickup", unmatched="keep")) == bag(want)
    corners = [(row[c], row[d]) for row in boxes.zones_of_grid(grid).collect() for c in ("min_longitude", "max_longitude") for d in ("min_latitude", "max_latitude")]
    edges = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(corners)], POINT)
    want = boxes.attach_boxes(edges, boxes.zones_of_grid(grid), "pickup", unmatched="keep")
    assert bag(boxes.attach_grid(edges, grid, "pickup", unmatched="keep")) == bag(want)


def test_hot_point(spark):
    """A third of all trips at one point, by both ways."""
    trips = spark.range(9_000, numPartitions=5).select(
        F.col("id").alias("trip_id"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 9_000).alias("pickup_longitude"),
        F.lit(0.5).alias("pickup_latitude"),
    )
    zones = spark.createDataFrame([(2, "B", 0.4, 0.6, 0.0, 1.0), (3, "C", 0.0, 1.0, 0.0, 1.0)], BOX)
    counts = [
        bag(boxes.attach_boxes(trips, zones, "pickup", **way).groupBy("pickup_zone_id").count())
        for way in WAYS.values()
    ]
    assert counts[0] == counts[1] == counts[2]
    assert sum(n for n, _ in counts[0]) == 9_000


def test_grid(spark, small):
    trips = curate_trips(adapters.trips_raw(spark, small))
    grid = boxes.grid_zones(trips)
    zones = grid.orderBy("zone_id").collect()
    assert [z["zone_id"] for z in zones] == list(range(1, 17)) and zones[3]["zone_name"] == "Zone_4"
    assert zones[0]["max_longitude"] == pytest.approx(zones[1]["min_longitude"])
    assert zones[0]["max_latitude"] == pytest.approx(zones[4]["min_latitude"])
    assert dict(grid.dtypes)["zone_id"] == "int"


def test_grid_defaults_and_zero_bounds(spark):
    bare = boxes.grid_zones(spark.createDataFrame([(1,)], "x int"), 4).collect()
    assert min(z["min_longitude"] for z in bare) == -74.05 and len(bare) == 4
    zero = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0), (3, NAN, NAN)], POINT)
    cells = boxes.grid_zones(zero, 1).collect()
    assert [tuple(c)[2:] for c in cells] == [(0.0, 1.0, 0.0, 1.0)]
    with pytest.raises(ValueError):
        boxes.grid_zones(zero, 0)


LOOKUP = "LocationID,Borough,Zone,service_zone\n1,Manhattan,Alpha,Yellow\n264,Unknown,N/A,N/A\n"
BOXES = "zone_id,zone_name,min_longitude,max_longitude,min_latitude,max_latitude\n1,A,0,1,0,1\n\n"


def test_zone_files(spark, tmp_path):
    (tmp_path / "lookup.csv").write_text(LOOKUP)
    (tmp_path / "boxes.csv").write_text(BOXES)
    names, bounds = str(tmp_path / "lookup.csv"), str(tmp_path / "boxes.csv")
    table = read_zone_lookup(spark, names)
    assert table.dtypes[0] == ("location_id", "int")
    assert [tuple(r) for r in table.collect()] == [
        (1, "Manhattan", "Alpha", "Yellow"),
        (264, "Unknown", "N/A", "N/A"),
    ]
    assert [tuple(r) for r in read_zone_boxes(spark, bounds).collect()] == [(1, "A", 0.0, 1.0, 0.0, 1.0)]

    missing = str(tmp_path / "none.csv")
    assert zone_files(spark, lookup_path=names, boxes_path=bounds).kind == "lookup"
    assert zone_files(spark, lookup_path=missing, boxes_path=bounds).kind == "boxes"
    assert zone_files(spark, lookup_path=missing) is None
    trips = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0)], POINT)
    assert enrich.resolve_zone_source(spark, trips, lookup_path=missing).kind == "grid"


def test_broken_rows_are_set_aside(spark, tmp_path):
    path = str(tmp_path / "lookup.csv")
    (tmp_path / "lookup.csv").write_text(
        'LocationID,Borough,Zone,service_zone\n1,Queens,"A, B",Boro\nx,Queens,C,Boro\n2,Queens\n3,a,b,c,d\n,e,f,g\n4,,,\n'
    )
    good, bad = check_zone_lookup(spark, path)
    assert [tuple(r) for r in good.collect()] == [(1, "Queens", "A, B", "Boro"), (4, None, None, None)]
    assert sorted((r.line, r.reason) for r in bad.collect()) == [
        (",e,f,g", "LocationID is not a whole number"),
        ("2,Queens", "fields do not fit the header"),
        ("3,a,b,c,d", "fields do not fit the header"),
        ("x,Queens,C,Boro", "LocationID is not a whole number"),
    ]
    assert good.count() == 2 and good.select("zone_name").count() == 2 and {r.file for r in bad.collect()} == {path}
    (tmp_path / "boxes.csv").write_text("zone_id,zone_name,min_longitude,max_longitude,min_latitude,max_latitude\n1,A,0,1,0,1\nB,1\n")
    good, bad = check_zone_boxes(spark, str(tmp_path / "boxes.csv"))
    assert (good.count(), bad.count()) == (1, 1)


@pytest.mark.parametrize("text", ["a,b\n1,2\n", "", "\x00\x01\x02 no table", "Zone,Borough\nA,B\n"])
def test_a_lookup_that_does_not_load_leaves_the_ids(spark, tmp_path, text):
    (tmp_path / "lookup.csv").write_text(text)
    (tmp_path / "boxes.csv").write_text(BOXES)
    names = str(tmp_path / "lookup.csv")
    with pytest.raises(ZoneFileError, match="LocationID"):
        read_zone_lookup(spark, names)
    assert zone_files(spark, lookup_path=names) is None
    assert zone_files(spark, lookup_path=names, boxes_path=str(tmp_path / "boxes.csv")).kind == "boxes"
    trips = spark.createDataFrame([(1, 7)], "trip_id bigint, pickup_location_id int")
    row = enrich.enrich_trips(trips, enrich.resolve_zone_source(spark, trips, lookup_path=names)).first()
    assert (row["pickup_zone_id"], row["pickup_zone_name"]) == (7, "Zone_7")


def test_a_lookup_needs_ids_and_names_only(spark, tmp_path):
    (tmp_path / "lookup.csv").write_text("Zone,LocationID\nA,1\n")
    assert [tuple(r) for r in read_zone_lookup(spark, str(tmp_path / "lookup.csv")).collect()] == [(1, None, "A", None)]


def test_each_end_is_decided_on_its_own(spark):
    trips = spark.createDataFrame([(1, 0.5, 0.5, 7)], POINT + ", dropoff_location_id int")
    table = spark.createDataFrame([(1, "A", 0.0, 1.0, 0.0, 1.0)], BOX)
    names = spark.createDataFrame([(7, "b", "Seven", "s")], "location_id int, borough string, zone_name string, service_zone string")
    row = enrich.enrich_trips(trips, ZoneSource("both", lookup=names, boxes=table)).first()
    assert (row["pickup_zone_name"], row["dropoff_zone_name"], row["dropoff_borough"]) == ("A", "Seven", "b")
    row = enrich.enrich_trips(trips, ZoneSource("ids")).first()
    assert (row["pickup_zone_id"], row["dropoff_zone_name"]) == (None, "Zone_7")


def test_repeated_lookup_ids_multiply_no_trip(spark):
    trips = spark.createDataFrame([(1,), (2,)], "pickup_location_id int")
    names = spark.createDataFrame(
        [(1, "b", "Z", "s"), (1, "b", "A", "s"), (2, "b", "B", "s")],
        "location_id int, borough string, zone_name string, service_zone string",
    )
    got = lookup.attach_lookup(trips, names, "pickup").collect()
    assert sorted(r["pickup_zone_name"] for r in got) == ["A", "B"]


def test_unknown_id_keeps_the_trip(spark, small):
    trips = spark.createDataFrame([(99,), (None,), (3,)], "pickup_location_id int")
    got = lookup.attach_lookup(trips, adapters.zone_lookup(spark, small), "pickup")
    assert got.columns == ["pickup_location_id", "pickup_zone_id", "pickup_zone_name", "pickup_borough", "pickup_service_zone"]
    assert {(r["pickup_zone_id"], r["pickup_zone_name"]) for r in got.collect()} == {
        (99, None), (None, None), (3, "NATION_3"),
    }


def test_lookup_beyond_the_broadcast_limit(spark, small):
    """Without a broadcast the same join sorts and merges, with the same result."""
    trips = curate_trips(adapters.trips_raw(spark, small))
    source = ZoneSource("lookup", lookup=adapters.zone_lookup(spark, small))
    want = bag(enrich.enrich_trips(trips, source))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = enrich.enrich_trips(trips, source)
        assert "SortMergeJoin" in plan(merged) and "BroadcastHashJoin" not in plan(merged)
        assert bag(merged) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def put(settings):
        for key, value in settings.items():
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Joins by shuffle, partitions of a few kB count as large.
SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def tasks_stay_even(table):
    """No task of the join has over three times the rows of the median task that has any."""
    tasks = table.withColumn("__task", F.spark_partition_id()).groupBy("__task")
    tasks = tasks.agg(F.count("*").alias("n"), F.max("note"), F.max("pickup_zone_name"))
    counts = sorted(r["n"] for r in tasks.collect())
    assert "skew=true" in tasks._jdf.queryExecution().executedPlan().toString()
    return counts[-1] <= 3 * counts[len(counts) // 2]


def join_sides(table):
    """What stands right below the sorts of a merge join in the plan before execution."""
    text = table._jdf.queryExecution().executedPlan().toString()
    lines = [line.strip(" :+-|*()0123456789") for line in text.splitlines()]
    return [lines[k + 1].split(" ")[0] for k, line in enumerate(lines) if line.startswith("Sort [") and "__" in line]


def test_hot_location_is_split(spark, conf):
    """Half of all trips have one id: both sides of the join are plain shuffles, and no task is overloaded."""
    conf(SHUFFLED)
    trips = spark.range(60_000, numPartitions=12).select(
        F.col("id").alias("trip_id"),
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 997).cast("int").alias("pickup_location_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    names = spark.range(1000).selectExpr(
        "cast(id as int) as location_id", "'b' as borough", "concat('z', id) as zone_name", "'s' as service_zone"
    )
    got = lookup.attach_lookup(trips, names, "pickup")
    assert set(join_sides(got)) == {"Exchange"} and "BroadcastHashJoin" not in plan(got)
    assert tasks_stay_even(got)
    assert got.where("pickup_zone_name = concat('z', pickup_location_id)").count() == 60_000


def test_hot_point_is_split(spark, conf):
    conf(SHUFFLED)
    trips = spark.range(60_000, numPartitions=12).select(
        F.col("id").alias("trip_id"),
        F.when(F.col("id") % 2 == 0, 0.5).otherwise(F.col("id") % 997 / 997).alias("pickup_longitude"),
        F.lit(0.5).alias("pickup_latitude"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )
    zones = spark.createDataFrame([(2, "B", 0.4, 0.6, 0.0, 1.0), (3, "C", 0.0, 1.0, 0.0, 1.0)], BOX)
    got = boxes.join_boxes(trips, zones, "pickup")
    assert tasks_stay_even(got)
    assert bag(got) == bag(boxes.attach_boxes(trips, zones, "pickup"))


def test_few_boxes_move_no_trip(spark, small):
    """An index up to a fixed number of boxes, a join beyond it; no exchange by the index."""
    trips = spark.range(500).selectExpr("id as trip_id", "id % 25 * 1D as pickup_longitude", "id % 7 * 1D as pickup_latitude")
    row = [
        "cast(id + 1 as int) as zone_id", "concat('z', id) as zone_name", "id % 24 - 0.5D as min_longitude",
        "id % 24 + 0.5D as max_longitude", "id % 6 - 0.5D as min_latitude", "id % 6 + 1.5D as max_latitude",
    ]
    for n, indexed in ((20, True), (boxes.MOST_INDEXED, True), (boxes.MOST_INDEXED + 1, False)):
        zones = spark.range(n).selectExpr(*row)
        got = boxes.attach_boxes(trips, zones, "pickup", unmatched="keep")
        assert ("Join" not in plan(got) and "Exchange" not in plan(got)) == indexed
        assert bag(got) == bag(boxes.join_boxes(trips, zones, "pickup", unmatched="keep"))


def test_one_bounds_row_in_a_grid_plan(spark, small):
    trips = curate_trips(adapters.trips_raw(spark, small))
    grid = boxes.attach_grid(trips, boxes.trip_grid(trips), "pickup", unmatched="keep")
    text = grid._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("scalar-subquery") == 1
