from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import bag
from tripflow.sinks import TableLog, TableStore, export, read_table, save_results, save_table
from tripflow.sources import scan_trips, trips as trip_source


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "a,b", 1.5, dt.datetime(2025, 1, 1)), (2, None, None, None)],
        "k int, s string, d double, t timestamp_ntz",
    ).repartition(2)


def files(path, suffix):
    return sorted(Path(path).glob(f"*.{suffix}"))


def test_csv(spark, table, tmp_path):
    path = str(tmp_path / "out.csv")
    export(table, path, "CSV", single_file=True)
    (written,) = files(path, "csv")
    assert written.read_text().splitlines()[0] == "k,s,d,t"
    back = spark.read.csv(path, header=True, schema="k int, s string, d double, t timestamp_ntz")
    assert bag(back) == bag(table)
    export(table.limit(1), path, "csv")
    assert spark.read.csv(path, header=True).count() == 1


def test_json(table, tmp_path):
    path = str(tmp_path / "out.json")
    export(table, path, "json", single_file=True)
    (written,) = files(path, "json")
    records = sorted(map(json.loads, written.read_text().splitlines()), key=lambda r: r["k"])
    assert records == [
        {"k": 1, "s": "a,b", "d": 1.5, "t": "2025-01-01T00:00:00.000"},
        {"k": 2, "s": None, "d": None, "t": None},
    ]


def test_unknown_format(table, tmp_path):
    with pytest.raises(ValueError, match="xlsx"):
        export(table, str(tmp_path / "x"), "xlsx")
    assert not (tmp_path / "x").exists()


def test_store_modes(spark, table, tmp_path):
    store = TableStore("db", str(tmp_path))
    assert save_table(table, store, "t") == 2
    assert save_table(table, store, "t", "append") == 2
    assert spark.read.parquet(store.path("t")).count() == 4
    assert save_table(table.where("false"), store, "t") == 0
    assert spark.read.parquet(store.path("t")).count() == 0
    with pytest.raises(ValueError):
        save_table(table, store, "t", "merge")


def test_store_without_location_passes_names_to_the_source(spark, table):
    with pytest.raises(Exception, match="no_such_source"):
        save_table(table, TableStore("db", format="no_such_source"), "t")


def test_results_are_independent(table, tmp_path):
    broken = table.selectExpr("assert_true(k < 0) as x")
    status = save_results(
        {"good": table, "none": None, "unmapped": table, "bad": broken, "also": table},
        TableStore("db", str(tmp_path)),
        {"good": "g", "none": "n", "bad": "b", "also": "a"},
    )
    assert status["bad"].startswith("failed: ")
    assert {k: v for k, v in status.items() if k != "bad"} == {
        "good": "saved", "none": "skipped", "unmapped": "skipped", "also": "saved",
    }


def test_scan(spark, table, tmp_path):
    folder = tmp_path / "trip files"
    table.write.parquet(str(folder))
    (folder / "notes.txt").write_text("not a trip")
    assert bag(scan_trips(spark, str(folder))) == bag(table)
    with pytest.raises(FileNotFoundError):
        scan_trips(spark, str(tmp_path / "missing"))
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        scan_trips(spark, str(empty))


def test_scan_of_files_that_differ(spark, tmp_path):
    """Integers in one file and doubles in another, and a column that only some files have."""
    months = ["1L as trip_id, 2 as passenger_count", "2L as trip_id, 3.0D as passenger_count, 7.5D as total_amount"]
    for k, month in enumerate([*months, months[0], "3L as trip_id, cast(null as double) as passenger_count"]):
        spark.range(1).selectExpr(*month.split(", ")).coalesce(1).write.parquet(str(tmp_path / f"m{k}"))
        (part,) = (tmp_path / f"m{k}").glob("*.parquet")
        (tmp_path / "all").mkdir(exist_ok=True)
        (tmp_path / "all" / f"m{k}.parquet").write_bytes(part.read_bytes())
    got = scan_trips(spark, str(tmp_path / "all"))
    assert dict(got.dtypes) == {"trip_id": "bigint", "passenger_count": "int", "fare_amount": "double"}
    assert bag(got.select("trip_id", "passenger_count", "fare_amount")) == sorted(
        [(None, 2, 1), (7.5, 3, 2), (None, 2, 1), (None, None, 3)], key=repr
    )


def test_scan_has_the_columns_of_all_files(spark, tmp_path):
    folder = str(tmp_path / "trips")
    spark.sql("select 1L as trip_id").write.parquet(folder)
    spark.sql("select 2L as trip_id, 'x' as note").write.mode("append").parquet(folder)
    assert bag(scan_trips(spark, folder)) == sorted([(None, 1), ("x", 2)], key=repr)


def one_file(rows, path):
    """One Parquet file called ``path``."""
    scratch = path.parent / f"{path.name}-written"
    rows.coalesce(1).write.parquet(str(scratch))
    (part,) = scratch.glob("*.parquet")
    path.parent.mkdir(exist_ok=True)
    part.rename(path)


KINDS = (
    "1L as trip_id, 2 as passenger_count",
    "2L as trip_id, 3.0D as passenger_count, 7.5D as total_amount",
    "3L as trip_id, '4' as passenger_count",
)


def test_one_scan_for_each_schema(spark, tmp_path):
    """Alternating types: as many scans as schemas, however the files follow each other."""
    for k in range(12):
        rows = spark.range(1).selectExpr(*KINDS[k % 3].split(", "))
        one_file(rows, tmp_path / "all" / f"m{k:02}.parquet")
    got = scan_trips(spark, str(tmp_path / "all"))
    assert str(got._jdf.queryExecution().optimizedPlan()).count("Relation [") == 3
    counts = {(r.trip_id, r.passenger_count, r.fare_amount): r["count"] for r in got.groupBy(*got.columns).count().collect()}
    assert counts == {(1, 2, None): 4, (2, 3, 7.5): 4, (3, 4, None): 4}


def test_schemas_that_agree_share_a_scan(spark, tmp_path):
    kinds = ("1L as a", "2L as a, 'x' as b", "'t' as a", "3 as c", "1.5D as c")
    for k, kind in enumerate(kinds):
        one_file(spark.range(1).selectExpr(*kind.split(", ")), tmp_path / "all" / f"{k}.parquet")
    groups = trip_source.like_files(spark, trip_source.trip_files(spark, str(tmp_path / "all")))
    assert len(groups) == 2 and sorted(len(g) for g in groups) == [2, 3]
    assert scan_trips(spark, str(tmp_path / "all")).count() == 5


def test_scan_where_only_spark_reads(spark, tmp_path, monkeypatch):
    """Without footers from Arrow, halves are tried."""
    for k in range(4):
        one_file(spark.range(1).selectExpr(*KINDS[k % 2].split(", ")), tmp_path / "all" / f"m{k}.parquet")

    def unreadable(*_):
        raise PySparkException("no such file system")

    want = bag(scan_trips(spark, str(tmp_path / "all")))
    monkeypatch.setattr(trip_source, "like_files", unreadable)
    assert bag(scan_trips(spark, str(tmp_path / "all"))) == want


def test_json_array(spark, table, tmp_path):
    path = tmp_path / "deep" / "out.json"
    more = table.unionByName(spark.createDataFrame([(3, 'quote " \n é', -0.5, None)], table.schema)).repartition(5)
    export(more, str(path), "json_array")
    records = json.loads(path.read_text(encoding="utf-8"))
    assert sorted(records, key=lambda r: r["k"]) == [
        {"k": 1, "s": "a,b", "d": 1.5, "t": "2025-01-01T00:00:00.000"},
        {"k": 2, "s": None, "d": None, "t": None},
        {"k": 3, "s": 'quote " \n é', "d": -0.5, "t": None},
    ]
    export(spark.range(1000, numPartitions=7).toDF("a b.c"), str(path), "json_array")
    assert [r["a b.c"] for r in json.loads(path.read_text())] == list(range(1000))
    export(table.where("false"), str(path), "JSON_ARRAY")
    assert json.loads(path.read_text()) == []
    assert [p.name for p in path.parent.iterdir()] == ["out.json"]


def test_failed_json_array_leaves_the_old_one(spark, table, tmp_path):
    path = tmp_path / "out.json"
    export(spark.range(3), f"file://{path}", "json_array")
    with pytest.raises(Exception, match="broken"):
        export(spark.range(9, numPartitions=3).selectExpr("if(id = 8, raise_error('broken'), id) as id"), str(path), "json_array")
    assert json.loads(path.read_text()) == [{"id": k} for k in range(3)]
    assert [p.name for p in tmp_path.iterdir()] == ["out.json"]


@pytest.fixture
def versioned(tmp_path):
    return TableStore("db", str(tmp_path / "store"), versioned=True)


def test_versions(spark, table, versioned):
    assert save_table(table, versioned, "t") == 2
    assert save_table(table, versioned, "t", "append") == 2
    assert read_table(spark, versioned, "t").count() == 4
    assert save_table(table.where("k = 1"), versioned, "t") == 1
    assert bag(read_table(spark, versioned, "t")) == bag(table.where("k = 1"))
    assert save_table(table.where("false"), versioned, "t") == 0
    empty = read_table(spark, versioned, "t")
    assert empty.count() == 0 and empty.columns == table.columns
    with pytest.raises(FileNotFoundError):
        read_table(spark, versioned, "other")
    for options in ({"location": None}, {"location": "x", "format": "orc"}):
        with pytest.raises(ValueError):
            TableStore("db", versioned=True, **options)


def test_a_run_that_dies_leaves_the_old_table(spark, table, versioned, monkeypatch):
    save_table(table, versioned, "t")
    before = read_table(spark, versioned, "t")
    broken = spark.range(100, numPartitions=4).selectExpr("if(id = 99, raise_error('broken'), cast(id as int)) as k")
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="broken"):
            save_table(broken, versioned, "t", mode)
        assert bag(read_table(spark, versioned, "t")) == bag(before) == bag(table)

    def killed(*_, **__):
        raise KeyboardInterrupt

    # All rows are written, but the run ends before it publishes them.
    with monkeypatch.context() as patch:
        patch.setattr(TableLog, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            save_table(table.where("k = 2"), versioned, "t", run="again")
    assert bag(read_table(spark, versioned, "t")) == bag(table)
    assert save_table(table.where("k = 2"), versioned, "t", run="again") == 1
    assert bag(read_table(spark, versioned, "t")) == bag(table.where("k = 2"))
    assert bag(before) == bag(table)  # a reader of the old version keeps it


def test_a_repeated_run_adds_nothing(spark, table, versioned):
    for _ in range(3):
        assert save_table(table, versioned, "t", "append", run="monday") == 2
    assert save_table(table, versioned, "t", "append", run="tuesday") == 2
    assert read_table(spark, versioned, "t").count() == 4
    assert save_results({"x": table}, versioned, {"x": "t"}, run="monday") == {"x": "saved"}
    assert read_table(spark, versioned, "t").count() == 4


def test_parts_are_replaced_on_their_own(spark, tmp_path):
    log = TableLog(spark, str(tmp_path / "parts"))
    assert log.read() is None and log.current() == []

    def put(run, parts):
        for part in parts:
            spark.range(1).select(F.lit(f"{run}-{part}").alias("v")).write.parquet(f"{log.folder(run)}/{part}")
        log.publish(run, "part", {part: f"{log.folder(run)}/{part}" for part in parts})

    put("one", ["a", "b"])
    put("two", ["b", "c"])
    log.publish("three", "part", {}, note=["seen"])
    assert sorted(r.v for r in log.read().collect()) == ["one-a", "two-b", "two-c"]
    assert [line.version for line in log.lines()] == [1, 1, 2, 2, 3]
