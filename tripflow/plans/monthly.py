"""Curated trips kept by month: new files are taken in without reading the months they don't touch.

Trips that are duplicates of each other share their pickup time, so they share a month, and the lowest of the
lowest is the lowest of all. It is therefore enough to keep the unique trips of every month: new trips are
put together with the stored ones of their months, and only those months are written again. Range rules and
derived columns are applied on reading, as they look at one trip at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripflow.constants import LIMITS, TIME_COLUMNS, Limits
from tripflow.functions import wall_clock
from tripflow.operators.cleaning import dedupe_keys, drop_nan_keys, drop_null_keys, first_per_key
from tripflow.plans.preprocess import plausible_trips, standard_trips
from tripflow.sinks.manifest import TableLog
from tripflow.sources.trips import scan_files, trip_files

PART = "__part"
MONTH = "yyyy-MM"
UNREADABLE = "unreadable"


def _part(trips: DataFrame, period: str) -> Column:
    """The period of the pickup as text; an unreadable time has a part of its own."""
    pickup = TIME_COLUMNS[0]
    when = wall_clock(F.col(pickup), trips.schema[pickup].dataType)
    return F.coalesce(F.date_format(when, period), F.lit(UNREADABLE)).alias(PART)


def known_files(log: TableLog) -> set[str]:
    """The names of the trip files that the table was made from."""
    return {name for line in log.lines() if line.note for name in json.loads(line.note)}


def add_files(
    spark: SparkSession, trips_path: str, curated: str, *, period: str = MONTH, run: str | None = None
) -> list[str]:
    """Take the files below ``trips_path`` that are new into the table at ``curated``; the parts that were written.

    The new files are read twice: their pickup times, to learn which months they touch, and then whole. All
    touched months become visible in one step, together with the names of the files; a run that is killed before
    leaves the table as it was and is simply repeated. A file's name stands for its content.
    """
    log = TableLog(spark, curated)
    new = sorted(set(trip_files(spark, trips_path)) - known_files(log))
    if not new:
        return []
    trips = standard_trips(scan_files(spark, new))
    keys = dedupe_keys(trips.columns)
    if keys != list(TIME_COLUMNS):
        raise ValueError(f"trips are kept by month of their pickup time; duplicates are known by {keys}")
    cleaned = trips.transform(drop_null_keys).transform(drop_nan_keys)
    cleaned = cleaned.select("*", _part(cleaned, period))
    parts = sorted(row[0] for row in cleaned.select(PART).distinct().collect())
    stored = [line.folder for line in log.current() if line.part in parts]
    rows = cleaned
    if stored:
        old = spark.read.option("mergeSchema", "true").parquet(*stored)
        rows = rows.unionByName(old.select("*", _part(old, period)), allowMissingColumns=True)
    unique = first_per_key(rows, [PART, *keys])
    run = run or uuid.uuid4().hex
    unique.write.mode("overwrite").partitionBy(PART).parquet(log.folder(run))
    log.publish(run, "part", {part: f"{log.folder(run)}/{PART}={part}" for part in parts}, note=new)
    return parts


def unique_trips(spark: SparkSession, curated: str) -> DataFrame:
    """The unique trips of all months; a table that no file was added to is a ``FileNotFoundError``."""
    found = TableLog(spark, curated).read()
    if found is None:
        raise FileNotFoundError(f"no curated trips in {curated}")
    return found


def curated_months(
    spark: SparkSession, curated: str, limits: Limits = LIMITS, null_duration: str = "drop"
) -> DataFrame:
    """The curated trips of all files that were added: the rows that curating them together gives."""
    return plausible_trips(unique_trips(spark, curated), limits, null_duration)
