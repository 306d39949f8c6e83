"""Zone definitions: an id lookup, bounding boxes, or a grid made from the trips."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripflow.operators.columns import column

if TYPE_CHECKING:
    from tripflow.operators.boxes import Grid

logger = logging.getLogger(__name__)

LOOKUP_COLUMNS = ("LocationID", "Borough", "Zone", "service_zone")
BOUND_COLUMNS = ("min_longitude", "max_longitude", "min_latitude", "max_latitude")
BOX_COLUMNS = ("zone_id", "zone_name", *BOUND_COLUMNS)
BROKEN = "__broken_row"


class ZoneFileError(ValueError):
    """A zone file whose header lacks a column that cannot be done without."""


def _rows(spark: SparkSession, path: str, needed: tuple[str, ...], optional: tuple[str, ...]) -> DataFrame:
    """The columns of a CSV file by name, as text, and each row's whole text where its fields don't fit the header."""
    header = spark.read.csv(path, header=True).columns
    missing = [c for c in needed if c not in header]
    if missing:
        raise ZoneFileError(f"{path} has no column {', '.join(missing)}")
    fields = [T.StructField(c, T.StringType()) for c in [*header, BROKEN]]
    # Without pruning: fields are counted whichever columns are used.
    reader = spark.read.option("columnPruning", False).option("columnNameOfCorruptRecord", BROKEN)
    rows = reader.csv(path, schema=T.StructType(fields), header=True)
    absent = [F.lit(None).cast("string").alias(c) for c in optional if c not in header]
    return rows.select(*[column(c) for c in header if c in needed + optional], *absent, BROKEN)


def _checked(rows: DataFrame, path: str, key: str, keep: list) -> tuple[DataFrame, DataFrame]:
    """The usable rows with the columns ``keep``, and the others as (file, line, reason)."""
    reason = F.when(F.col(BROKEN).isNotNull(), "fields do not fit the header").when(
        F.col(key).try_cast("int").isNull(), f"{key} is not a whole number"
    )
    judged = rows.withColumn("__reason", reason)
    texts = [F.coalesce(column(c), F.lit("")) for c in rows.columns if c != BROKEN]
    line = F.coalesce(F.col(BROKEN), F.concat_ws(",", *texts))
    bad = judged.where("__reason is not null").select(
        F.lit(path).alias("file"), line.alias("line"), F.col("__reason").alias("reason")
    )
    return judged.where("__reason is null").select(*keep), bad


def check_zone_lookup(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows of an id lookup CSV, and the rows that are set aside with the reason.

    Columns are found by name; without ``LocationID`` and ``Zone`` the file is a ``ZoneFileError``, other
    missing columns are NULL.
    """
    rows = _rows(spark, path, ("LocationID", "Zone"), ("Borough", "service_zone"))
    names = [
        F.col("LocationID").try_cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"),
    ]
    return _checked(rows, path, "LocationID", names)


def check_zone_boxes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a bounding-box CSV, and the rows that are set aside with the reason."""
    rows = _rows(spark, path, BOX_COLUMNS, ())
    bounds = [F.col(c).try_cast("double").alias(c) for c in BOUND_COLUMNS]
    return _checked(rows, path, "zone_id", [F.col("zone_id").try_cast("int").alias("zone_id"), "zone_name", *bounds])


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Read the id lookup CSV: one row per location id, columns found by name, malformed rows left out."""
    return check_zone_lookup(spark, path)[0]


def read_zone_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Read the bounding-box CSV: one row per zone, columns found by name, malformed rows left out."""
    return check_zone_boxes(spark, path)[0]


@dataclass(frozen=True)
class ZoneSource:
    """What zones are attached from.

    ``lookup`` names location ids, ``boxes`` or the zones of ``grid`` contain
    coordinates. Any may be missing: location ids then name themselves,
    coordinates stay unused.
    """

    kind: str
    lookup: DataFrame | None = None
    boxes: DataFrame | None = None
    grid: Grid | None = None


def zone_files(
    spark: SparkSession, *, lookup_path: str | None = None, boxes_path: str | None = None
) -> ZoneSource | None:
    """The lookup file if it is there and has its columns, else the box file, else nothing.

    A file that does not load is reported and passed over, so that location ids then name themselves.
    """
    lookup = _read_if_present(read_zone_lookup, spark, lookup_path)
    if lookup is not None:
        return ZoneSource("lookup", lookup=lookup)
    boxes = _read_if_present(read_zone_boxes, spark, boxes_path)
    return None if boxes is None else ZoneSource("boxes", boxes=boxes)


def _read_if_present(reader, spark: SparkSession, path: str | None) -> DataFrame | None:
    if not path:
        return None
    try:
        return reader(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    except ZoneFileError as error:
        logger.warning("zone file is not used: %s", error)
        return None
