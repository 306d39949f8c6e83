"""Trip file scan."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession

from tripflow.operators.columns import conform_types, standardize_columns

NO_SUCH_INPUT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
TYPES_DIFFER = "CANNOT_MERGE_SCHEMAS"
# Spark hands this condition over as a plain Java error.
UNMERGED = (PySparkException, Py4JJavaError)
# Footers that one task reads.
FOOTERS = 64


def scan_trips(spark: SparkSession, path: str) -> DataFrame:
    """Scan all ``*.parquet`` files directly under ``path`` as one table.

    The table has every column that any file has, NULL for the rows of files without it.
    Files that give one column different types are read in groups of like
    files, which are brought to canonical names and types and then put
    together. ``path`` may be on any file system Spark can read. A missing directory or
    one without Parquet files is a ``FileNotFoundError``.
    """
    try:
        return _merged(spark, [path])
    except AnalysisException as error:
        if error.getCondition() in NO_SUCH_INPUT:
            raise FileNotFoundError(f"no trip files in {path}") from error
        raise
    except UNMERGED as error:
        if not _types_differ(error):
            raise
    return scan_files(spark, trip_files(spark, path))


def trip_files(spark: SparkSession, path: str) -> list[str]:
    """The ``*.parquet`` files directly under ``path``, sorted; their content is not read."""
    try:
        listed = spark.read.option("pathGlobFilter", "*.parquet").format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() in NO_SUCH_INPUT:
            raise FileNotFoundError(f"no trip files in {path}") from error
        raise
    return sorted(listed.inputFiles())


def scan_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """These files as one table, by one scan for each group of files that agree on their columns' types."""
    scans = _scans(spark, files)
    if len(scans) == 1:
        return scans[0]
    groups = [standardize_columns(part).transform(conform_types) for part in scans]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), groups)


def _scans(spark: SparkSession, files: list[str]) -> list[DataFrame]:
    try:
        groups = like_files(spark, files)
    except PySparkException:  # a file system that only Spark's readers know
        return _like(spark, files)
    return [_merged(spark, group) for group in groups]


def _merged(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", "true").parquet(*paths)


def _types_differ(error: Exception) -> bool:
    return TYPES_DIFFER in str(error)


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns and types of each file, from its footer."""
    from pyarrow import fs, parquet

    for batch in batches:
        columns = []
        for file in batch.column(0).to_pylist():
            system, path = fs.FileSystem.from_uri(file)
            columns.append(json.dumps([(f.name, str(f.type)) for f in parquet.read_schema(path, filesystem=system)]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns, pa.string())], names=["file", "columns"])


def like_files(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """The files in groups within which every column has one type.

    All footers are read by one job. Files with the same columns and types always share a group; of the different
    schemas, each joins the first group that it does not contradict.
    """
    table = spark.createDataFrame([(file,) for file in files], "file string")
    table = table.repartition(max(1, -(-len(files) // FOOTERS)))
    by_schema: dict[str, list[str]] = {}
    for row in table.mapInArrow(_footers, "file string, columns string").collect():
        by_schema.setdefault(row["columns"], []).append(row["file"])
    groups: list[tuple[dict[str, str], list[str]]] = []
    for schema in sorted(by_schema):
        types = dict(json.loads(schema))
        fitting = (g for g in groups if all(g[0].get(name, kind) == kind for name, kind in types.items()))
        known, members = next(fitting, ({}, []))
        if not members:
            groups.append((known, members))
        known.update(types)
        members += by_schema[schema]
    return [sorted(members) for _, members in groups]


def _like(spark: SparkSession, files: list[str]) -> list[DataFrame]:
    """Tables of neighbouring files whose columns agree: halves are tried until they do."""
    try:
        return [_merged(spark, files)]
    except UNMERGED as error:
        if len(files) == 1 or not _types_differ(error):
            raise
    half = len(files) // 2
    return _like(spark, files[:half]) + _like(spark, files[half:])
