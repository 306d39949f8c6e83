"""Result-table store."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tripflow.sinks.manifest import TableLog

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class TableStore:
    """Where result tables go.

    ``format`` is any Spark data source. With ``location``, each table is a
    directory below it; without, the source gets ``database`` and ``collection``
    as options next to ``options``, which is what document-store connectors on
    the class path expect.

    With ``versioned``, a table below ``location`` is Parquet in published versions: every write goes to a
    folder of its own and becomes the table, or a part of it, in one step (``read_table`` reads it).
    Without, the directory itself is the table, and overwriting deletes it first.
    """

    database: str
    location: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    versioned: bool = False

    def __post_init__(self):
        if self.versioned and (self.location is None or self.format != "parquet"):
            raise ValueError("a versioned store needs a location and keeps Parquet")

    def path(self, table: str) -> str | None:
        return f"{self.location.rstrip('/')}/{self.database}/{table}" if self.location else None


def save_table(
    result: DataFrame, store: TableStore, table: str, mode: str = "overwrite", run: str | None = None
) -> int:
    """Write a result table and return how many rows were written.

    The rows are counted by the write itself. ``overwrite`` replaces the table,
    ``append`` adds to it. In a versioned store a run that is killed before its end changes nothing, and a
    ``run`` that is published already is not written again: a repeated call returns its rows.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', not {mode!r}")
    if store.versioned:
        rows = _publish(result, TableLog(result.sparkSession, store.path(table)), mode, run or uuid.uuid4().hex)
    else:
        written, observed = _counted(result)
        writer = observed.write.format(store.format).mode(mode).options(**store.options)
        path = store.path(table)
        if path is None:
            writer.options(database=store.database, collection=table).save()
        else:
            writer.save(path)
        rows = written.get["rows"]
    if rows == 0:
        logger.warning("no rows written to %s", table)
    return rows


def _counted(result: DataFrame) -> tuple[Observation, DataFrame]:
    written = Observation()
    return written, result.observe(written, F.count(F.lit(1)).alias("rows"))


def _publish(result: DataFrame, log: TableLog, mode: str, run: str) -> int:
    done = [line for line in log.lines() if line.run == run]
    if done:
        return done[0].rows
    written, observed = _counted(result)
    # The folder belongs to this run: what a killed attempt left in it is replaced.
    observed.write.mode("overwrite").parquet(log.folder(run))
    rows = written.get["rows"]
    log.publish(run, mode, {None: log.folder(run)}, rows)
    return rows


def read_table(spark: SparkSession, store: TableStore, table: str) -> DataFrame:
    """A stored table; one that was never written is a ``FileNotFoundError``."""
    if not store.versioned:
        return spark.read.format(store.format).options(**store.options).load(store.path(table))
    found = TableLog(spark, store.path(table)).read()
    if found is None:
        raise FileNotFoundError(f"no table {table} in {store.path(table)}")
    return found


def save_results(
    results: Mapping[str, DataFrame | None], store: TableStore, tables: Mapping[str, str], run: str | None = None
) -> dict[str, str]:
    """Write every result that has a table name; return a status per result.

    One failing table does not stop the others. The status is ``saved``,
    ``skipped`` or ``failed: <reason>``.
    """
    status = {}
    for name, result in results.items():
        if result is None or name not in tables:
            status[name] = "skipped"
            continue
        try:
            save_table(result, store, tables[name], run=run)
            status[name] = "saved"
        except Exception as error:  # the caller gets the reason, the other tables get written
            logger.error("failed to save %s: %s", name, error)
            status[name] = f"failed: {error}"
    return status
