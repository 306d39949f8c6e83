"""A log of published folders, by which a table changes in one step.

Rows are written to a new folder first, by Spark's own writers. Publishing then adds one small file with one
line to the log, which is what readers go by: until it is there nobody sees the new folder, and a run that is killed
midway leaves the table as it was. One writer at a time publishes to a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

LOG_SCHEMA = "version bigint, run string, mode string, part string, folder string, rows bigint, note string"


@dataclass(frozen=True)
class Published:
    """One line of the log: the folder of a run, which replaces the whole table, one part of it, or adds to it."""

    version: int
    run: str
    mode: str
    part: str | None
    folder: str
    rows: int | None
    note: str | None


class TableLog:
    """The published folders of the table at ``path``, on any storage that Spark reads and writes.

    The log has a line per publication and part, not per file or row, so the driver reads few lines however large the
    table is.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def lines(self) -> list[Published]:
        """All lines, in the order of their publication; none where there is no table."""
        try:
            log = self.spark.read.schema(LOG_SCHEMA).json(f"{self.path}/log")
            return sorted((Published(*row) for row in log.collect()), key=lambda line: (line.version, line.part or ""))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def current(self) -> list[Published]:
        """The lines whose folders make up the table: what replaced it last, and what was added since."""
        held: dict[tuple[str | None, str], Published] = {}
        for line in self.lines():
            if line.mode == "overwrite":
                held = {}
            elif line.mode == "part":
                held = {key: old for key, old in held.items() if key[0] != line.part}
            held[line.part, line.run] = line
        return [line for line in held.values() if line.folder]

    def folder(self, run: str | None = None) -> str:
        """A folder for the rows of a run, the same for the same run."""
        return f"{self.path}/data/{run or uuid.uuid4().hex}"

    def publish(
        self,
        run: str,
        mode: str,
        folders: Mapping[str | None, str],
        rows: int | None = None,
        note: Iterable[str] | None = None,
    ) -> int:
        """Make the folders (by part; None: the table) visible, all at once; the new version's number.

        Without any folder, the line holds the note only.
        """
        folders = folders or {None: ""}
        version = max((line.version for line in self.lines()), default=0) + 1
        noted = None if note is None else json.dumps(sorted(note))
        lines = [(version, run, mode, part, folder, rows, noted if k == 0 else None) for k, (part, folder) in enumerate(folders.items())]
        # One task writes one file, which its commit moves into place.
        self.spark.createDataFrame(lines, LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{self.path}/log")
        return version

    def read(self, schema=None) -> DataFrame | None:
        """The table as it is now, or None where nothing was published."""
        folders = [line.folder for line in self.current()]
        if not folders:
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.option("mergeSchema", str(schema is None).lower()).parquet(*folders)
