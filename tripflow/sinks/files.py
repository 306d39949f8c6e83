"""CSV and JSON exports for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripflow.sinks.json_array import write_json_array

FORMATS = ("csv", "json", "json_array")
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS"
JSON_OPTIONS = {"timestampFormat": ISO_TIME, "timestampNTZFormat": ISO_TIME, "ignoreNullFields": "false"}


def export(table: DataFrame, path: str, format: str = "csv", *, single_file: bool = False) -> None:
    """Write a table to directory ``path`` as CSV with a header or as JSON lines, or to file ``path`` as a JSON array.

    ``single_file`` writes one part file through one task. Use it only for
    results of a known small size, such as the hours of a day. A JSON array is one file in any
    case, written by all tasks in parts that are joined on commit.
    """
    kind = format.lower()
    if kind not in FORMATS:
        raise ValueError(f"unsupported format: {format}")
    if single_file:
        table = table.coalesce(1)
    if kind == "csv":
        table.write.mode("overwrite").csv(path, header=True)
    elif kind == "json":
        table.write.mode("overwrite").options(**JSON_OPTIONS).json(path)
    else:
        records = F.to_json(F.struct([F.col(f"`{c.replace('`', '``')}`") for c in table.columns]), JSON_OPTIONS)
        write_json_array(table.select(records.alias("record")), path)
