"""Writers of result tables. All of them write from the executors."""

from tripflow.sinks.files import FORMATS, export
from tripflow.sinks.manifest import TableLog
from tripflow.sinks.tables import TableStore, read_table, save_results, save_table

__all__ = ["FORMATS", "TableLog", "TableStore", "export", "read_table", "save_results", "save_table"]
