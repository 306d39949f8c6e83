"""One JSON array as one file, written by all tasks.

Every task writes its records to a part file, next to the target. On commit the driver appends the parts, between
brackets, to a new file and moves it into place, block by block: it holds no record and no part. A task that fails or
runs twice leaves a part that no commit message names, and an aborted write leaves the target as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

BLOCK_BYTES = 1 << 20


def json_array_source() -> type:
    """The data source; made in a function, so that tasks get it by value and need no package."""
    import uuid
    from dataclasses import dataclass

    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    block_bytes = BLOCK_BYTES

    def opened(path: str):
        """The file system of a path and the path in it; plain paths are local or shared folders."""
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    @dataclass
    class Part(WriterCommitMessage):
        path: str
        records: int

    class Writer(DataSourceWriter):
        def __init__(self, options):
            self.target = options["path"].rstrip("/")
            self.parts = f"{self.target}.parts-{uuid.uuid4().hex}"

        def write(self, rows) -> Part:
            system, folder = opened(self.parts)
            system.create_dir(folder, recursive=True)
            path, records = f"{self.parts}/{uuid.uuid4().hex}", 0
            with system.open_output_stream(opened(path)[1]) as out:
                for row in rows:
                    out.write((",\n" if records else "").encode() + row[0].encode())
                    records += 1
            return Part(path, records)

        def commit(self, messages) -> None:
            system, target = opened(self.target)
            whole = opened(f"{self.parts}/whole")[1]
            system.create_dir(opened(self.parts)[1], recursive=True)
            with system.open_output_stream(whole) as out:
                out.write(b"[")
                between = b"\n"
                for part in messages:
                    if part is None or not part.records:
                        continue
                    out.write(between)
                    between = b",\n"
                    with system.open_input_stream(opened(part.path)[1]) as records:
                        while block := records.read(block_bytes):
                            out.write(block)
                out.write(b"\n]\n")
            system.move(whole, target)
            system.delete_dir(opened(self.parts)[1])

        def abort(self, messages) -> None:
            from pyarrow import fs

            system, folder = opened(self.parts)
            if system.get_file_info(folder).type == fs.FileType.Directory:
                system.delete_dir(folder)

    class JsonArray(DataSource):
        @classmethod
        def name(cls) -> str:
            return "json_array"

        def schema(self) -> str:
            return "record string"

        def writer(self, schema, overwrite):
            return Writer(self.options)

    return JsonArray


def write_json_array(records: DataFrame, path: str) -> None:
    """Write the one column of ``records``, JSON texts, as an array to file ``path``, replacing it.

    The order is that of the partitions. ``path`` is a file on storage that all executors share: a plain path or an
    address that Arrow's file systems open.
    """
    spark = records.sparkSession
    spark.dataSource.register(json_array_source())
    records.write.format("json_array").mode("append").save(path)
