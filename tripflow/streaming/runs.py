"""Running a stream over all the input there is."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def is_local(master: str) -> bool:
    """Whether one process is driver and executor."""
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, below ``spark.checkpoint.dir``.

    Where neither the setting nor a checkpoint folder exists, a local session gets a temporary folder; on a
    cluster, whose machines would not share it, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not is_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripflow-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/tripflow/{name}-{uuid.uuid4().hex}"


def file_stream(spark: SparkSession, schema: StructType, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The Parquet files of a folder as a stream, oldest first; every ``files_per_batch`` of them are a batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def drain(stream: DataFrame, scratch: str) -> DataFrame:
    """Run ``stream`` over everything that has arrived; all rows that it ever wrote below ``scratch``.

    A later call with the same ``scratch`` goes on from the checkpoint.
    """
    spark = stream.sparkSession
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{scratch}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{scratch}/written")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{scratch}/written")
