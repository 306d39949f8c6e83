"""Zone names on a trip stream, from a lookup that may change while the stream runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tripflow.operators.lookup import attach_lookup
from tripflow.sinks.manifest import TableLog

BATCH = "batch"


def start_zone_stream(
    trips: DataFrame, lookup: TableLog, out: str, checkpoint: str, *, ends: tuple[str, ...] = ("pickup",)
) -> StreamingQuery:
    """Write the stream's trips with the zone names that are published when their batch runs.

    The static side of a stream-static join is fixed when the stream starts. Here every batch reads the
    current version of ``lookup``, so a version published between two batches counts from the second
    on. Each batch overwrites its own folder: a batch that runs again after a failure writes no trip twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        names = lookup.read()
        if names is None:
            raise FileNotFoundError(f"no lookup in {lookup.path}")
        for end in ends:
            batch = attach_lookup(batch, names, end)
        batch.write.mode("overwrite").parquet(f"{out}/{BATCH}={number}")

    return (
        trips.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
