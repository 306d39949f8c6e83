"""Several groupings of one table in a single pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def rollup_by(
    table: DataFrame, groupings: Mapping[str, Sequence[str]], *measures: Column
) -> DataFrame:
    """Aggregate by each named grouping, reading the table once.

    Rows carry the name of their grouping in ``grouping``; columns outside that
    grouping are NULL. Spark expands each row once per grouping and aggregates
    before the shuffle, so only groups travel, however rows spread over them.
    """
    columns = list(dict.fromkeys(c for keys in groupings.values() for c in keys))
    name = F.lit(None).cast("string")
    for label, keys in groupings.items():
        # grouping_id has one bit per column, first column highest, 1 = left out
        bits = "".join("0" if c in keys else "1" for c in columns)
        name = F.when(F.col("__set") == int(bits, 2), label).otherwise(name)
    sets = [list(keys) for keys in groupings.values()]
    grouped = table.groupingSets(sets, *columns).agg(F.grouping_id().alias("__set"), *measures)
    return grouped.withColumn("grouping", name).drop("__set")
