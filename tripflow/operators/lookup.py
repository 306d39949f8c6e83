"""Zones from location ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripflow.operators.columns import column

LOOKUP_FIELDS = {"zone_name": "zone_name", "borough": "borough", "service_zone": "service_zone"}


def attach_lookup(trips: DataFrame, lookup: DataFrame, end: str) -> DataFrame:
    """Left join the lookup on the pickup or dropoff location id.

    Trips with an unknown id keep their id as zone id and get NULL names. No
    broadcast is forced: Spark broadcasts the lookup while its measured size is
    under the broadcast threshold and otherwise sorts and merges. The join key is the
    complement of the id on both sides, so the unique lookup is dealt out by a shuffle of its own:
    between two plain shuffles, adaptive execution can split an overloaded
    location id, which it cannot while one side is an aggregate on the join key.
    Of lookup rows with one id only the lowest counts, NULLs lowest, so that no trip is multiplied.
    """
    key = F.col(f"{end}_location_id")
    names = F.min(F.struct(*LOOKUP_FIELDS)).alias("__names")
    unique = lookup.groupBy("location_id").agg(names).select(
        F.bitwise_not(F.col("location_id").cast("bigint")).alias("__id"),
        *[F.col(f"__names.{c}").alias(f"{end}_{label}") for c, label in LOOKUP_FIELDS.items()],
    )
    return trips.join(unique, F.bitwise_not(key.cast("bigint")) == F.col("__id"), "left").select(
        *[column(c) for c in trips.columns],
        key.alias(f"{end}_zone_id"),
        *[f"{end}_{label}" for label in LOOKUP_FIELDS.values()],
    )


def attach_location_names(trips: DataFrame, end: str) -> DataFrame:
    """Without a lookup: the location id is the zone id and names the zone."""
    key = F.col(f"{end}_location_id")
    return trips.withColumns(
        {
            f"{end}_zone_id": key,
            f"{end}_zone_name": F.concat(F.lit("Zone_"), key.cast("string")),
        }
    )


def attach_nothing(trips: DataFrame, end: str) -> DataFrame:
    """Trips without ids or coordinates get NULL zones."""
    return trips.withColumns(
        {
            f"{end}_zone_id": F.lit(None).cast("int"),
            f"{end}_zone_name": F.lit(None).cast("string"),
        }
    )
