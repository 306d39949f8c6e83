"""Trip-shaped views of the test tables.

The test data has no taxi trips, so trips are computed from its tables: every
row of the table becomes one or more trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WEST_EDGE, SOUTH_EDGE = -74.25, 40.50


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds(n: Column) -> Column:
    return F.expr("interval '1' second") * n


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _coordinate(origin: float, factor: int, span: int) -> Column:
    steps = (F.col("event_id") * factor % span).cast("double")
    return F.lit(origin) + steps / F.lit(1000.0)


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips from ``events``, with source column names and defects of every kind.

    Every event is a trip. Some events also yield an exact copy or a copy with
    another fare and distance; some have missing, NaN or implausible values.
    """
    event = F.col("event_id")
    copies = F.array_compact(
        F.array(F.lit("first"), F.when(_every(50), "exact"), F.when(_every(53), "near"))
    )
    value = F.col("value") + F.when(F.col("copy") == "near", 7.0).otherwise(0.0)
    start = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    return (
        _table(spark, sf_dir, "events")
        .select("event_id", "ts", "user_id", "value", F.explode(copies).alias("copy"))
        .select(
            event.alias("trip_id"),
            F.when(~_every(97), start).alias("tpep_pickup_datetime"),
            F.when(~_every(103), start + _seconds(event * 7919 % 12000)).alias(
                "tpep_dropoff_datetime"
            ),
            F.when(_every(101), F.lit(float("nan")))
            .when(_every(211), 500.0)
            .when(_every(227), 0.0)
            .otherwise(value / 10)
            .alias("trip_distance"),
            F.when(_every(223), 1500.0).otherwise(value * 1.5 - 5).alias("fare_amount"),
            F.when(~_every(89), event % 8).cast("int").alias("payment_type"),
            (F.col("user_id") % 30).cast("int").alias("PULocationID"),
            ((F.col("user_id") * 7 + event) % 30).cast("int").alias("DOLocationID"),
            _coordinate(WEST_EDGE, 31, 500).alias("pickup_longitude"),
            _coordinate(SOUTH_EDGE, 17, 450).alias("pickup_latitude"),
            _coordinate(WEST_EDGE, 37, 500).alias("dropoff_longitude"),
            _coordinate(SOUTH_EDGE, 23, 450).alias("dropoff_latitude"),
            (1 + event % 5).cast("int").alias("passenger_count"),
        )
    )


def trips_text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips with times as text, some of it unreadable."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    trip = F.col("trip_id")
    return trips_raw(spark, sf_dir).withColumns(
        {
            "tpep_pickup_datetime": F.when(trip % 41 == 0, "n/a").otherwise(pickup.cast("string")),
            "tpep_dropoff_datetime": F.when(
                trip % 43 == 0, F.concat(dropoff.cast("string"), F.lit(".5"))
            ).otherwise(dropoff.cast("string")),
        }
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup from ``nation`` and ``region``."""
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone_name"),
        F.concat(F.lit("Zone "), (F.col("n_nationkey") % 3).cast("string")).alias("service_zone"),
    )


def _boxes(table: DataFrame, key: Column, name: Column, place, width: int, height: int) -> DataFrame:
    west, south = place

    def thousandths(steps: Column) -> Column:
        return steps.cast("double") / F.lit(1000.0)

    return table.select(
        (key + 1).cast("int").alias("zone_id"),
        name.alias("zone_name"),
        thousandths(west).alias("min_longitude"),
        thousandths(west + width).alias("max_longitude"),
        thousandths(south).alias("min_latitude"),
        thousandths(south + height).alias("max_latitude"),
    )


def zone_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One box per ``nation``: neighbours overlap east to west, with gaps between rows."""
    key = F.col("n_nationkey")
    place = (-74250 + key % 5 * 100, 40500 + F.floor(key / 5) * 90)
    return _boxes(_table(spark, sf_dir, "nation"), key, F.col("n_name"), place, 120, 70)


def many_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small box per ``customer``, with many overlaps."""
    key = F.col("c_custkey")
    place = (-74250 + key * 7919 % 500, 40500 + key * 104729 % 450)
    return _boxes(_table(spark, sf_dir, "customer"), key, F.col("c_name"), place, 9, 6)


def _volume_coordinate(edge: float, number: Column, steps: int) -> Column:
    return F.lit(edge) + (number % steps).cast("double") / F.lit(1000.0)


def trips_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips from ``lineitem`` with the zones of its supplier and customer.

    Only foreign-key joins: Spark broadcasts the smaller tables while they fit
    its threshold.
    """
    line, order = F.col("l_orderkey"), F.col("l_linenumber")
    start = F.col("l_shipdate") + _seconds((line * 7919 + order * 104729) % 86400)
    return (
        _table(spark, sf_dir, "lineitem")
        .join(_table(spark, sf_dir, "orders"), line == F.col("o_orderkey"))
        .join(_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            (line * 10 + order).alias("trip_id"),
            start.alias("tpep_pickup_datetime"),
            (start + _seconds((line * 31 + order * 977) % 12000)).alias("tpep_dropoff_datetime"),
            F.col("l_quantity").alias("trip_distance"),
            (F.col("l_extendedprice") / 100).alias("fare_amount"),
            ((line + order) % 8).cast("int").alias("payment_type"),
            F.col("s_nationkey").alias("PULocationID"),
            F.col("c_nationkey").alias("DOLocationID"),
            _volume_coordinate(WEST_EDGE, line * 31 + order * 7, 500).alias("pickup_longitude"),
            _volume_coordinate(SOUTH_EDGE, line * 17 + order * 3, 450).alias("pickup_latitude"),
        )
    )


def trips_total_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips with a total amount in place of the fare."""
    return trips_raw(spark, sf_dir).withColumnRenamed("fare_amount", "total_amount")


ARRIVAL_DAYS = 5
LATE_EVERY, LATE_DAYS = 61, 12


def with_arrival(trips: DataFrame, late: bool = False) -> DataFrame:
    """Add ``arrival_batch``: trips arrive up to 110 minutes after their pickup, and batches hold five days.

    Copies of a trip may arrive in any order and in different batches. With ``late``, every 61st trip
    arrives twelve days later still.
    """
    trip, fare = F.col("trip_id"), F.coalesce(F.floor("fare_amount"), F.lit(0))
    delay = F.abs(trip * 7919 + fare * 131) % 6600
    if late:
        delay = delay + F.when(trip % LATE_EVERY == 0, LATE_DAYS * 86400).otherwise(0)
    day = F.date_diff((F.col("pickup_datetime") + _seconds(delay)).cast("date"), F.lit("1970-01-01").cast("date"))
    return trips.withColumn("arrival_batch", F.floor(day / ARRIVAL_DAYS).cast("int"))


def land(arriving: DataFrame, folder: str, batches: list[int]) -> None:
    """Write these arrival batches to ``folder``, one file after the other."""
    for batch in batches:
        rows = arriving.where(F.col("arrival_batch") == batch).drop("arrival_batch")
        rows.coalesce(1).write.mode("append").parquet(folder)


def arrival_batches(arriving: DataFrame) -> list[int]:
    """The numbers of the batches: a few, as many as the trips' days are times five."""
    return sorted(row[0] for row in arriving.select("arrival_batch").distinct().collect())
