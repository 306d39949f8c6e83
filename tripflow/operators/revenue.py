"""Revenue by payment type."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripflow.functions import payment_group, payment_label


def payment_distribution(trips: DataFrame) -> DataFrame:
    """Trips per payment code, most common first."""
    return (
        trips.groupBy("payment_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_first("payment_type"))
    )


def add_payment_name(trips: DataFrame) -> DataFrame:
    return trips.withColumn("payment_type_name", payment_label(F.col("payment_type")))


def revenue_by_payment(trips: DataFrame) -> DataFrame:
    """Trips and revenue per payment code.

    The name follows from the code, so it is added to the groups rather than to
    every trip. A missing code and code 0 share a name but stay two groups.
    """
    by_code = trips.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("fare_amount").alias("total_revenue"),
        F.avg("fare_amount").alias("avg_revenue_per_trip"),
    )
    return order_revenue(by_code)


def order_revenue(by_code: DataFrame) -> DataFrame:
    named = by_code.transform(add_payment_name).select(
        "payment_type", "payment_type_name", "total_trips", "total_revenue", "avg_revenue_per_trip"
    )
    return named.orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_first("payment_type"))


def total_revenue(by_payment: DataFrame) -> DataFrame:
    return by_payment.agg(F.sum("total_revenue").alias("total_revenue"))


def revenue_per_trip(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("fare_amount").alias("total_revenue"),
        F.avg("fare_amount").alias("avg_revenue_per_trip"),
    )


def revenue_split(trips: DataFrame) -> DataFrame:
    """Credit card, cash and all other payments."""
    by_code = trips.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("fare_amount").alias("total_revenue"),
        F.count("fare_amount").alias("__priced"),
    )
    return (
        by_code.groupBy(payment_group(F.col("payment_type")).alias("payment_group"))
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.sum("total_revenue").alias("total_revenue"),
            F.try_divide(F.sum("total_revenue"), F.sum("__priced")).alias("avg_revenue_per_trip"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "payment_group")
    )
