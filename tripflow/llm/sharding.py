"""Two-pass external shuffle into shards.

Pass one scatters records by a seeded hash into buckets that fit in memory; pass two
Fisher-Yates-shuffles every bucket. A bucket's rows follow those of the buckets before
it, and the shuffled whole is cut into shards whose row counts differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StructType

from tripflow.llm.common import column_or_null, offsets_before, replace_columns, stage

SHARDS = 40
BUCKET_BYTES = 6 << 20
SEED = 20


def record_size(docs: DataFrame):
    """UTF-8 bytes of the text (NULL: none) plus 16."""
    text = column_or_null(docs, "text", "string")
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED
) -> DataFrame:
    """Documents with ``size``, ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in a shard).

    The scatter hash takes all plain columns, so that neither a common id nor a group of
    equal texts fills a bucket; only rows equal in every column share one. NULLs are
    hashed like values, the longest text is one record of its bucket, and an empty
    table gives no rows. Input columns with a result's name are replaced. Buckets are
    put in order before they are shuffled: a lost task computes the same rows again.
    """
    names = ["size", "shard", "slot", "_bucket", "_at", "_rows"]
    base = replace_columns(docs, names).withColumn("size", record_size(docs))
    plain = [f.name for f in base.schema.fields if isinstance(f.dataType, AtomicType)]
    scatter = F.xxhash64(F.lit(seed), *[F.col(c) for c in plain])
    total, count = docs.select(record_size(docs).alias("_s")).agg(F.sum("_s"), F.count("*")).first()
    buckets = max(shards, -(-(total or 0) // bucket_bytes))
    records = base.withColumn("_bucket", F.pmod(scatter, F.lit(buckets)))
    rows = records.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    places = stage(offsets_before(rows, [], "_bucket", "_rows", "_at"), "shard-buckets").drop("_rows")

    # Rows are ordered by a second hash, not by their texts, before the seeded shuffle.
    order = F.xxhash64(F.lit(seed + 1), *[F.col(c) for c in plain]).alias("_order")
    gathered = (
        records.withColumn("_record", F.struct(order, F.struct(*base.columns).alias("row")))
        .select("_bucket", "_record")
        .repartition("_bucket")
        .groupBy("_bucket")
        .agg(F.sort_array(F.collect_list("_record")).alias("_records"))
        if all(not _has_map(f.dataType) for f in base.schema.fields)
        else records.withColumn("_record", F.struct(order, F.struct(*base.columns).alias("row")))
        .select("_bucket", "_record")
        .repartition("_bucket")
        .sortWithinPartitions("_bucket", "_record._order")
        .groupBy("_bucket")
        .agg(F.collect_list("_record").alias("_records"))
    )
    shuffled = (
        gathered.join(places, "_bucket")
        .sortWithinPartitions("_bucket")
        .select("_at", F.posexplode(F.shuffle("_records", F.lit(seed))).alias("_slot", "_record"))
        .withColumn("_place", F.col("_at") + F.col("_slot"))
    )
    shard = F.expr(f"_place * {shards} div {max(count, 1)}")
    slot = F.expr(f"_place - (shard * {count} + {shards - 1}) div {shards}")
    return (
        shuffled.withColumn("shard", shard)
        .withColumn("slot", slot)
        .select("_record.row.*", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))
    )


def _has_map(kind) -> bool:
    return "map<" in kind.simpleString()


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; every file of it holds rows in slot order.

    The shuffled buckets are written by the tasks that hold them, each bucket to the one or two shards it lies
    in: rows don't move again, and a shard is written by as many tasks as it has buckets.
    """
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of written shards, with the columns of ``schema`` in its order."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
