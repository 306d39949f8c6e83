"""What several corpus operators share: staging, row identity, word patterns, prefix sums."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
LAST_ID = 2**63 - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where neither that setting nor a checkpoint folder of the context exists, a local
    session gets a temporary folder; on a cluster, whose machines would not share it, that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tripflow-"))
    return context.getCheckpointDir()


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to a new folder in shared storage and read it back.

    Cuts the lineage: whatever executors are lost later, the rows are read again
    from files instead of being computed again.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tripflow/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Spark give this package's source files to the Python workers, once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="tripflow-")) / "tripflow_package.zip"
    with zipfile.ZipFile(target, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def map_in_arrow(frame: DataFrame, function, schema) -> DataFrame:
    """``frame.mapInArrow`` with this package on the workers' path."""
    ship_package(frame.sparkSession)
    return frame.mapInArrow(function, schema)


def column_or_null(frame: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in frame.columns else F.lit(None).cast(kind)


def replace_columns(frame: DataFrame, names: list[str]) -> DataFrame:
    """Without the columns that a result is about to add under the same names."""
    return frame.drop(*[c for c in frame.columns if c.lower() in {n.lower() for n in names}])


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two non-null columns that tell documents apart, ``_dk`` (order by id, null last) and ``_tk``."""
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("_dk"),
        F.xxhash64(F.col(doc_id).isNull(), F.col(text)).alias("_tk"),
    ]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, also below lambdas."""
    return F.transform(F.array(value), body)[0]


def source_key(source: Column) -> Column:
    """A non-null key that keeps NULL apart from every text."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def offsets_before(sums: DataFrame, groups: list[str], order: str, value: str, out: str) -> DataFrame:
    """Adds the sum of ``value`` over the group's rows of smaller ``order``.

    ``sums`` holds one row per group and chunk, and ``order`` counts the chunks from
    0 on: it is summed in two levels, so that no task sorts more than 1,024 chunks of
    a group or the group's blocks of 1,024 chunks.
    """
    blocked = sums.withColumn("_block", F.expr(f"{order} div 1024"))
    inner = Window.partitionBy(*groups, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))).orderBy("_block")
    heads = blocked.groupBy(*groups, "_block").agg(F.sum(value).alias("_sum"))
    heads = heads.withColumn(
        "_head", F.coalesce(F.sum("_sum").over(outer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("_sum")
    within = blocked.withColumn("_within", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return (
        within.join(heads, [*groups, "_block"])
        .withColumn(out, (F.col("_head") + F.col("_within")).cast("long"))
        .drop("_head", "_within", "_block")
    )
