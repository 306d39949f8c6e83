"""From raw documents to packed training windows, in five stages.

Each stage gets all rows that the one before it kept. SQL cannot express the language
models of the first stage, so there is no SQL for the whole; the tests compare each
stage with a plain version on small tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import stage
from tripflow.llm.language_id import identify_languages
from tripflow.llm.line_dedup import dedup_lines
from tripflow.llm.mixing import take_mix
from tripflow.llm.near_dedup import one_of_each_group
from tripflow.llm.packing import pack_documents

#: The near-duplicate stage takes five words and a similarity of 0.8.
SHINGLE_WORDS, PERCENT = 5, 80


def _packed(docs: DataFrame, used: tuple[str, ...]) -> DataFrame:
    """The columns that a stage works on, and all columns as one, out of the way of the stage's own names."""
    return docs.select(*[c for c in used if c in docs.columns], F.struct(*docs.columns).alias("_row"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; rejected ones go."""
    judged = identify_languages(_packed(docs, ("doc_id", "text", "lang")), keep=["_row"])
    return judged.where(~F.col("rejected")).select("_row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the line runs that an earlier document has; none is dropped."""
    changed = ("text", "n_chars")
    others = [c for c in docs.columns if c not in changed]
    packed = docs.select(
        *[c for c in ("doc_id", *changed) if c in docs.columns], F.struct(*others).alias("_row")
    )
    cleaned = dedup_lines(packed)
    return cleaned.select(*[F.col(c) if c in changed else F.col("_row").getField(c).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, also of rows with NULL or repeated ids."""
    return one_of_each_group(docs, size=SHINGLE_WORDS, percent=PERCENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return take_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 1,024 tokens."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
