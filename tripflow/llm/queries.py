"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import column_or_null, shared_dir
from tripflow.llm.fingerprints import compare_with_edits
from tripflow.llm.identifiers import find_identifiers
from tripflow.llm.language_id import identify_languages
from tripflow.llm.line_dedup import dedup_lines
from tripflow.llm.mixing import mix_sources
from tripflow.llm.near_dedup import mark_near_duplicates
from tripflow.llm.oracle import ORACLES
from tripflow.llm.packing import pack_documents
from tripflow.llm.quality_rules import apply_rules
from tripflow.llm.resampling import resample
from tripflow.llm.sharding import read_shards, record_size, shard_documents, write_shards
from tripflow.llm.suffix_dedup import remove_repeats
from tripflow.llm.warc import archive_path, read_archive, write_archive
from tripflow.llm.whitening import whiten


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_deleted", "text")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as read back, with a digest of each whole rebuilt record."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archive = write_archive(pages, archive_path(spark, f"warc-{uuid.uuid4().hex}"))
    records = read_archive(spark, archive)
    return records.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        F.sha2("record", 256).alias("record_sha256"),
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"))
    return marked.select("doc_id", "n_shingles", "component_id", "kept")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(_documents(spark, sf_dir).select("doc_id", "text"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_languages(_documents(spark, sf_dir).select("doc_id", "text", "lang"), keep=["doc_id"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_rules(_documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir).select("doc_id", "text"), with_text=False)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards are written, and everything but the law is derived from the files that are read back."""
    sharded = shard_documents(_documents(spark, sf_dir).select("doc_id", "text"))
    path = f"{shared_dir(spark).rstrip('/')}/tripflow/shards-{uuid.uuid4().hex}"
    write_shards(sharded, path)
    written = read_shards(spark, path, sharded.schema)
    return written.select(
        "doc_id",
        record_size(written).alias("size"),
        F.crc32(F.coalesce(column_or_null(written, "text", "string"), F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir).select("doc_id", "text", "source"), with_ids=False)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    drawn = resample(_documents(spark, sf_dir).select("doc_id", "text"), target)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_identifiers(_documents(spark, sf_dir).select("doc_id", "text"), keep=["doc_id"], redact=False)
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_disguised")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return whiten(vectors, keep=["vec_id"])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_mixing": op2_mixing,
    "op3_warc": op3_warc,
    "op4_near_dedup": op4_near_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_language_id": op6_language_id,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_sharding": op9_sharding,
    "op10_packing": op10_packing,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_pii": op12_pii,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
