"""Importance resampling: against a plain version, the radix sort against a sort, and odd rows."""

from __future__ import annotations

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tests.llm.plain import lower_az
from tripflow.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string"


def runs_of(text, most):
    words = WORD.findall(lower_az(text or ""))
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, *, buckets=10_000, runs=1, least_words=20, percent=10, seed=2024):
    """[(doc_id, n_features, weight, score, rank)]"""
    found = [[crc32(f.encode()) % buckets for f in runs_of(text, runs)] for _, text in docs]
    s = Counter(b for bs in found for b in bs)
    t = Counter(crc32(f.encode()) % buckets for text in target for f in runs_of(text, runs))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for (doc_id, text), bs in zip(docs, found, strict=True):
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in bs]
        weight = sum(gains) // len(gains) if gains else 0
        name = "" if doc_id is None else doc_id
        h = int(sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((doc_id, len(bs), weight, score, len(runs_of(text, 1)) >= least_words))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(order) * percent // 100
    ranks = {id(r): k + 1 for k, r in enumerate(order[:drawn])}
    return [(*r[:4], ranks.get(id(r))) for r in rows]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def corpus(n, words="alpha beta gamma delta Alpha é日本 x1 fifty-five under_score".split()):
    return [(i, " ".join(words[(i * 7 + k * k) % len(words)] for k in range(i % 60))) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"runs": 3, "buckets": 97}, {"percent": 100, "least_words": 0}])
def test_equals_the_plain_version(spark, options):
    docs, target = corpus(400), ["alpha beta beta", None, "日本 x1 x1 X1"]
    table = spark.createDataFrame(docs, DOCS).repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(table, wanted, **options)
    assert in_order(got.collect()) == in_order(plain(docs, target, **options))


def test_query_equals_the_plain_version(spark, small):
    from tripflow.llm.queries import queries

    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = queries()["op11_importance_resampling"](spark, small).collect()
    assert in_order(got) == in_order(plain(docs, target))
    assert max(r.rank or 0 for r in got) == sum(len(WORD.findall(lower_az(t or ""))) >= 20 for _, t in docs) // 10


def test_null_empty_long_and_repeated_rows(spark):
    long = "many words " * 400_000
    text = "these are twenty words or more " * 4
    docs = [(1, None), (2, ""), (None, text), (None, text), (None, text + "end"), (3, long), (3, long), (-5, text), (2**63 - 1, text), (-(2**63), text), (9, "x" * 2_000_000)]
    table = spark.createDataFrame(docs, DOCS)
    got = resampling.resample(table, table.where("doc_id = -5"), percent=100)
    assert in_order(got.collect()) == in_order(plain(docs, [text], percent=100))
    again = resampling.resample(table.repartition(3), table.where("doc_id = -5"), percent=100)
    assert in_order(again.collect()) == in_order(got.collect())


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame(corpus(60), DOCS)
    assert resampling.resample(none, some).collect() == []
    assert in_order(resampling.resample(some, none).collect()) == in_order(plain(corpus(60), []))
    assert resampling.resample(spark.createDataFrame([("a b",)], "text string"), some).columns == ["n_features", "weight", "score", "rank"]


def test_clashing_and_further_columns(spark):
    docs = corpus(50)
    names = ("score", "rank", "weight", "n_features", "_tie", "_place", "_text", "_gain", "_n_words")
    table = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit("mine") for c in names} | {"digit": F.lit("kept"), "tags": F.array(F.lit("x"))})
    got = resampling.resample(table, table, keep=["doc_id", "digit", "tags", "text"]).collect()
    assert {r.digit for r in got} == {"kept"} and all(r.tags == ["x"] for r in got)
    assert {r.doc_id: r.text for r in got} == dict(docs)
    assert in_order((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in got) == in_order(plain(docs, [t for _, t in docs]))


def test_radix_sort_is_a_sort_and_splits_a_hot_key(spark):
    n = 3000
    rows = spark.range(n, numPartitions=7).select(
        F.monotonically_increasing_id().alias("_place"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**12))).alias("key"),
        F.pmod(F.hash("id"), F.lit(2000)).cast("long").alias("low"),
    )
    rows = resampling.stage(rows, "test-radix")
    placed = resampling.radix_sort(rows, [F.col("low"), F.col("key")], block_bits=6).collect()
    assert sorted(r._place for r in placed) == list(range(n))
    placed.sort(key=lambda r: r._place)
    assert [(r.key, r.low) for r in placed] == sorted((r.key, r.low) for r in placed)


def test_counting_pass_is_stable(spark):
    rows = spark.range(500).select(F.col("id").alias("_place"), F.col("id").alias("was"), (F.col("id") % 4).alias("key"))
    placed = sorted(resampling.counting_pass(rows, F.col("key"), block_bits=5).collect(), key=lambda r: r._place)
    assert [(r.key, r.was) for r in placed] == sorted((r.key, r.was) for r in placed)


def test_digits_cover_all_bits():
    assert len(resampling.digits([(F.lit(1), 64), (F.lit(1), 1), (F.lit(1), 21)])) == 8
    assert len(resampling.digits([(F.lit(1), 0)])) == 1
