"""Importance resampling towards a target corpus, ranked by a distributed radix sort.

Words are hashed to buckets. How much more often the target has a bucket than the corpus
becomes the bucket's gain, held in one array; a document's weight is the mean gain
of its features, read from that array. Seeded Gumbel noise turns the weights into scores
whose highest are a draw without replacement.

The ranks come from a least-significant-digit radix sort over (score, id): every pass counts digits
per block of places, adds the counts up to global offsets, and sends each record to
offset + rank among the block's records of its digit. Blocks bound every group, so a key that many
records share is spread over as many tasks as it fills blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, LongType, StructField, StructType
from pyspark.sql.window import Window

from tripflow.llm.bytestext import utf8
from tripflow.llm.common import column_or_null, map_in_arrow, offsets_before, replace_columns, stage

BUCKETS = 10_000
RUNS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

#: Bits of a digit, and of the places that one block holds.
DIGIT_BITS, BLOCK_BITS = 12, 17
#: Scores stay far below this: a gain is a thousand natural logarithms of a ratio of counts.
SCORE_LIMIT = 1 << 20

#: Bytes of a text that are cut into words at once, and words whose buckets are remembered.
_PIECE, _REMEMBERED = 1 << 20, 1 << 18
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size; a word is never cut."""
    start = 0
    while start < len(data):
        gap = _BETWEEN.search(data, start + _PIECE)
        stop = gap.start() if gap else len(data)
        yield data[start:stop].translate(_WORD_BYTES).split()
        start = stop


def features(data: bytes, runs: int = RUNS) -> Iterator[list[bytes]]:
    """All runs of 1 to ``runs`` words, joined by a space, repeats included."""
    held: list[bytes] = []
    for words in _words(data):
        yield words
        if runs > 1:
            line = held + words
            for size in range(2, runs + 1):
                first = max(0, len(held) - size + 1)
                yield [b" ".join(line[i : i + size]) for i in range(first, len(line) - size + 1)]
            held = line[1 - runs :]


class _Buckets(dict):
    """The bucket of a feature; short ones are remembered up to a fixed number."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = crc32(feature) % self.buckets
        if len(feature) <= 32 and len(self) < _REMEMBERED:
            self[feature] = bucket
        return bucket

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    data, starts = utf8(batch.column(name))
    for start, stop in pairwise(starts):
        yield data[start:stop].tobytes()


def _count(batches: Iterator[pa.RecordBatch], buckets: int, runs: int) -> Iterator[pa.RecordBatch]:
    """How often each bucket occurs in a task's texts."""
    totals, known = np.zeros(buckets, np.int64), _Buckets(buckets)
    waiting, size = [], 0
    for batch in batches:
        for text in _texts(batch, "_text"):
            for found in features(text, runs):
                waiting.append(known.of(found))
                size += len(found)
                if size > _REMEMBERED:
                    totals += np.bincount(np.concatenate(waiting), minlength=buckets)
                    waiting, size = [], 0
    if waiting:
        totals += np.bincount(np.concatenate(waiting), minlength=buckets)
    there = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(totals[there])], names=["bucket", "n"])


def bucket_counts(docs: DataFrame, buckets: int, runs: int) -> DataFrame:
    """(bucket, n): how often the features of all texts fall into each bucket; absent ones are left out."""
    texts = docs.select(column_or_null(docs, "text", "string").alias("_text"))
    counted = map_in_arrow(texts, partial(_count, buckets=buckets, runs=runs), "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, runs: int = RUNS) -> np.ndarray:
    """The gain of every bucket: one array of ``buckets`` longs, however large the corpus is."""
    counts = {}
    for name, table in (("s", docs), ("t", target)):
        counted = np.zeros(buckets)
        for row in bucket_counts(table, buckets, runs).collect():  # at most one row a bucket
            counted[row.bucket] = row.n
        counts[name] = counted
    s, t = counts["s"], counts["t"]
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], gains: np.ndarray, runs: int) -> Iterator[pa.RecordBatch]:
    """Words, features and the sum of their gains, next to the columns before the text."""
    known = _Buckets(len(gains))
    for batch in batches:
        measures = []
        for text in _texts(batch, "_text"):
            words = found = gain = 0
            for k, some in enumerate(features(text, runs)):
                words += len(some) if k % runs == 0 else 0
                found += len(some)
                gain += int(gains[known.of(some)].sum())
            measures.append((words, found, gain))
        columns = np.array(measures, np.int64).reshape(-1, 3).T
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *[pa.array(c) for c in columns]],
            names=[*batch.schema.names[:-1], "_n_words", "n_features", "_gain"],
        )


def weigh_documents(docs: DataFrame, gains: np.ndarray, runs: int, seed: int, keep: list[str]) -> DataFrame:
    """``keep``, ``n_features``, ``weight``, ``score`` and the columns that the sort needs, one row a document."""
    plain = [F.col(c) for c in keep if isinstance(docs.schema[c].dataType, AtomicType)]
    text = column_or_null(docs, "text", "string")
    sent = docs.select(*keep, F.xxhash64(text, *plain).alias("_tie"), text.alias("_text"))
    measured = [StructField(c, LongType()) for c in ("_n_words", "n_features", "_gain")]
    schema = StructType([*sent.schema.fields[:-1], *measured])
    weighed = map_in_arrow(sent, partial(_weigh, gains=gains, runs=runs), schema)

    weight = F.expr("(_gain - pmod(_gain, greatest(n_features, 1))) div greatest(n_features, 1)")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(column_or_null(weighed, "doc_id", "string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return weighed.withColumn("weight", weight).withColumn("score", F.col("weight") + noise).drop("_gain")


def digits(parts: list[tuple[Column, int]], most: int = DIGIT_BITS) -> list[Column]:
    """The digits, least significant first, of the number whose bits ``parts`` (value, bits) line up, lowest first."""
    total = sum(bits for _, bits in parts)
    count = max(1, -(-total // most))
    cut = []
    for low, high in pairwise(total * k // count for k in range(count + 1)):
        digit, at = F.lit(0).cast("long"), 0
        for value, bits in parts:
            first, last = max(low, at), min(high, at + bits)
            if first < last:
                piece = F.shiftrightunsigned(value, first - at).bitwiseAND(F.lit((1 << (last - first)) - 1))
                digit = digit + F.shiftleft(piece, first - low)
            at += bits
        cut.append(digit)
    return cut


def counting_pass(records: DataFrame, digit: Column, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``records`` with the ``_place`` that a stable counting sort by ``digit`` gives them, gapless from 0."""
    here = records.withColumn("_digit", digit).withColumn("_span", F.shiftright("_place", block_bits))
    counts = here.groupBy("_digit", "_span").agg(F.count("*").alias("_n"))
    counts = stage(counts, "radix-counts")
    smaller = Window.partitionBy(F.lit(0)).orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    by_digit = counts.groupBy("_digit").agg(F.sum("_n").alias("_all"))  # at most 2 ** DIGIT_BITS rows
    by_digit = by_digit.select("_digit", F.coalesce(F.sum("_all").over(smaller), F.lit(0)).alias("_from"))
    offsets = offsets_before(counts, ["_digit"], "_span", "_n", "_in").join(F.broadcast(by_digit), "_digit")
    offsets = offsets.select("_digit", "_span", (F.col("_from") + F.col("_in")).alias("_offset"))
    among = Window.partitionBy("_digit", "_span").orderBy("_place")
    ranked = here.withColumn("_rank", F.row_number().over(among) - 1)
    placed = ranked.join(offsets, ["_digit", "_span"])
    return placed.withColumn("_place", F.col("_offset") + F.col("_rank")).select(*records.columns)


def radix_sort(records: DataFrame, parts: list[Column], block_bits: int = BLOCK_BITS) -> DataFrame:
    """``records`` (with any distinct ``_place``) with their place, from 0 on, in the order of ``parts``.

    ``parts`` are longs taken as unsigned, the least significant first. Bits that are the same in all
    records are not sorted by. The records are written after every pass but the last.
    """
    named = {f"_part{k}": part for k, part in enumerate(parts)}
    ranges = [f(c).alias(f"{c}_{f.__name__}") for c in named for f in (F.bit_or, F.bit_and)]
    spread = records.select(*[part.alias(c) for c, part in named.items()]).agg(*ranges).first()
    widths = []
    for c in named:
        some, every = spread[f"{c}_bit_or"], spread[f"{c}_bit_and"]
        widths.append(0 if some is None else ((some ^ every) % 2**64).bit_length())
    passes = digits(list(zip(parts, widths, strict=True)))
    for k, digit in enumerate(passes):
        records = counting_pass(records, digit, block_bits)
        if k + 1 < len(passes):
            records = stage(records, "radix-pass")
    return records


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    buckets: int = BUCKETS,
    runs: int = RUNS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (default: the id) of all documents with n_features, weight, score and rank.

    ``rank`` counts the drawn documents from 1 on, highest score first; it is NULL for all others.
    Of the documents with at least ``least_words`` words, ``percent`` in a hundred are drawn.
    What is kept moves through every pass of the sort, so keep the text only where it is needed.

    A NULL or empty text has no feature and weight 0. A NULL id is hashed as an empty one and comes after all
    others on ties. Rows of one id and score are ordered by a hash of their text and kept columns; rows equal in these
    take ranks in any order. Texts of any length are cut into words piece by piece. Empty tables give no rows,
    an empty target leaves the corpus's own frequencies. Input columns with a result's name are replaced.
    """
    docs = replace_columns(docs, [c for c in ("n_features", "weight", "score", "rank", "_tie", "_text", "_n_words", "_place", "_gain")])
    if keep is None:
        keep = [c for c in ("doc_id",) if c in docs.columns]
    keep = [c for c in keep if c in docs.columns]
    gains = bucket_gains(docs, target, buckets, runs)
    weighed = weigh_documents(docs, gains, runs, seed, keep)
    weighed = stage(weighed.withColumn("_place", F.monotonically_increasing_id()), "resample-scores")

    eligible = F.col("_n_words") >= least_words
    records = weighed.where(eligible)
    doc_id = column_or_null(records, "doc_id", "long")
    # The sign bit flipped, the order of longs is that of their unsigned bits.
    unsigned = F.coalesce(doc_id, F.lit(0)).bitwiseXOR(F.lit(-(2**63)))
    parts = [unsigned, doc_id.isNull().cast("long"), F.lit(SCORE_LIMIT) - F.col("score")]
    total = records.count()
    again = records.groupBy("score", doc_id.alias("_id")).count().where("count > 1")
    if not again.isEmpty():
        parts = [F.col("_tie"), *parts]
    drawn = total * percent // 100
    ranked = radix_sort(records, parts).withColumn("rank", F.when(F.col("_place") < drawn, F.col("_place") + 1))
    rest = weighed.where(~eligible).withColumn("rank", F.lit(None).cast("long"))
    shown = [*keep, "n_features", "weight", "score", "rank"]
    return ranked.select(*shown).unionByName(rest.select(*shown))
