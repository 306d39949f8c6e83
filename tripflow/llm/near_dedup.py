"""MinHash near-dedup with odd sketches.

A text's MinHash samples make band keys, which find candidates, and are folded into a
256-bit parity bitmap (odd sketch): each sample flips one bit. The share of bits in which
two bitmaps differ estimates a high similarity closely. A second odd sketch folds in
the whole set: it differs in at most as many bits as the sets have items that
are not common, so it rules a pair out for certain. Most wrong candidates fall by these before
texts are compared; the rest is confirmed on the full sets.

Candidates of one band key are never paired with each other. Every one is compared with one member of its
bucket: first with the smallest, then, where a bucket still holds several components, with the
one that shares most buckets with others, which is the original where a bucket holds its copies. Members
of buckets that are still mixed then meet by prefix filtering: similar sets share one of their rarest shingles,
at places that leave room for the common part. Keys that the same members share count once. Only pairs of different
components that the places and both sketches allow are looked at. This loses no link, whatever counts as rare.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import blake2b
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tripflow.llm.bytestext import U64, mix, shingles, utf8, word_hashes
from tripflow.llm.common import column_or_null, map_in_arrow, replace_columns, row_key, stage
from tripflow.llm.components import connected_components

SHINGLE_WORDS = 4
PERCENT = 80
#: 32 keys of 4 samples: a pair at a similarity of 0.8 shares none with probability 5e-8.
BANDS, ROWS = 32, 4
SKETCH_BITS = 256
WHOLE_BITS = 512
#: Bitmaps of a pair at 0.8 differ in 42 bits, give or take 8; beyond this many (0.55) it is no candidate.
MOST_BITS = 80
#: Cells of the histogram that tells how rare a shingle is.
RARITY_CELLS = 1 << 20

_SAMPLES = BANDS * ROWS
_random = np.random.default_rng(4)
_FACTORS = (_random.integers(0, 2**31, _SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_TERMS = _random.integers(0, 2**32, _SAMPLES, dtype=np.uint32)[:, None]

_SAMPLED = [f"s{k}" for k in range(SKETCH_BITS // 64)]
_WHOLE = [f"t{k}" for k in range(WHOLE_BITS // 64)]
_SKETCH = [*_SAMPLED, *_WHOLE, "n_shingles"]
_SIGNED = "_dk long, _tk long, n_shingles long, digest binary, bands array<long>" + "".join(
    f", {c} long" for c in (*_SAMPLED, *_WHOLE)
)


def min_samples(items: np.ndarray) -> np.ndarray:
    """One smallest value for each of the hash functions; blocks of items fit in cache."""
    low = (items >> U64(32)).astype(np.uint32)
    best = np.full(_SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 512):
        np.minimum(best, (low[at : at + 512] * _FACTORS + _TERMS).min(axis=1), out=best)
    return best


def band_keys(samples: np.ndarray) -> np.ndarray:
    """(documents, BANDS) keys that differ between bands."""
    grouped = samples.reshape(-1, BANDS, ROWS).astype(U64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), grouped.shape[:2])
    for k in range(ROWS):
        keys = mix(keys * U64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return keys.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """(documents, 4) words of 64 bits: bit j is the parity of the samples that hash to j."""
    n = len(samples)
    numbered = samples.astype(U64) + (np.arange(1, _SAMPLES + 1, dtype=U64) << U64(32))
    bits = (mix(numbered) % U64(SKETCH_BITS)).astype(np.int64) + np.arange(n)[:, None] * SKETCH_BITS
    odd = (np.bincount(bits.ravel(), minlength=n * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(n, SKETCH_BITS // 64)


def whole_sketch(items: np.ndarray) -> np.ndarray:
    """Parity bitmap of a whole set."""
    odd = np.bincount((items & U64(WHOLE_BITS - 1)).astype(np.int64), minlength=WHOLE_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            data, starts = utf8(batch.column(2))
            counts, digests, samples, filled = [], [], [], []
            whole_sets = np.zeros((batch.num_rows, len(_WHOLE)), np.int64)
            for i in range(batch.num_rows):
                items = shingles(word_hashes(data[starts[i] : starts[i + 1]]), size)
                counts.append(len(items))
                digests.append(blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
                if len(items):
                    filled.append(i)
                    samples.append(min_samples(items))
                    whole_sets[i] = whole_sketch(items)
            keys = [[] for _ in counts]
            sketch = np.zeros((len(counts), 4), np.int64)
            if filled:
                stacked = np.stack(samples)
                sketch[filled] = odd_sketches(stacked)
                for i, row in zip(filled, band_keys(stacked), strict=True):
                    keys[i] = row
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                    *[pa.array(column) for column in (*sketch.T, *whole_sets.T)],
                ],
                names=["_dk", "_tk", "n_shingles", "digest", "bands", *_SAMPLED, *_WHOLE],
            )


def _linked(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose full shingle sets are similar enough; the last text on the right is kept."""
    last, last_set = None, None
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            left, left_at = utf8(batch.column(2))
            right, right_at = utf8(batch.column(3))
            roots = batch.column(1).to_pylist()
            keep = []
            for i, root in enumerate(roots):
                if root != last:
                    last, last_set = root, shingles(word_hashes(right[right_at[i] : right_at[i + 1]]), size)
                items = shingles(word_hashes(left[left_at[i] : left_at[i + 1]]), size)
                small, large = sorted((len(items), len(last_set)))
                common = 0
                if 100 * small >= percent * large:
                    common = len(np.intersect1d(items, last_set, assume_unique=True))
                keep.append(100 * common >= percent * (small + large - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches with the shingle sets of their last column's texts."""
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            batch = whole.slice(at, 64)
            data, starts = utf8(batch.column(whole.num_columns - 1))
            yield batch, [shingles(word_hashes(data[a:b]), size) for a, b in pairwise(starts)]


def _cells(items: np.ndarray) -> np.ndarray:
    return (items & U64(RARITY_CELLS - 1)).astype(np.int64)


def _tally(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """How many sets have a shingle in each cell, one table a task."""
    counts = np.zeros(RARITY_CELLS, np.int64)
    for _, sets in _sets(batches, size):
        np.add.at(counts, _cells(np.concatenate(sets)), 1)
    cells = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], names=["cell", "n"])


def rarest_items(items: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The part of a set, rarest first, in which it meets every set that is similar enough.

    Similar sets have ``percent`` of either in common. With all shingles in one order, a set
    less all but one of so many shingles must hold a common one; rare shingles come first.
    """
    needed = -(-len(items) * percent // 100)
    order = np.lexsort((items, counts[_cells(items)]))
    return items[order[: len(items) - needed + 1]]


_RAREST = "digest binary, label binary, key long, rarity long, place int"


def _rarest(batches: Iterator[pa.RecordBatch], shared, size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Every text's rarest shingles, how rare they are, and how many rarer ones the text has."""
    counts = shared.value
    for batch, sets in _sets(batches, size):
        keys = [rarest_items(items, counts, percent) for items in sets]
        rows = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
        flat = np.concatenate(keys)
        cells = [flat.view(np.int64), counts[_cells(flat)], np.concatenate([np.arange(len(k), dtype=np.int32) for k in keys])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows), *map(pa.array, cells)],
            names=["digest", "label", "key", "rarity", "place"],
        )


def _may_link(left: str, right: str, percent: int) -> Column:
    """Whether the sketches, named with these prefixes, allow the similarity."""

    def differ(names: list[str]) -> Column:
        bits = [F.bit_count(F.col(left + c).bitwiseXOR(F.col(right + c))) for c in names]
        return sum(bits[1:], bits[0])

    both = F.col(f"{left}n_shingles") + F.col(f"{right}n_shingles")
    return (differ(_SAMPLED) <= MOST_BITS) & (differ(_WHOLE) * (100 + percent) <= both * (100 - percent))


def signatures(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """Per row: set size, digest of the set, band keys and odd sketch; texts without words have none."""
    rows = docs.select(*row_key(), column_or_null(docs, "text", "string").alias("text"))
    return map_in_arrow(rows, partial(_sign, size=size), _SIGNED)


def verify_pairs(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts' full sets have the similarity; ``texts`` is (digest, text)."""
    left = texts.select(F.col("digest").alias("a"), F.col("text").alias("_left"))
    right = texts.select(F.col("digest").alias("b"), F.col("text").alias("_right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "_left", "_right")
    return map_in_arrow(joined, partial(_linked, size=size, percent=percent), "a binary, b binary")


def _mixed_buckets(live: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Bucket members with their component, of the buckets that hold more than one."""
    if comps is None:
        return live.withColumn("label", F.col("digest"))
    known = comps.withColumnRenamed("node", "digest")
    marked = live.join(known, "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    marked = stage(marked, "near-marked")
    mixed = marked.groupBy("key").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a < _b")
    return stage(marked.join(mixed.select("key"), "key", "left_semi"), "near-mixed")


def _star_pairs(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each member with one chosen member of its bucket, where components and sketches allow a new link."""
    rank = F.col("digest")
    if turn:
        sizes = members.groupBy("key").agg(F.count("*").alias("_n"))
        met = members.select("key", "digest").join(sizes, "key").groupBy("digest").agg((-F.sum("_n")).alias("_met"))
        members = stage(members.join(met, "digest"), "near-met")
        rank = F.struct("_met", "digest")
    chosen = members.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), "digest", "label", *_SKETCH)).alias("_r"))
    return (
        members.join(chosen, "key")
        .where((F.col("label") != F.col("_r.label")) & _may_link("", "_r.", percent))
        .select(F.col("digest").alias("a"), F.col("_r.digest").alias("b"))
        .distinct()
    )


def _prefix_pairs(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs of different components that meet in their rarest shingles and that places and sketches allow.

    In the first shingle that two sets share, none before it is common: what follows it in either set must be
    enough. Of the keys that the same members share, the first in the order holds that shingle.
    """
    nodes = members.groupBy("digest").agg(*[F.min(c).alias(c) for c in ("label", *_SKETCH)])
    nodes = stage(nodes, "near-left")
    chosen = stage(texts.join(nodes.select("digest", "label"), "digest").select("digest", "label", "text"), "near-left-texts")
    tally = map_in_arrow(chosen.select("text"), partial(_tally, size=size), "cell long, n long")
    found = tally.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # one row a cell at most
    counts = np.zeros(RARITY_CELLS, np.int64)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    shared = members.sparkSession.sparkContext.broadcast(counts)
    rarest = map_in_arrow(chosen, partial(_rarest, shared=shared, size=size, percent=percent), _RAREST)
    rarest = stage(rarest, "near-rarest")
    who = F.xxhash64("digest")
    unsigned = F.col("key").bitwiseXOR(F.lit(-(2**63))).alias("_key")  # tasks order keys as unsigned numbers
    same_members = [F.count("*").alias("_n"), F.bit_xor(who).alias("_x"), F.bit_xor(F.xxhash64(who)).alias("_y")]
    mixed = rarest.groupBy("key").agg(
        F.min("label").alias("_a"), F.max("label").alias("_b"), F.min("rarity").alias("_rare"), *same_members
    )
    firsts = (
        mixed.where("_a < _b")
        .groupBy("_n", "_x", "_y")
        .agg(F.min(F.struct("_rare", unsigned, "key")).alias("_first"))
        .select("_first.key")
    )
    meeting = stage(rarest.join(firsts, "key", "left_semi").join(nodes.drop("label"), "digest"), "near-meeting")
    columns = ("key", "digest", "label", "place", *_SKETCH)
    left, right = (meeting.select(*[F.col(c).alias(side + c) for c in columns]) for side in ("_l_", "_r_"))
    other = (F.col("_l_digest") < F.col("_r_digest")) & (F.col("_l_label") != F.col("_r_label"))
    most_common = F.least(*[F.col(f"{side}n_shingles") - F.col(f"{side}place") for side in ("_l_", "_r_")])
    room = most_common * (100 + percent) >= (F.col("_l_n_shingles") + F.col("_r_n_shingles")) * percent
    return (
        left.join(right, (F.col("_l_key") == F.col("_r_key")) & other & room & _may_link("_l_", "_r_", percent))
        .select(F.col("_l_digest").alias("a"), F.col("_r_digest").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(_dk, _tk, n_shingles, component_id, _group): one row per row of ``docs``, see `row_key`.

    Texts are linked if 100 times the common shingles are at least ``percent`` times
    all shingles; ``component_id`` is the smallest doc_id (NULL last) that links reach.
    NULL texts and texts without words are linked with nothing. Rows equal in
    doc_id and text are one document. ``_group`` tells components apart also where ids are
    NULL or repeated, and is NULL for texts without words. Whole texts of any length are compared.
    """
    signed = stage(signatures(docs, size), "near-signed")
    full = signed.where("digest IS NOT NULL")
    nodes = full.groupBy("digest").agg(
        F.min(F.struct("_dk", "_tk")).alias("_row"), *[F.min(s).alias(s) for s in _SKETCH]
    )
    nodes = stage(nodes.select("digest", "_row.*", *_SKETCH), "near-nodes")
    keys = (
        full.join(nodes.select("digest", "_dk", "_tk"), ["digest", "_dk", "_tk"], "left_semi")
        .select("digest", F.explode("bands").alias("key"))
    )
    shared = keys.groupBy("key").agg(F.min("digest").alias("_a"), F.max("digest").alias("_b")).where("_a < _b")
    live = stage(
        keys.join(shared.select("key"), "key", "left_semi").join(nodes.select("digest", *_SKETCH), "digest"),
        "near-live",
    )
    wanted = live.select("digest").distinct().join(nodes.select("digest", "_dk", "_tk"), "digest")
    texts = stage(
        docs.select(*row_key(), column_or_null(docs, "text", "string").alias("text"))
        .join(wanted, ["_dk", "_tk"])
        .select("digest", "text")
        .dropDuplicates(["digest"]),
        "near-texts",
    )
    comps = None
    for turn in (0, 1, 2):
        members = _mixed_buckets(live, comps)
        if turn < 2:
            pairs = _star_pairs(members, turn, percent)
        else:
            pairs = _prefix_pairs(members, texts, size, percent)
        edges = stage(verify_pairs(stage(pairs, "near-pairs"), texts, size, percent), "near-edges")
        comps = _merge(comps, edges)
    labelled = (
        nodes.select("digest", "_dk")
        .join(comps.withColumnRenamed("node", "digest"), "digest", "left")
        .withColumn("label", F.coalesce("label", "digest"))
    )
    first = labelled.groupBy("label").agg(F.min("_dk").alias("component_id"))
    of_digest = labelled.select("digest", "label").join(first, "label").select(
        "digest", "component_id", F.col("label").alias("_group")
    )
    return signed.join(of_digest, "digest", "left").select(
        "_dk", "_tk", "n_shingles", F.coalesce("component_id", "_dk").alias("component_id"), "_group"
    )


def _merge(comps: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Components after more edges: edges between components are joined first."""
    if comps is None:
        return connected_components(edges)
    label_of = comps.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
    lifted = edges
    for end in ("a", "b"):
        lifted = (
            lifted.join(label_of, F.col(end) == F.col("_n"), "left")
            .withColumn(end, F.coalesce("_l", end))
            .drop("_n", "_l")
        )
    lifted = stage(lifted.where("a != b").distinct(), "near-lifted")
    if lifted.isEmpty():
        return comps
    upper = connected_components(lifted).select(F.col("node").alias("_u"), F.col("label").alias("_top"))
    known = comps.join(upper, F.col("label") == F.col("_u"), "left").select(
        "node", F.coalesce("_top", "label").alias("label")
    )
    added = upper.join(comps, F.col("_u") == F.col("node"), "left_anti").select(
        F.col("_u").alias("node"), F.col("_top").alias("label")
    )
    return stage(known.unionByName(added), "near-components")


def mark_near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Documents with ``n_shingles``, ``component_id`` and ``kept`` (the component's smallest doc_id).

    NULL doc_ids stand after all others; a component of NULL ids only has a NULL id. ``kept``
    speaks of ids, not of rows: a row is kept if its own doc_id is its component's smallest, so
    repeated rows, members with that same id and all members of a component of NULL ids are kept
    together, and of rows with one doc_id and different texts some may be kept. For one row
    of each component see `one_of_each_group`. An empty table gives no rows; input columns
    with a result's name are replaced.
    """
    base = replace_columns(docs, ["n_shingles", "component_id", "kept", "_dk", "_tk"])
    found = near_duplicates(docs, size, percent).drop("_group").dropDuplicates(["_dk", "_tk"])
    joined = base.select("*", *row_key()).join(found, ["_dk", "_tk"])
    own = F.col("component_id") == F.col("_dk")
    last = F.lit(2**63 - 1)
    return joined.select(
        *base.columns,
        "n_shingles",
        F.when(F.col("component_id") != last, F.col("component_id")).alias("component_id"),
        own.alias("kept"),
    )


def one_of_each_group(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near duplicates; texts without words are in no group, all their rows stay.

    A group is a component of texts, whatever ids its rows have: the row of the smallest
    doc_id (NULL last) stays, of several such texts the one with the smallest hash, and of rows equal
    in doc_id and text the one whose other columns have the smallest hash.
    """
    found = near_duplicates(docs, size, percent)
    texts = stage(found.groupBy("_group", "_dk", "_tk").agg(F.count("*").alias("_n")), "near-places")
    firsts = texts.where("_group IS NOT NULL").groupBy("_group").agg(F.min(F.struct("_dk", "_tk", "_n")).alias("_row"))
    wordless = texts.where("_group IS NULL").select("_dk", "_tk", F.lit(1).cast("long").alias("_n"))
    wanted = stage(firsts.select("_row.*").unionByName(wordless), "near-firsts")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), *row_key()).join(wanted, ["_dk", "_tk"])
    single = rows.where("_n = 1").select("_row.*")
    if wanted.where("_n > 1").isEmpty():
        return single
    plain = [F.col(f"_row.{f.name}") for f in docs.schema.fields if isinstance(f.dataType, AtomicType)]
    repeated = rows.where("_n > 1").groupBy("_dk", "_tk").agg(F.min_by("_row", F.xxhash64(*plain)).alias("_row"))
    return single.unionByName(repeated.select("_row.*"))
