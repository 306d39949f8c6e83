"""Exact removal of repeated byte strings by two-stage suffix sorting.

Every string of ``length`` bytes holds an anchor, the window minimum of the rolling hashes in
it, and equal strings hold equal anchors. So the strings that start near
an anchor are compared only with those near the same anchor: the text around each anchor
that occurs twice is a segment, equal segments are counted once, and the
segments of many anchors are put into one suffix array per partition. Where an anchor has more
segments than one suffix array should hold, its segments are taken apart by anchors of more bytes,
which tell more of them apart, at last by whole strings. Two-stage sorting
orders the suffixes that are smaller than their successors directly and induces the others
by one scan over the buckets; common prefixes of neighbours then tell which strings
occur twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.bytestext import U64, mix, powers, utf8
from tripflow.llm.common import column_or_null, map_in_arrow, row_key, stage

LENGTH = 200
#: Bytes of an anchor; the wider, the fewer anchors occur by chance.
ANCHOR = 48
#: Different segments that one suffix array may hold; those of other anchors are taken apart again.
MOST_SEGMENTS = 16_384
#: Starts in one segment; more only come together where hashes repeat within a text.
MOST_STARTS = 2048
#: Bytes of one suffix array, beyond which no further anchor is taken in.
BLOCK = 1 << 20
#: Suffix arrays that one task builds, on average.
TASK_BLOCKS = 4

_OCCURRENCE = "_dk long, _tk {key}, anchor long, low int, high int, again boolean"
#: Bytes hashed at once, and bits that hold a place among them.
_PART, _PART_BITS = 1 << 20, 21


def anchors(data: np.ndarray, length: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, low, high, again): the strings that start at low to high belong to the anchor of that hash.

    The anchor of a string is the smallest rolling hash in it, wherever it is, so neighbours whose
    smallest hashes are equal have one anchor: a long blank makes a row every `MOST_STARTS`
    bytes, not every byte. ``again`` tells that such a row has its hash at several places.
    """
    n = len(data) - length + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(bool)
    found, places = [], []
    span = length - width + 1
    for start in range(0, n, _PART):
        stop = min(n, start + _PART)
        part = data[start : stop + length - 1]
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum((part.astype(U64) + U64(1)) * up[: len(part)], out=sums[1:])
        hashes = mix((sums[width:] - sums[:-width]) * down[: len(part) - width + 1])
        # The place in the low bits makes the leftmost of equal hashes the smallest.
        placed = (hashes >> U64(_PART_BITS) << U64(_PART_BITS)) | np.arange(len(hashes), dtype=U64)
        order = (_sliding_min(placed, span) & U64((1 << _PART_BITS) - 1)).astype(np.int64)
        found.append(hashes[order])
        places.append(order + start)
    of, place = np.concatenate(found), np.concatenate(places)
    new = np.concatenate(([True], of[1:] != of[:-1]))
    heads = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    new |= (np.arange(n) - heads[run]) % MOST_STARTS == 0
    low = np.flatnonzero(new)
    high = np.concatenate((low[1:], [n])) - 1
    last = np.concatenate((heads[1:], [n])) - 1
    again = (place[heads] != place[last])[run[low]]
    return of[low].view(np.int64), low, high, again


def _sliding_min(values: np.ndarray, span: int) -> np.ndarray:
    """The smallest of every ``span`` neighbours, by doubling."""
    low, have = values, 1
    while have * 2 <= span:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = span - have
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def _find(batches: Iterator[pa.RecordBatch], length: int, width: int) -> Iterator[pa.RecordBatch]:
    """All anchors of all texts."""
    names = [c.split()[0] for c in _OCCURRENCE.split(",")]
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            data, starts = utf8(batch.column(2))
            found = [anchors(data[starts[i] : starts[i + 1]], length, width) for i in range(batch.num_rows)]
            counts = [len(f[0]) for f in found]
            rows = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            cells = [np.concatenate([f[k] for f in found]) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(cells[0].astype(np.int64)),
                    pa.array(cells[1].astype(np.int32)),
                    pa.array(cells[2].astype(np.int32)),
                    pa.array(cells[3].astype(bool)),
                ],
                names=names,
            )


_SEGMENT = "_dk long, _tk {key}, anchor long, low int, digest binary, size int, segment binary"


def _segments(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The text around each listed anchor and its digest; equal ones of a few documents are written once."""
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            batch = whole.slice(at, 64)
            data, starts = utf8(batch.column("_text"))
            anchor, low, high = batch.column("spots").flatten().flatten()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("spots").offsets.to_numpy()))
            sizes = high.to_numpy() - low.to_numpy() + np.int32(length)
            begin = starts[owner] + low.to_numpy()
            view, digests, parts, given = memoryview(data), [], [], set()
            for a, size in zip(begin.tolist(), sizes.tolist(), strict=True):
                part = view[a : a + size]
                digest = blake2b(part, digest_size=16).digest()
                digests.append(digest)
                parts.append(None if digest in given else bytes(part))
                given.add(digest)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_dk").take(rows),
                    batch.column("_tk").take(rows),
                    anchor,
                    low,
                    pa.array(digests, pa.binary()),
                    pa.array(sizes),
                    pa.array(parts, pa.binary()),
                ],
                names=["_dk", "_tk", "anchor", "low", "digest", "size", "segment"],
            )


def two_stage_suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (positive integers, a 0 at the end) in order of their first ``depth`` symbols.

    Suffixes smaller than their successor (type B) are sorted directly. A scan over the
    buckets in ascending order then places, for each suffix found, the one that starts
    before it, if that is larger than its successor (type A): these follow in
    their bucket's front in the order in which they are met.
    """
    n = len(text)
    symbols = text.astype(np.int64)
    # A suffix is type B if its first symbol is smaller than the next different one.
    change = np.flatnonzero(symbols[:-1] != symbols[1:])
    after = np.searchsorted(change, np.arange(n - 1))
    type_b = np.zeros(n, bool)
    type_b[: n - 1] = symbols[change[after]] < symbols[change[after] + 1]
    type_b[n - 1] = True  # the end itself
    direct = _sort_directly(symbols, np.flatnonzero(type_b), depth)

    size = int(symbols.max()) + 1
    counts = np.bincount(symbols, minlength=size)
    ends = np.cumsum(counts)
    order = np.full(n, -1, np.int64)
    first = symbols[direct]
    b_counts = np.bincount(first, minlength=size)
    b_start = ends - b_counts
    rank_in_bucket = np.arange(len(direct)) - (np.cumsum(b_counts) - b_counts)[first]
    order[b_start[first] + rank_in_bucket] = direct
    # Per place, the symbol before it if a type A suffix starts there, else -1.
    ahead = np.full(n, -1, np.int64)
    ahead[1:] = np.where(type_b[:-1], -1, symbols[:-1])
    fronts, out, ahead = (ends - counts).tolist(), order.tolist(), ahead.tolist()
    for place in out:
        letter = ahead[place]
        if letter >= 0:
            out[fronts[letter]] = place - 1
            fronts[letter] += 1
    return np.array(out, np.int64)


def _packed(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, int]:
    """At every place as many of the next symbols as fit in 63 bits, and how many these are."""
    kinds, dense = np.unique(symbols, return_inverse=True)
    bits = max(1, int(len(kinds) - 1).bit_length())
    per = min(63 // bits, depth)
    padded = np.concatenate((dense, np.zeros(depth + 3 * per, np.int64)))
    packed = np.zeros(len(symbols) + depth + 2 * per, np.int64)
    for k in range(per):
        packed = (packed << bits) | padded[k : k + len(packed)]
    return packed, per


def _sort_directly(symbols: np.ndarray, chosen: np.ndarray, depth: int) -> np.ndarray:
    """The chosen suffixes in order of their first ``depth`` symbols; equal ones in any order.

    Looks again only at suffixes that are still equal to another one. What follows is
    compared by the ranks of packed symbols, two at a time where these fit in a key.
    """
    packed, per = _packed(symbols, depth)
    order = chosen[np.argsort(packed[chosen])]
    keys = packed[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    group = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    _, rank = np.unique(packed, return_inverse=True)
    bits = int(len(packed)).bit_length()
    steps = 2 if 3 * bits <= 63 else 1
    open_at, done = np.arange(len(order)), per
    while done < depth:
        inside = group[open_at]
        alone = np.concatenate(([True], inside[1:] != inside[:-1]))
        alone &= np.concatenate((alone[1:], [True]))
        open_at = open_at[~alone]
        if not len(open_at):
            break
        part, keys = order[open_at], group[open_at]
        for k in range(steps):
            keys = (keys << bits) | rank[part + (done + k * per)]
        by = np.argsort(keys)
        order[open_at], keys = part[by], keys[by]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        # A group is named by the place of its first member.
        group[open_at] = open_at[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        done += steps * per
    return order


def adjacent_common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """The common prefix of each suffix with the one before it in order, up to ``depth``.

    Symbols are compared packed: prefixes shorter than ``depth`` are rounded down to whole packs.
    """
    packed, per = _packed(text, depth)
    common = np.zeros(len(order), np.int64)
    open_at, shift = np.arange(1, len(order)), 0
    while len(open_at):
        at = min(shift, depth - per)
        same = packed[order[open_at - 1] + at] == packed[order[open_at] + at]
        open_at = open_at[same]
        common[open_at] = at + per
        if at + per == depth:
            break
        shift += per
    return common


def repeated_starts(segments: list[bytes], length: int) -> list[np.ndarray]:
    """Per segment the places at which a string of ``length`` bytes starts that starts elsewhere too."""
    raw = np.frombuffer(b"".join(segments), np.uint8).astype(np.int32) + 2
    sizes = np.array([len(s) for s in segments])
    # Each segment ends in symbol 1, the whole in 0; no prefix of `length` runs over an end.
    text = np.insert(raw, np.cumsum(sizes), 1)
    text = np.append(text, 0)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    order = two_stage_suffix_array(text, length)
    common = adjacent_common_prefixes(text, order, length)
    alike = common >= length
    twice = alike.copy()
    twice[:-1] |= alike[1:]
    room = np.zeros(len(text), bool)
    for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
        room[start : start + max(0, size - length + 1)] = True
    marked = np.zeros(len(text), bool)
    marked[order[twice]] = True
    marked &= room
    return [np.flatnonzero(marked[s : s + n]) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]


def _runs(places: np.ndarray, length: int) -> list[dict]:
    """Covered byte runs of sorted starting places."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > length)
    first = places[np.concatenate(([0], cut + 1))]
    last = places[np.concatenate((cut, [len(places) - 1]))]
    return [{"a": int(a), "b": int(b) + length} for a, b in zip(first, last, strict=True)]


_RUN = "array<struct<a:int,b:int>>"
_RUN_ARROW = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _sort_blocks(batches: Iterator[pa.RecordBatch], length: int, block: int) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over whole anchors' segments, about ``block`` bytes at a time."""
    held: list[tuple[int, bytes, bytes]] = []
    size, last = 0, None

    def out():
        found = repeated_starts([s for _, _, s in held], length)
        rows = [(a, d, _runs(f, length)) for (a, d, _), f in zip(held, found, strict=True) if len(f)]
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], _RUN_ARROW)],
                names=["anchor", "digest", "runs"],
            )

    for batch in batches:
        for anchor, digest, segment in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "segment")), strict=True):
            if size >= block and anchor != last:
                yield from out()
                held, size = [], 0
            held.append((anchor, digest, segment))
            size += len(segment)
            last = anchor
    if held:
        yield from out()


def _remove(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            data, starts = utf8(batch.column("_text"))
            rows = []
            for i, runs in enumerate(batch.column("runs").to_pylist()):
                text = data[starts[i] : starts[i + 1]]
                keep = np.ones(len(text) + 1, np.int32)
                keep[-1] = 0
                if runs:
                    cover = np.zeros(len(text) + 1, np.int32)
                    np.add.at(cover, [r["a"] for r in runs], 1)
                    np.add.at(cover, [r["b"] for r in runs], -1)
                    keep[:-1] = np.cumsum(cover)[:-1] == 0
                gone = 1 - keep[:-1]
                spans = int((np.diff(np.concatenate(([0], gone))) == 1).sum())
                left = text[keep[:-1] == 1].tobytes()
                row = (len(text), int(gone.sum()), spans, sha256(left).hexdigest())
                rows.append((*row, left) if with_text else row)
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_bytes"] * with_text
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c) for c in zip(*rows, strict=True)]], names=["doc_id", *names]
            )


def _widths(length: int, width: int) -> list[int]:
    """Bytes of the anchors: ``width``, then half of what a string has beyond it, then whole strings."""
    return sorted({width, (width + length) // 2, length})


def _covered(texts: DataFrame, rows: DataFrame, length: int, widths: list[int], most: int) -> DataFrame:
    """(_dk, _tk, runs): the byte runs of each text whose strings start elsewhere too.

    ``texts`` (_dk, _tk, _text) is read for anchors, ``rows`` again for the text around them. With
    whole strings as anchors, all segments of an anchor are equal or runs of one byte string.
    """
    key = texts.schema["_tk"].dataType.simpleString().replace("bigint", "long")
    found = map_in_arrow(texts, partial(_find, length=length, width=widths[0]), _OCCURRENCE.format(key=key))
    spots = stage(found, "suffix-anchors")
    # Written, so that the join below has a plain exchange on both sides and a hot anchor can be split.
    often = stage(
        spots.groupBy("anchor")
        .agg(F.count("*").alias("_n"), F.bool_or("again").alias("_again"))
        .where("_n > 1 OR _again")
        .select("anchor"),
        "suffix-often",
    )
    listed = (
        spots.join(often, "anchor", "left_semi")
        .groupBy("_dk", "_tk")
        .agg(F.collect_set(F.struct("anchor", "low", "high")).alias("spots"))
    )
    around = rows.select("_dk", "_tk", "_text").join(listed, ["_dk", "_tk"])
    cut = map_in_arrow(around, partial(_segments, length=length), _SEGMENT.format(key=key))
    segments = stage(cut, "suffix-segments")
    kinds = stage(segments.groupBy("anchor", "digest").agg(F.count("*").alias("_n")), "suffix-kinds")
    # Where all segments of an anchor occur twice as a whole, nothing is left to sort.
    mixed = (
        kinds.groupBy("anchor").agg(F.count("*").alias("_kinds"), F.min("_n").alias("_least")).where("_least = 1").drop("_least")
    )
    several = stage(
        segments.where("segment IS NOT NULL")
        .join(mixed.select("anchor"), "anchor", "left_semi")
        .groupBy("anchor", "digest")
        .agg(F.first("segment").alias("segment"))
        .join(mixed, "anchor"),
        "suffix-several",
    )
    last = len(widths) == 1
    sorted_here = several if last else several.where(F.col("_kinds") <= most)
    # As many tasks as the bytes ask for: sorting takes far longer than reading them.
    size = sorted_here.agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    tasks = max(1, -(-size // (TASK_BLOCKS * BLOCK)))
    partly = map_in_arrow(
        sorted_here.select("anchor", "digest", "segment").repartition(tasks, "anchor").sortWithinPartitions("anchor", "digest"),
        partial(_sort_blocks, length=length, block=BLOCK),
        f"anchor long, digest binary, runs {_RUN}",
    )
    crowded = several.where(F.col("_kinds") > most)
    if not last and not crowded.isEmpty():
        # A segment holds whole strings only, and equal strings are in segments of one anchor.
        parts = crowded.select(F.col("anchor").alias("_dk"), F.col("digest").alias("_tk"), F.col("segment").alias("_text"))
        deeper = _covered(parts, parts, length, widths[1:], most)
        partly = partly.unionByName(deeper.select(F.col("_dk").alias("anchor"), F.col("_tk").alias("digest"), "runs"))
    repeated = kinds.join(partly, ["anchor", "digest"], "left").where("_n > 1 OR runs IS NOT NULL")
    covered = (
        segments.select("_dk", "_tk", "anchor", "digest", "low", "size")
        .join(repeated, ["anchor", "digest"])
        .withColumn(
            "_runs",
            F.when(F.col("_n") > 1, F.array(F.struct(F.col("low").alias("a"), (F.col("low") + F.col("size")).alias("b"))))
            .otherwise(
                F.transform("runs", lambda r: F.struct((F.col("low") + r["a"]).alias("a"), (F.col("low") + r["b"]).alias("b")))
            ),
        )
        .groupBy("_dk", "_tk")
        .agg(F.flatten(F.collect_list("_runs")).alias("runs"))
    )
    return stage(covered, "suffix-covered")


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, width: int = ANCHOR, most: int = MOST_SEGMENTS, with_text: bool = True
) -> DataFrame:
    """Per document ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and the bytes that are left.

    Removes every byte that a string of ``length`` bytes covers which also starts anywhere
    else, in this text or another; judged on the input. Strings never run over the
    end of a text. NULL and shorter texts lose nothing; a text of any length is
    cut around its anchors, and one task holds one text. Rows equal in doc_id and
    text are one document with as many copies, each of which counts as another place. An
    empty table gives no rows; columns other than doc_id are not returned.
    """
    rows = docs.select(
        column_or_null(docs, "doc_id", "long").alias("doc_id"),
        *row_key(),
        column_or_null(docs, "text", "string").alias("_text"),
    )
    covered = _covered(rows.select("_dk", "_tk", "_text"), rows, length, _widths(length, width), most)
    result = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_text
    joined = rows.join(covered, ["_dk", "_tk"], "left").select("doc_id", "_text", "runs")
    return map_in_arrow(joined, partial(_remove, with_text=with_text), f"doc_id long, {result}")
