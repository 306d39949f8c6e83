"""Document fingerprints: invertible Bloom lookup tables over paragraph digests.

A text is cut into lines and sentences, and longer ones into pieces of fixed length, so
that an edit changes few pieces. Each piece's digest goes into three cells that hold a
count, a sum of digests and a sum of check values. Two tables are subtracted and
the difference is peeled cell by cell, which recovers the differing digests; a
difference too large for the table is taken again with a larger one.

Pieces are hashed, and tables filled and peeled, for a whole block of documents at a time.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.bytestext import U64, mix, powers
from tripflow.llm.common import LAST_ID, column_or_null, map_in_arrow

#: Cells of the published fingerprint; tables that are too small are doubled.
CELLS = 12
PIECE_CHARS = 48
#: Rows of a range of ids; more ranges than MOST_RANGES are not made, ranges then grow.
RANGE_ROWS, MOST_RANGES = 512, 10_000

#: Documents and characters of a block, and cells that are peeled at once.
_BLOCK_ROWS, _BLOCK_CHARS, _BLOCK_CELLS = 256, 1 << 20, 1 << 20
#: Line breaks, "!", "." and "?" end a piece.
_ENDS = (10, 33, 46, 63)
_STEP = U64(0x9E3779B97F4A7C15)
_CHECK = U64(0xD6E8FEB86659FD93)
_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _pieces(codes: np.ndarray, first: np.ndarray, piece_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every piece of joined texts; ``first`` marks the first character of each text.

    A piece is up to ``piece_chars`` characters and the ends that follow them directly, or ends that open a text.
    """
    ends = np.isin(codes, _ENDS)
    at = np.arange(len(codes))
    opens = ~ends & (first | np.concatenate(([True], ends[:-1])))
    since = at - np.maximum.accumulate(np.where(opens, at, 0))
    starts = np.flatnonzero(~ends & (since % piece_chars == 0) | first)
    stops = np.append(starts[1:], len(codes))
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, U64)
    np.cumsum((codes.astype(U64) + U64(1)) * up[: len(codes)], out=sums[1:])
    return starts, mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(U64))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _long_text(text: str, piece_chars: int) -> Iterator[np.ndarray]:
    """The hashes of a long text's pieces, part by part; every part but the last stops at the start of a piece."""
    start, size = 0, _BLOCK_CHARS
    while start < len(text):
        codes = _codes(text[start : start + size])
        first = np.zeros(len(codes), bool)
        first[0] = True
        starts, hashes = _pieces(codes, first, piece_chars)
        if start + size >= len(text):
            yield hashes
            return
        if len(starts) > 1:
            yield hashes[:-1]
            start, size = start + int(starts[-1]), _BLOCK_CHARS
        else:
            size *= 2


def piece_hashes(texts: list[str], piece_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(text's number, hash) of all pieces of all texts."""
    owners, found, waiting, size = [np.zeros(0, np.int64)], [np.zeros(0, U64)], [], 0

    def hash_waiting() -> None:
        lengths = np.array([len(texts[i]) for i in waiting])
        first = np.zeros(lengths.sum(), bool)
        begins = np.cumsum(lengths) - lengths
        first[begins] = True
        starts, hashes = _pieces(_codes("".join(texts[i] for i in waiting)), first, piece_chars)
        owners.append(np.array(waiting)[np.searchsorted(begins, starts, side="right") - 1])
        found.append(hashes)

    for i, text in enumerate(texts):
        if len(text) > _BLOCK_CHARS:
            for hashes in _long_text(text, piece_chars):
                owners.append(np.full(len(hashes), i))
                found.append(hashes)
        elif text:
            waiting.append(i)
            size += len(text)
        if size > _BLOCK_CHARS:
            hash_waiting()
            waiting, size = [], 0
    if waiting:
        hash_waiting()
    return np.concatenate(owners), np.concatenate(found)


class Sketches:
    """The distinct digests of many texts, and tables made from them."""

    def __init__(self, texts: list[str], piece_chars: int = PIECE_CHARS):
        owners, hashes = piece_hashes(texts, piece_chars)
        order = np.lexsort((hashes, owners))
        owners, hashes = owners[order], hashes[order]
        # The k-th equal piece of a text has a digest of its own.
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (owners[1:] == owners[:-1])
        at = np.arange(len(hashes))
        ordinal = at - np.maximum.accumulate(np.where(again, 0, at))
        self.items = mix(hashes + ordinal.astype(U64) * _STEP)
        self.counts = np.bincount(owners, minlength=len(texts))
        self.starts = np.cumsum(self.counts) - self.counts

    def of(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``texts``, digest) of all digests of these texts."""
        counts = self.counts[texts]
        places = np.repeat(np.arange(len(texts)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return places, self.items[np.repeat(self.starts[texts], counts) + within]

    def differences(self, a: np.ndarray, b: np.ndarray | None, cells: int) -> np.ndarray:
        """(3, len(a) * cells): the tables of texts ``a``, less those of ``b``."""
        table = np.zeros((3, len(a) * cells), U64)
        add_items(table, *self.of(a), cells)
        if b is not None:
            minus = np.zeros_like(table)
            add_items(minus, *self.of(b), cells)
            table -= minus
        return table

    def likeness(self, a: np.ndarray, b: np.ndarray, cells: int = CELLS) -> np.ndarray:
        """The share of both texts' digests that is common, from the peeled differences; 1 for two empty texts."""
        both = self.counts[a] + self.counts[b]
        less = np.abs(self.counts[a] - self.counts[b])
        base = self.differences(a, b, cells)
        # Each differing digest adds one to the squares of three counts, on average.
        squares = (base[0].view(np.int64).reshape(-1, cells) ** 2).sum(axis=1) // 3
        about = np.minimum(both, np.maximum(less, squares))
        # Small tables need room beside the 1.23 cells a digest that large ones need.
        sizes = np.where(about <= cells // 2, cells, cells << np.ceil(np.log2(np.maximum(about * 1.4 / cells + 1, 1))).astype(int))
        differ = np.full(len(a), -1)
        while (differ < 0).any():
            size = int(sizes[differ < 0].min())
            todo = np.flatnonzero((differ < 0) & (sizes == size))[: max(1, _BLOCK_CELLS // size)]
            peeled = peel(self.differences(a[todo], b[todo], size), size)
            differ[todo] = peeled
            sizes[todo] = np.where(peeled < 0, 2 * size, size)
        return np.where(both == 0, 1.0, (both - differ) / np.maximum(both, 1))


def _places(items: np.ndarray, cells: int) -> np.ndarray:
    """The three cells of every item, one in each third of the table."""
    third = cells // 3
    if third <= 1 << 21:
        # Three 21-bit parts of one hash, each scaled to the third.
        hashed = mix(items + U64(cells))
        parts = [((hashed >> U64(21 * k)) & U64((1 << 21) - 1)) * U64(third) >> U64(21) for k in range(3)]
        return np.concatenate([part.astype(np.int64) + k * third for k, part in enumerate(parts)])
    salted = [mix(items + U64(cells * 8 + k)) % U64(third) + U64(k * third) for k in range(3)]
    return np.concatenate(salted).astype(np.int64)


def add_items(table: np.ndarray, owners: np.ndarray, items: np.ndarray, cells: int) -> None:
    """Put items into their owners' tables: counts, digest sums and check sums, all modulo 2**64."""
    places = _places(items, cells) + np.tile(owners * cells, 3)
    table[0] += np.bincount(places, minlength=table.shape[1]).astype(U64)
    np.add.at(table[1], places, np.tile(items, 3))
    np.add.at(table[2], places, np.tile(mix(items ^ _CHECK), 3))


def peel(table: np.ndarray, cells: int) -> np.ndarray:
    """How many digests each subtracted table recovers from either side, or -1 where cells remain.

    All tables are peeled in the same steps. ``table`` is used up.
    """
    found = np.zeros(table.shape[1] // cells, np.int64)
    minus = U64(2**64 - 1)
    for _ in range(table.shape[1]):
        # Counts of 1 and -1 are their own signs.
        single = np.flatnonzero((table[0] == 1) | (table[0] == minus))
        sign = table[0][single]
        items = table[1][single] * sign
        pure = mix(items ^ _CHECK) == table[2][single] * sign
        if not pure.any():
            break
        owners, items, sign = single[pure] // cells, items[pure], sign[pure]
        order = np.lexsort((items, owners))
        new = np.ones(len(order), bool)
        new[1:] = (items[order][1:] != items[order][:-1]) | (owners[order][1:] != owners[order][:-1])
        owners, items, sign = (x[order[new]] for x in (owners, items, sign))
        found += np.bincount(owners, minlength=len(found))
        places = _places(items, cells) + np.tile(owners * cells, 3)
        for row, values in zip(table, (sign, items * sign, mix(items ^ _CHECK) * sign), strict=True):
            np.subtract.at(row, places, np.tile(values, 3))
    return np.where(table.any(axis=0).reshape(-1, cells).any(axis=1), -1, found)


def published(sketches: Sketches, texts: np.ndarray, cells: int) -> list[str]:
    """The fingerprint of each text: its number of digests and its table."""
    table = sketches.differences(texts, None, cells).reshape(3, len(texts), cells)
    parts = [table[0].astype("<u4"), table[1].astype("<u8"), table[2].astype("<u4")]
    packed = np.concatenate([part.view(np.uint8).reshape(len(texts), -1) for part in parts], axis=1)
    return [f"{n:x}:{base64.b64encode(row).decode()}" for n, row in zip(sketches.counts[texts], packed, strict=True)]


def _compare(rows: list[tuple[int, str, str]], cells: int, piece_chars: int) -> pa.RecordBatch:
    """Results for (doc_id, text, next text)."""
    n = len(rows)
    texts = [text for _, text, _ in rows]
    edited = [text[: len(text) - len(text) // 3] + after[: len(text) // 3] for _, text, after in rows]
    every, following = [*texts, *edited], np.arange(1, n + 1)
    for i, (_, _, after) in enumerate(rows):
        if i + 1 == n or rows[i + 1][1] is not after:
            following[i] = len(every)
            every.append(after)
    sketches = Sketches(every, piece_chars)
    own, changed = np.arange(n), np.arange(n, 2 * n)
    columns = [
        pa.array([doc_id for doc_id, _, _ in rows], pa.int64()),
        pa.array([len(text) for text in texts], pa.int64()),
        pa.array([sha256(text.encode("utf-8", "surrogatepass")).hexdigest() for text in edited]),
        pa.array(published(sketches, own, cells)),
        pa.array(published(sketches, changed, cells)),
        pa.array(sketches.likeness(own, changed, cells)),
        pa.array(sketches.likeness(own, following, cells)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _RESULT.split(",")])


def _fingerprint(batches: Iterator[pa.RecordBatch], cells: int, piece_chars: int) -> Iterator[pa.RecordBatch]:
    """Rows come by range and in order, after each range the first row of the next one."""
    waiting, rows, size = None, [], 0
    for whole in batches:
        for at in range(0, whole.num_rows, _BLOCK_ROWS):
            part = whole.slice(at, _BLOCK_ROWS).to_pydict()
            for group, tail, doc_id, text in zip(part["_range"], part["_tail"], part["doc_id"], part["text"], strict=True):
                if waiting is not None and waiting[0] == group:
                    rows.append((*waiting[1:], text))
                    size += len(text)
                waiting = None if tail else (group, doc_id, text)
                if len(rows) == _BLOCK_ROWS or size > _BLOCK_CHARS:
                    yield _compare(rows, cells, piece_chars)
                    rows, size = [], 0
    if rows:
        yield _compare(rows, cells, piece_chars)


def compare_with_edits(docs: DataFrame, cells: int = CELLS, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and how alike they and the next one's are.

    The next document has the next smaller doc_id (NULL ids last, ties by the text's
    hash), and after the last comes the first; a lone document is its own next. The
    edited text has the last third of its characters replaced by the first as
    many of the next document. NULL texts count as empty; two empty texts are alike (1).
    Texts of any length are cut whole, part by part. Repeated rows are documents of their own. An empty
    table gives no rows; other columns are not read.

    A likeness counts the digests that peeling recovers. Two published fingerprints of 12 cells hold up to about
    half a dozen differing digests; they give the returned likeness by themselves where they peel. Where they
    don't, larger tables of the same texts are subtracted, which are not returned.

    Documents are dealt in ranges of their order, by one sort; of many rows with one id, ranges are cut by the texts'
    hashes. Rows that are equal in id and text stay in one range, which streams through its task. The driver holds the
    bounds of at most ``MOST_RANGES`` ranges.
    """
    doc_id = column_or_null(docs, "doc_id", "long")
    text = F.coalesce(column_or_null(docs, "text", "string"), F.lit(""))
    # The complement falls as the id grows, for every long; NULL comes with the last and after it.
    order = F.coalesce(F.bitwise_not(doc_id), F.lit(LAST_ID))
    hashed = F.shiftrightunsigned(F.xxhash64(text), 1)
    last = order == LAST_ID
    tie = F.when(last & doc_id.isNotNull(), hashed.bitwiseXOR(F.lit(-(2**63)))).otherwise(hashed)
    base = docs.select(doc_id.alias("doc_id"), text.alias("text"), order.alias("_order"), tie.alias("_tie"))
    ranges = max(1, min(MOST_RANGES, -(-base.count() // RANGE_ROWS)))
    ranged = base.withColumn("_range", _range_of(base, ranges))
    # At most MOST_RANGES rows: where every range begins, and the range before it.
    heads = ranged.groupBy("_range").agg(F.min(F.struct("_order", "_tie")).alias("_h")).select("_range", "_h.*").collect()
    heads = sorted(tuple(head) for head in heads)
    before = [(*head, heads[k - 1][0]) for k, head in enumerate(heads)]
    tails = docs.sparkSession.createDataFrame(before, "_range int, _order long, _tie long, _before int")
    firsts = ranged.join(F.broadcast(tails), ["_range", "_order", "_tie"]).dropDuplicates(["_range"])
    own = ranged.withColumn("_tail", F.lit(False))
    after = firsts.select("doc_id", "text", "_order", "_tie", F.col("_before").alias("_range"), F.lit(True).alias("_tail"))
    placed = own.unionByName(after).repartitionByRange("_range")
    in_order = placed.sortWithinPartitions("_range", "_tail", "_order", "_tie")
    return map_in_arrow(
        in_order.select("_range", "_tail", "doc_id", "text"),
        partial(_fingerprint, cells=cells, piece_chars=piece_chars),
        _RESULT,
    )


def _range_of(base: DataFrame, ranges: int) -> Column:
    """The number of a row's range, of about ``ranges`` even ones."""
    if ranges == 1:
        return F.lit(0)
    points = [k / ranges for k in range(1, ranges)]
    found = base.agg(F.percentile_approx("_order", points, 100 * ranges)).first()[0]
    # An id that fills several ranges has them to itself, and is cut by hashes.
    hot = {value: count for value, count in Counter(found).items() if count > 1}
    bounds = sorted(set(found) | {value + 1 for value in hot if value < LAST_ID})
    cuts = [1, *[hot.get(bound, 1) for bound in bounds]]
    begins = np.cumsum([0, *cuts[:-1]]).tolist()
    coarse = _among(F.col("_order"), bounds)
    first, cut = (F.get(F.expr(f"array({', '.join(map(str, values))})"), coarse) for values in (begins, cuts))
    share = F.greatest(F.col("_tie"), F.lit(0)) / F.lit(2.0**63)
    return (first + F.least(F.floor(share * cut), cut - 1)).cast("int")


def _among(value: Column, bounds: list[int]) -> Column:
    """The number of bounds up to ``value``; bounds are searched in blocks of 100."""
    blocks = [bounds[k : k + 100] for k in range(0, len(bounds), 100)]
    heads = F.array(*[F.lit(b[0]).cast("long") for b in blocks])
    tables = F.array(*[F.array(*[F.lit(x).cast("long") for x in b]) for b in blocks])
    block = F.greatest(F.size(F.filter(heads, lambda h: h <= value)) - 1, F.lit(0))
    inside = F.size(F.filter(F.get(tables, block), lambda b: b <= value))
    return (block * 100 + inside).cast("int")
