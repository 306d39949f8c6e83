"""Mixture-controlled packing into windows of fixed length.

Every source is a queue of tokens. Deficit round-robin fills each window from all queues: a source is due
its target proportion of the window, gets it in whole units of a few tokens, and what it lacks or
has too much is carried on to the next window. The carried deficits have a
closed form (nested two-way rounding, see `Phase`), so every partition knows what was carried over into its own
part, and nothing is dealt one after the other.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import column_or_null, map_in_arrow, offsets_before, row_key, source_key, stage

WINDOW = 1024
#: Tokens of the units that a source is served in; divides the window. No window has more pieces of
#: documents that go on than units, however many sources there are.
QUANTUM = 4
END_ID = 0
#: Documents in one chunk of a queue, on average.
CHUNK_ROWS = 4096
RANKS = "byte_bpe_50k.tiktoken"
#: The same vocabulary for texts with a longer run of white space than `LONG_BLANK`.
VOCABULARY = "byte_bpe_50k.json"
LONG_BLANK = 100_000
_BLANKS = re.compile(r"\s+")

_TOKENS = "doc_id long, _dk long, _tk long, _sk string, n long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


@cache
def _encoder(ranks: str):
    """The byte-level BPE of the rank file, for texts without added tokens."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


@cache
def _blank_encoder(vocabulary: str):
    """The same ids by another library, added tokens as the vocabulary has them."""
    import public_tokenizers
    import tokenizers

    return tokenizers.Tokenizer.from_file(public_tokenizers.path(vocabulary))


@cache
def _added_tokens(vocabulary: str) -> tuple[re.Pattern | None, dict[str, int], bool]:
    """A pattern that finds the vocabulary's added tokens, their ids, and whether all are matched as they stand."""
    added = _blank_encoder(vocabulary).get_added_tokens_decoder()
    ids = {token.content: i for i, token in added.items()}
    longest = sorted(ids, key=len, reverse=True)
    exact = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values())
    return re.compile("|".join(map(re.escape, longest))) if ids else None, ids, exact


def token_ids(text: str, ranks: str = RANKS, vocabulary: str = VOCABULARY) -> list[int]:
    """The ids of a whole text, as the vocabulary gives them without special tokens around it.

    A string of an added token, such as <|endoftext|>, is the one id of that token; the
    parts between are encoded by themselves.
    """
    pattern, added, exact = _added_tokens(vocabulary)
    if pattern is None or not pattern.search(text):
        return _plain_ids(text, ranks, vocabulary)
    if not exact:
        return _blank_encoder(vocabulary).encode(text, add_special_tokens=False).ids
    ids, at = [], 0
    for found in pattern.finditer(text):
        ids += _plain_ids(text[at : found.start()], ranks, vocabulary)
        ids.append(added[found.group()])
        at = found.end()
    return ids + _plain_ids(text[at:], ranks, vocabulary)


def _plain_ids(text: str, ranks: str, vocabulary: str) -> list[int]:
    """The ids of a text without added tokens.

    The quick encoder steps back over a run of white space character by character, and its
    stack ends at about a million of them; texts with long runs go to the other one.
    """
    if len(text) > LONG_BLANK and max(map(len, _BLANKS.findall(text)), default=0) > LONG_BLANK:
        return _blank_encoder(vocabulary).encode(text, add_special_tokens=False).ids
    return _encoder(ranks).encode_ordinary(text)


def _tokenize(batches: Iterator[pa.RecordBatch], ranks: str) -> Iterator[pa.RecordBatch]:
    """Token ids of every text and the end id, as 16-bit numbers."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            ids = []
            for text in batch.column(4).to_pylist():
                found = array("H", token_ids(text, ranks))
                found.append(END_ID)
                ids.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "_dk", "_tk", "_sk", "n", "ids"],
            )


@dataclass
class Phase:
    """A stretch of the windows that is dealt from the same queues in the same proportions.

    The queues' units (``unit`` tokens each) are dealt over a binary tree: of the first x units
    that reach a node, its left side gets floor(x * left / all), which carries the deficit
    of either side in the rounding, and all of them together use up what the phase deals. ``paths``
    has each source's way from the root as (is left, units on the left, units of the node).
    """

    unit: int
    #: First place of the phase, and its units.
    start: int
    total: int
    #: Per source its units in this phase and the tokens its queue has given before.
    units: dict[str, int]
    given: dict[str, int]
    paths: dict[str, list[tuple[bool, int, int]]]

    @classmethod
    def of(cls, unit: int, start: int, units: dict[str, int], given: dict[str, int]) -> Phase:
        units = {k: n for k, n in sorted(units.items()) if n}
        paths: dict[str, list] = {k: [] for k in units}

        def split(keys: list[str]) -> None:
            if len(keys) < 2:
                return
            left, right = keys[: len(keys) // 2], keys[len(keys) // 2 :]
            n_left, n_all = sum(units[k] for k in left), sum(units[k] for k in keys)
            for side, is_left in ((left, True), (right, False)):
                for k in side:
                    paths[k].append((is_left, n_left, n_all))
                split(side)

        split(list(units))
        return cls(unit, start, sum(units.values()), units, {k: given[k] for k in units}, paths)

    def whole(self, values: np.ndarray) -> np.ndarray:
        """As numbers whose products are exact: Python's own where 64 bits could overflow."""
        return values.astype(np.int64 if (self.total + 1) ** 2 < 2**62 else object)

    def dealt(self, source: str, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the phase's first x units, those of the source and those of the sources before it."""
        own, before = self.whole(x), self.whole(np.zeros(len(x)))
        for is_left, n_left, n_all in self.paths[source]:
            left = own * n_left // n_all
            if is_left:
                own = left
            else:
                before, own = before + left, own - left
        return own.astype(np.int64), before.astype(np.int64)

    def turn(self, source: str, served: np.ndarray) -> np.ndarray:
        """At which of the phase's units the source's unit number ``served`` falls due."""
        served = self.whole(served)
        for is_left, n_left, n_all in reversed(self.paths[source]):
            served = -(-(served + 1) * n_all // n_left) - 1 if is_left else served * n_all // (n_all - n_left)
        return served.astype(np.int64)

    def pieces(self, source: str, first: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
        """(document, queue position, length, place) of what documents have in this phase.

        ``first`` and ``n`` are the documents' first places in the source's queue and their tokens.
        In each window the source's units of that window lie together.
        """
        given = self.given[source]
        low = np.maximum(first, given)
        high = np.minimum(first + n, given + self.units[source] * self.unit)
        of = np.flatnonzero(low < high)
        low, high = low[of] - given, high[of] - given
        per = window // self.unit
        ahead = self.start // self.unit
        from_window = (self.turn(source, low // self.unit) + ahead) // per
        to_window = (self.turn(source, (high - 1) // self.unit) + ahead) // per
        counts = to_window - from_window + 1
        row = np.repeat(np.arange(len(of)), counts)
        at = np.repeat(from_window, counts) + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = np.clip(at * per - ahead, 0, self.total)
        own, before = self.dealt(source, begin)
        own_after, before_after = self.dealt(source, np.clip((at + 1) * per - ahead, 0, self.total))
        start = np.maximum(low[row], own * self.unit)
        stop = np.minimum(high[row], own_after * self.unit)
        # In the window, the units of the sources before this one come first.
        place = self.start + (begin + before_after - before - own) * self.unit + start
        some = start < stop
        return of[row[some]], start[some] + given, (stop - start)[some], place[some]


@dataclass
class Deal:
    """Where each source's tokens go: the phases, one after the other."""

    phases: list[Phase]

    @classmethod
    def of(cls, totals: dict[str, int], unit: int, shares: dict[str, float] | None = None) -> Deal:
        """Deals all tokens in the proportions of ``shares``, or of the totals themselves.

        A queue that runs dry ends a phase, and the others go on in their proportions to
        each other. Sources without a share come after these, in the proportions of their totals. What is
        left of each source below a unit comes at the end.
        """
        left = {k: n // unit for k, n in totals.items() if n >= unit}
        given = dict.fromkeys(totals, 0)
        phases, start = [], 0

        def deal(units: dict[str, int], size: int) -> None:
            nonlocal start
            if not any(units.values()):
                return
            phases.append(Phase.of(size, start, units, given))
            for k, n in units.items():
                given[k] += n * size
                start += n * size

        weights = {k: Fraction(w) for k, w in (shares or {}).items() if w > 0}
        while active := [k for k in left if left[k] and k in weights]:
            rounds = min(left[k] / weights[k] for k in active)
            units = {k: int(rounds * weights[k]) for k in active}
            deal(units, unit)
            left = {k: n - units.get(k, 0) for k, n in left.items()}
        deal(left, unit)
        deal({k: totals[k] - given[k] for k in totals}, 1)
        return cls(phases)

    def pieces(self, source: str, first: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
        """(document, start in the document, length, place), by document and start."""
        parts = [p.pieces(source, first, n, window) for p in self.phases if source in p.units]
        row, at, length, place = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((at, row))
        row, at, length, place = row[order], at[order], length[order], place[order]
        # What lies together in one window is one piece.
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + length[:-1]) | (place[1:] % window == 0)
        heads = np.flatnonzero(new)
        return row[heads], (at - first[row])[heads], np.add.reduceat(length, heads), place[heads]


def _cut(batches: Iterator[pa.RecordBatch], deal, window: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    deal = deal.value
    names = [c.split()[0] for c in _PIECES.split(",")] + ["ids"] * with_ids
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            part = whole.slice(at, 512)
            sources = part.column("_sk").to_pylist()
            first, n = (part.column(c).to_numpy() for c in ("_first", "n"))
            members: dict[str, list[int]] = {}
            for i, source in enumerate(sources):
                members.setdefault(source, []).append(i)
            found = []
            for source, rows in members.items():
                rows = np.array(rows)
                row, *cells = deal.pieces(source, first[rows], n[rows], window)
                found.append((rows[row], *cells))
            row, start, length, place = (np.concatenate(c) for c in zip(*found, strict=True))
            ids = [memoryview(np.frombuffer(x, "<u2").astype("<u4")).cast("B") for x in part.column("ids").to_pylist()]
            bytes_of = [
                ids[r][4 * a : 4 * b] for r, a, b in zip(row.tolist(), start.tolist(), (start + length).tolist(), strict=True)
            ]
            cells = [
                part.column("doc_id").take(pa.array(row)),
                pa.array(start),
                pa.array(length),
                pa.array([zlib.crc32(x) for x in bytes_of], pa.int64()),
                pa.array(n[row]),
                pa.array(place // window),
                pa.array(place % window),
            ]
            if with_ids:
                cells.append(pa.array([bytes(x) for x in bytes_of], pa.binary()))
            yield pa.RecordBatch.from_arrays(cells, names=names)


def pack_documents(
    docs: DataFrame,
    window: int = WINDOW,
    quantum: int = QUANTUM,
    ranks: str = RANKS,
    with_ids: bool = True,
    shares: dict[str | None, float] | None = None,
) -> DataFrame:
    """The pieces of all documents, each id in one piece, and where they lie.

    ``sequence_id`` counts windows of ``window`` tokens, ``offset`` is the place in the window;
    all windows but the last are full. ``shares`` gives sources their target proportions (of any sum); without it
    they are those of the corpus. Every window is filled to them, to within a rounding of
    ``quantum`` tokens for each level of a binary tree over the sources, until a source has run out: then the others keep
    their proportions to each other, and sources without a share come last. Each source keeps less than
    a quantum for the last windows. ``ids`` (little-endian unsigned 32-bit) is left out on request. NULL and empty texts are one end id. NULL is a
    source of its own; queues are in an order of hashed chunks. Repeated rows are documents
    of their own, and rows with one doc_id tell themselves apart by their texts. An
    empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(column_or_null(docs, "text", "string"), F.lit(""))
    rows = docs.select(
        column_or_null(docs, "doc_id", "long").alias("doc_id"),
        *row_key(),
        source_key(column_or_null(docs, "source", "string")).alias("_sk"),
        text.alias("_text"),
    )
    tokens = stage(map_in_arrow(rows, partial(_tokenize, ranks=ranks), _TOKENS), "pack-tokens")
    chunks = max(64, -(-tokens.count() // CHUNK_ROWS))
    tokens = tokens.withColumn("_chunk", F.pmod(F.xxhash64("_dk", "_tk"), F.lit(chunks)))
    sums = tokens.groupBy("_sk", "_chunk").agg(F.sum("n").alias("_sum"))
    # One row per source.
    sums = stage(sums, "pack-sums")
    totals = {k: n for k, n in sums.groupBy("_sk").agg(F.sum("_sum")).collect()}
    starts = stage(offsets_before(sums, ["_sk"], "_chunk", "_sum", "_at"), "pack-starts").drop("_sum")
    targets = shares and {"n" if k is None else f"s{k}": w for k, w in shares.items()}
    deal = docs.sparkSession.sparkContext.broadcast(Deal.of(totals, quantum, targets))
    before = Window.partitionBy("_sk", "_chunk").orderBy("_dk", "_tk", "n").rowsBetween(Window.unboundedPreceding, -1)
    queued = tokens.join(starts, ["_sk", "_chunk"]).withColumn(
        "_first", F.col("_at") + F.coalesce(F.sum("n").over(before), F.lit(0))
    )
    schema = _PIECES + (", ids binary" if with_ids else "")
    return map_in_arrow(queued.select("doc_id", "_sk", "n", "ids", "_first"), 
        partial(_cut, deal=deal, window=window, with_ids=with_ids), schema
    )
