"""Arrow text columns as NumPy bytes, and hashes of all words of a text at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the row offsets into them; NULL is empty."""
    array = column.cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null(b"")
    _, offsets, data = array.buffers()
    starts = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), starts


def mix(values: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values."""
    values = values ^ (values >> U64(30))
    values = values * U64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> U64(27))
    values = values * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def _pieces(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Cut at blanks into pieces of about ``limit`` bytes; a longer word stays whole."""
    start = 0
    while len(data) - start > limit:
        blanks = np.flatnonzero(_BLANK[data[start + limit :]])
        if not len(blanks):
            break
        stop = start + limit + int(blanks[0])
        yield data[start:stop]
        start = stop
    yield data[start:]


def word_hashes(data: np.ndarray, limit: int = 1 << 20) -> np.ndarray:
    """The hash of every word of one text, A-Z lower-cased, in order."""
    found = []
    for piece in _pieces(data, limit):
        inside = ~_BLANK[piece]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        starts, stops = edges[::2], edges[1::2]
        if not len(starts):
            continue
        up, down = powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, U64)
        np.cumsum((_LOWER[piece].astype(U64) + U64(1)) * up[: len(piece)], out=sums[1:])
        found.append(mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(U64)))
    return np.concatenate(found) if found else np.zeros(0, U64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` words; of a shorter text, the whole as one."""
    if not len(words):
        return words
    width = min(size, len(words))
    rolled = np.full(len(words) - width + 1, U64(width))
    for k in range(width):
        rolled = rolled * _BASE + words[k : len(words) - width + 1 + k]
    return np.unique(mix(rolled))
