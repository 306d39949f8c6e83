"""Whitening of embeddings by eigenvectors that are refined beyond the precision they are found in.

The sums and the centred products of the vectors are added up by Spark; only a matrix of dims x dims
comes to the driver. There its eigenvectors are found in float32 and corrected by the matrix-multiplication
iteration of Ogita and Aishima, first in float64, then in extended precision. Eigenvalues that lie too
close for the correction are a cluster, whose vectors are turned by the eigenvectors of the small matrix
that the cluster spans. The components are then applied to all vectors in a further pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from tripflow.llm.common import column_or_null, map_in_arrow, replace_columns

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Steps of the correction; each about doubles the number of right digits.
MOST_STEPS = 30
#: Eigenvalues closer than so many times the error are a cluster; the more, the smaller every correction.
APART = 64
#: A component whose variance is a smaller share of the whole than this is rounding, not variance.
LEAST_SHARE = 1e-13
#: Whole numbers beyond this are not exact in float64; entries are clipped there.
EXACT = 2.0**52
#: Rows that are multiplied at once.
_ROWS = 4096


class Fit(NamedTuple):
    """What the vectors have in common: x has the sums n * center + rest, less SHIFT a row."""

    n: int
    center: list[int]
    rest: list[int]
    covariance: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, dict[int, tuple[np.ndarray, np.ndarray]]]]:
    """Batches and, by length, (rows, vectors) of their usable vectors: entries as floor(1024 c), in float64."""
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            column = batch.column(batch.num_columns - 1)
            lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
            offsets = np.asarray(column.offsets, np.int64)
            values = column.values.to_numpy(zero_copy_only=False)  # NULL becomes NaN
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            good = bad[offsets[1:]] == bad[offsets[:-1]]
            found = {}
            for dims in set(lengths[good].tolist()) - {-1, 0}:
                rows = np.flatnonzero(good & (lengths == dims))
                vectors = values[offsets[rows][:, None] + np.arange(dims)]
                found[dims] = rows, np.clip(np.floor(SCALE * vectors), -EXACT, EXACT)
            yield batch, found


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By length, a task's sums, and its rows in the place after the last dimension."""
    totals: dict[int, np.ndarray] = {}
    for _, found in _blocks(batches):
        for dims, (rows, x) in found.items():
            total = totals.setdefault(dims, np.zeros(dims + 1, object))
            total[:dims] += [int(part) for part in x.astype(np.int64).sum(axis=0)]
            total[dims] += len(rows)
    # In halves of 32 bits, so that their sums over all tasks fit a long.
    parts = [(dims, i, int(v) >> 32, int(v) & 0xFFFFFFFF) for dims, total in totals.items() for i, v in enumerate(total)]
    if parts:
        cells = [pa.array(c, k) for c, k in zip(zip(*parts, strict=True), [pa.int32()] * 2 + [pa.int64()] * 2, strict=True)]
        yield pa.RecordBatch.from_arrays(cells, names=["dims", "i", "high", "low"])


def _lines(matrix: np.ndarray) -> pa.RecordBatch:
    size = len(matrix)
    ends = pa.array(np.arange(0, size * size + 1, size), pa.int32())
    lists = pa.ListArray.from_arrays(ends, pa.array(matrix.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), lists], names=["i", "line"])


def _products(batches: Iterator[pa.RecordBatch], center: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The products of all pairs of centred dimensions, added up over one task, a row for each row of the matrix."""
    total = np.zeros((len(center), len(center)))
    for _, found in _blocks(batches):
        if len(center) in found:
            centred = found[len(center)][1] - center
            total += centred.T @ centred
    yield _lines(total)


def _added(frame: DataFrame, size: int) -> np.ndarray:
    """The sum of the tasks' matrices, entry by entry: size * size rows, however many vectors there are."""
    entries = frame.select("i", F.posexplode("line").alias("j", "value")).groupBy("i", "j").agg(F.sum("value").alias("v"))
    total = np.zeros((size, size))
    for row in entries.collect():
        total[row.i, row.j] = row.v
    return (total + total.T) / 2


def fit(vectors: DataFrame) -> Fit:
    """Rows, mean and covariance of the most common length (of equally common ones the longest).

    The vectors are centred by the whole number next to each mean before they are multiplied. The products are
    then whole numbers, whose sums don't depend on the order of tasks, and what this center leaves of the mean, half
    a unit at most, is taken off afterwards in extended precision.
    """
    halves = map_in_arrow(vectors, _sum, "dims int, i int, high long, low long").groupBy("dims", "i")
    halves = halves.agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    counts = halves.where("i = dims").orderBy(F.desc("high"), F.desc("low"), F.desc("dims")).first()
    if counts is None:
        return Fit(0, [], [], np.zeros((0, 0), np.longdouble))
    dims, n = counts.dims, (counts.high << 32) + counts.low
    sums = [0] * dims
    for row in halves.where((F.col("dims") == dims) & (F.col("i") < dims)).collect():
        sums[row.i] = (row.high << 32) + row.low
    center = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, center, strict=True)]
    lines = map_in_arrow(vectors, partial(_products, center=np.array(center, float)), "i int, line array<double>")
    products = _added(lines, dims).astype(np.longdouble)
    left = np.array(rest, np.longdouble) / np.longdouble(n)
    return Fit(n, center, rest, products / np.longdouble(n) - np.outer(left, left))


def _orthonormal(vectors: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns made orthonormal in the precision of their type, by Newton's iteration."""
    one = np.eye(vectors.shape[1], dtype=vectors.dtype)
    for _ in range(3):
        vectors = vectors @ (one + (one - vectors.T @ vectors) / 2)
    return vectors


def _turned(matrix: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The span of a cluster by the eigenvectors of the matrix in it, less its mean, so that small gaps keep their digits."""
    inner = vectors.T @ (matrix @ vectors)
    inner = (inner + inner.T) / 2 - np.trace(inner) / len(inner) * np.eye(len(inner), dtype=inner.dtype)
    scale = np.abs(inner).max()
    if scale == 0:
        return vectors
    _, turn = np.linalg.eigh((inner / scale).astype(np.float64))
    return vectors @ _orthonormal(turn[:, ::-1].astype(vectors.dtype))


def refine(matrix: np.ndarray, vectors: np.ndarray, most_steps: int = MOST_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of a symmetric matrix, from approximate eigenvectors.

    Works in the precision of ``matrix``. In one step, with R = I - X'X and S = X'AX, the eigenvalues w are
    S_ii / (1 - R_ii), and X becomes X + X E, where E_ij = (S_ij + w_j R_ij) / (w_j - w_i), or R_ij / 2 for eigenvalues
    that the error of S doesn't keep apart. The vectors of such a cluster are then turned by a sub-solve.
    Steps end where the error is down to rounding or no longer falls.
    """
    kind, dims = matrix.dtype, len(matrix)
    size = np.sqrt((matrix * matrix).sum())
    x, w, best, stuck = vectors.astype(kind), np.zeros(dims, kind), np.inf, 0
    for _ in range(most_steps if size else 0):
        r = np.eye(dims, dtype=kind) - x.T @ x
        s = x.T @ (matrix @ x)
        w = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-w, kind="stable")
        x, w = x[:, order], w[order]
        r, s = r[np.ix_(order, order)], s[np.ix_(order, order)]
        off = s - np.diag(np.diag(s))
        error = np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum())
        stuck = stuck + 1 if error > best / 2 else 0
        if error <= size * np.finfo(kind).eps or stuck > 2:
            break
        best = min(best, error)
        first = np.concatenate(([0], np.flatnonzero(w[:-1] - w[1:] > APART * error) + 1))
        cluster = np.searchsorted(first, np.arange(dims), side="right")
        near = cluster[None, :] == cluster[:, None]
        x = x + x @ np.where(near, r / 2, (s + w[None, :] * r) / np.where(near, 1, w[None, :] - w[:, None]))
        for group in np.split(np.arange(dims), first[1:]):
            if len(group) > 1:
                x[:, group] = _turned(matrix, _orthonormal(x[:, group]))
    return w, _orthonormal(x)


def components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors; of each vector, the largest entry is positive."""
    scale = np.abs(covariance).max() if covariance.size else 0
    if not scale:
        return np.zeros(len(covariance)), np.eye(len(covariance))
    scaled = covariance / scale
    _, rough = np.linalg.eigh(scaled.astype(np.float32))
    _, better = refine(scaled.astype(np.float64), rough[:, ::-1])
    values, vectors = refine(scaled, better)
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(vectors))])
    return values * scale, vectors * signs


def _white(found: dict, fitted: Fit, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, x - center, whitened) of a block."""
    rows, x = found.get(len(fitted.center), (np.zeros(0, np.int64), np.zeros((0, len(fitted.center)))))
    centred = x - np.array(fitted.center, float)
    return rows, centred, (centred - np.array(fitted.rest, float) / fitted.n) @ turn


def _gram(batches: Iterator[pa.RecordBatch], fitted: Fit, turn: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The products of whitened values and, in the last row, their sums and the row count."""
    total = np.zeros((turn.shape[1] + 1,) * 2)
    for _, found in _blocks(batches):
        _, _, white = _white(found, fitted, turn)
        ones = np.column_stack([white, np.ones(len(white))])
        total += ones.T @ ones
    yield _lines(total)


def _apply(batches: Iterator[pa.RecordBatch], fitted: Fit, turn: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each usable vector and component."""
    rest = np.array(fitted.rest, np.int64)
    for batch, found in _blocks(batches):
        rows, centred, white = _white(found, fitted, turn)
        if not len(rows):
            continue
        # Modulo 2**64, the sum of squares is exact wherever it fits a long.
        steps = np.int64(fitted.n) * centred.astype(np.int64) - rest
        deviation = (steps * steps).sum(axis=1)
        about = ((fitted.n * centred - rest) ** 2).sum(axis=1)
        count = turn.shape[1]
        copies = pa.array(np.repeat(rows, count))
        yield pa.RecordBatch.from_arrays(
            [
                *[c.take(copies) for c in batch.columns[:-1]],
                pa.array(np.tile(np.arange(1, count + 1), len(rows)), pa.int32()),
                pa.array(np.repeat(deviation, count), mask=np.repeat(about >= 2.0**63, count)),
                pa.array(white.ravel()),
            ],
            names=[*batch.schema.names[:-1], "component", "deviation", "whitened"],
        )


def whiten(
    frame: DataFrame, *, vector: str = "embedding", count: int = COMPONENTS, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (default: all but the vector), a row for each usable vector and component.

    x is floor(1024 c) + 100,000 of an entry c. Added are ``component`` (1 to ``count``, by falling variance), ``n`` (rows of the
    fit), ``deviation`` (sum of (n x - sum of x)^2), ``whitened`` (x less its mean on the component, over the root of its
    variance), ``explained`` (the component's share of the variance) and ``identity_error`` (how far the covariance of
    ``whitened`` over all rows is from the identity, to 12 places). Jobs run while the result is built.

    Dropped are vectors that are NULL, empty, or hold NULL, NaN or infinite entries, and vectors of another length than
    the most common one. Components without variance are left out, so one vector, or equal ones, give no rows.
    ``deviation`` is NULL where it is too large for a long; entries beyond 2**52 / 1024 count as that. Equal eigenvalues
    (ties) get some orthonormal vectors of their span. Repeated rows and NULL ids stay. Empty tables give no
    rows. Input columns with a result's name are replaced. The driver holds a matrix of dims x dims.
    """
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    base = replace_columns(frame, names)
    keep = [c for c in base.columns if c != vector] if keep is None else [c for c in keep if c in base.columns]
    sent = base.select(*keep, column_or_null(base, vector, "array<double>").alias("_vector"))
    kinds = [LongType(), LongType(), DoubleType(), DoubleType(), DoubleType()]
    schema = StructType(sent.schema.fields[:-1])
    fitted = fit(sent.select("_vector"))
    values, vectors = components(fitted.covariance)
    variance = np.trace(fitted.covariance)
    held = [i for i in range(min(count, len(values))) if values[i] > LEAST_SHARE * variance]
    if not held:
        empty = [StructField("component", IntegerType()), *map(StructField, names[1:], kinds)]
        return frame.sparkSession.createDataFrame([], StructType([*schema.fields, *empty]))
    turn = (vectors[:, held] / np.sqrt(values[held])).astype(np.float64)
    lines = map_in_arrow(sent.select("_vector"), partial(_gram, fitted=fitted, turn=turn), "i int, line array<double>")
    gram = _added(lines, len(held) + 1) / fitted.n
    identity = gram[:-1, :-1] - np.outer(gram[-1, :-1], gram[-1, :-1]) - np.eye(len(held))
    for name, kind in (("component", IntegerType()), ("deviation", LongType()), ("whitened", DoubleType())):
        schema = schema.add(name, kind)
    rows = map_in_arrow(sent, partial(_apply, fitted=fitted, turn=turn), schema)
    shares = [float(values[i] / variance) for i in held]
    return rows.select(
        *keep,
        "component",
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*map(F.lit, shares)), F.col("component")).alias("explained"),
        F.lit(round(float(np.abs(identity).max()), 12)).alias("identity_error"),
    )
