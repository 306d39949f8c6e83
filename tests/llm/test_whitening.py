"""Whitening: against NumPy over all rows, refinement on hard spectra, odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors, count=8):
    """(deviations, whitened up to sign, shares) of whole vectors, by NumPy."""
    x = np.floor(1024 * np.asarray(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1][:count], turn[:, ::-1][:, :count]
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return exact, centred @ turn / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def by_id(rows, name):
    found = {}
    for r in rows:
        found.setdefault(r.vec_id, {})[r.component] = r[name]
    return found


def test_query_equals_numpy(spark, small):
    from tripflow.llm.queries import queries

    table = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    got = queries()["op13_whitening"](spark, small).collect()
    deviation, white, shares = plain([r.embedding for r in table])
    found, exact = by_id(got, "whitened"), by_id(got, "deviation")
    assert len(got) == 8 * len(table) and {r.n for r in got} == {len(table)}
    for k, row in enumerate(table):
        mine = np.array([found[row.vec_id][c] for c in range(1, 9)])
        assert np.allclose(np.abs(mine), np.abs(white[k]), atol=1e-9)
        assert set(exact[row.vec_id].values()) == {deviation[k]}
    assert {r.component: r.explained for r in got} == pytest.approx(dict(enumerate(shares, 1)), rel=1e-9)
    assert max(r.identity_error for r in got) < 1e-9


def test_far_off_center(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 5)) * [1, 2, 3, 4, 5] + 10_000).astype(np.float32).tolist()
    table = spark.createDataFrame(list(enumerate(vectors)), SCHEMA).repartition(4)
    got = whitening.whiten(table).collect()
    deviation, white, _ = plain(vectors)
    found = by_id(got, "whitened")
    assert [set(v.values()).pop() for _, v in sorted(by_id(got, "deviation").items())] == deviation
    assert all(np.allclose(np.abs(list(found[k].values())), np.abs(white[k]), atol=1e-6) for k in found)
    assert got[0].identity_error < 1e-9


@pytest.mark.parametrize("kind", ["spread", "close", "equal", "tiny"])
def test_refinement_beyond_double_precision(kind):
    rng = np.random.default_rng(7)
    dims = 48
    turn, _ = np.linalg.qr(rng.normal(size=(dims, dims)))
    values = np.sort(rng.random(dims))[::-1].copy()
    if kind == "close":
        values[:16], values[20:25] = 1 + 1e-9 * np.arange(16), 0.5 + 1e-13 * np.arange(5)
    elif kind == "equal":
        values[:10], values[20:30] = 1, 0.5
    elif kind == "tiny":
        values = 10.0 ** -np.arange(dims)
    matrix = ((turn * values) @ turn.T).astype(np.longdouble)
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.components(matrix)
    assert np.abs(vectors.T @ vectors - np.eye(dims)).max() < 1e-17
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-17
    assert np.all(found[:-1] >= found[1:])
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-14


def test_float32_vectors_alone_are_not_enough():
    rng = np.random.default_rng(5)
    matrix = np.cov(rng.normal(size=(30, 400)))
    _, rough = np.linalg.eigh(matrix.astype(np.float32))
    values, better = whitening.refine(matrix, rough[:, ::-1])
    error = lambda x: np.abs(x.T @ matrix @ x - np.diag(values)).max()
    assert error(better) < 1e-14 < 1e-8 < error(rough[:, ::-1].astype(float))


def test_unusable_vectors_are_dropped(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [0.5, 0.25], [3.0, 9.0]]
    bad = [None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, float("-inf")], [1.0], [1.0, 2.0, 3.0]]
    rows = list(enumerate(good)) + [(100 + k, v) for k, v in enumerate(bad)] + [(None, good[0]), (0, good[0])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id if r.vec_id is not None else -1, r.component) for r in got) == sorted((i, c) for i in (-1, 0, 0, 1, 2, 3) for c in (1, 2))
    _, white, _ = plain(good + [good[0], good[0]])
    mine = by_id(got, "whitened")
    assert np.allclose(np.abs(list(mine[3].values())), np.abs(white[3]))
    assert {r.n for r in got} == {6}


def test_no_variance_empty_tables_and_large_entries(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for table in (same, same.limit(1), same.limit(0), same.where("false"), same.withColumn("embedding", F.lit(None).cast("array<float>"))):
        got = whitening.whiten(table)
        assert got.columns == names and got.collect() == []
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, -1.0]) for k in range(6)], SCHEMA)
    assert {r.component for r in whitening.whiten(line).collect()} == {1}
    large = spark.createDataFrame([(k, [1e30 * (k % 2), float(k)]) for k in range(4)], SCHEMA)
    got = whitening.whiten(large, count=1).collect()
    assert len(got) == 4 and all(r.deviation is None for r in got) and got[0].identity_error < 1e-6


def test_clashing_and_further_columns(spark):
    table = spark.createDataFrame([(k, [float(k), float(k * k)]) for k in range(9)], SCHEMA)
    extra = table.withColumns({c: F.lit("mine") for c in ("component", "whitened", "n", "i", "line")} | {"tags": F.array(F.lit("x"))})
    got = whitening.whiten(extra).collect()
    assert len(got) == 18 and all(r.i == r.line == "mine" and r.tags == ["x"] and r.n == 9 for r in got)
    long = spark.createDataFrame([(k, np.random.default_rng(k).normal(size=300).tolist()) for k in range(20)], SCHEMA)
    assert whitening.whiten(long, count=3).count() == 60
