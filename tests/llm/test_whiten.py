"""Whitening against dense double precision, and eigenvectors of hard matrices against their definition."""

import math

import numpy as np
import pytest

from millrace.llm import whiten
from millrace.llm.queries import QUERIES


def brute(vectors):
    """(rows of whole numbers, distinct ones, eigenvalues, eigenvectors) in plain numpy."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors])
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    e, q = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, fit, e[::-1], q[:, ::-1]


def test_query(spark, data):
    given = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    ids = [r.vec_id for r in given]
    x, fit, e, q = brute([r.embedding for r in given])
    z = (x - fit.mean(axis=0)) @ q / np.sqrt(e)
    sums, n = fit.sum(axis=0), len(fit)
    rows = QUERIES["op12_whitening"](spark, data).collect()
    assert len(rows) == 16 * len(ids)
    got = {(r.vec_id, r.component): r for r in rows}
    for j in range(1, 17):
        mine = np.array([got[i, j].whitened for i in ids])
        sign = np.sign(mine @ z[:, j - 1])
        assert np.abs(mine * sign - z[:, j - 1]).max() < 1e-9
        assert abs(got[ids[0], j].explained - e[j - 1] / e.sum()) < 1e-12
    deviation = {i: sum(int(d) ** 2 for d in n * row - sums) for i, row in zip(ids, x)}
    assert all(r.deviation == deviation[r.vec_id] and r.n == n and r.identity_error < 1e-9 for r in rows)


def test_odd_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 5), i / 7, -i / 3, 0.25], i) for i in range(60)]
    rows += [(5, [float(0), 5 / 7, -5 / 3, 0.25], 5)] * 30  # repeated: one vector in the fit
    dropped = [(100, None, 1), (101, [], 1), (102, [1.0, None, 2.0, 3.0], 1), (103, [1.0, nan, 2.0, 3.0], 1), (104, [inf, 1.0, 1.0, 1.0], 1), (105, [1.0, 2.0], 1)]
    rows += [(None, [9.0, 9.0, 9.0, 9.0], None)]
    names = "vec_id bigint, embedding array<double>, whitened int"
    spark.createDataFrame(rows + dropped, names).write.parquet(f"{tmp_path}/a/embeddings.parquet")
    got = QUERIES["op12_whitening"](spark, f"{tmp_path}/a").collect()
    x, fit, e, q = brute([v for _, v, _ in rows])
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {len(fit)} and {r.component for r in got} == {1, 2, 3, 4}
    assert not {r.vec_id for r in got} & set(range(100, 106))
    flat = [r for r in got if r.component == 4]
    assert all(r.whitened is not None for r in flat) == (e[3] > 1e-9)
    assert all(r.identity_error < 1e-9 for r in got)
    spark.createDataFrame(rows[:0], names).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    assert QUERIES["op12_whitening"](spark, f"{tmp_path}/b").collect() == []
    spark.createDataFrame(rows[:1], names).write.parquet(f"{tmp_path}/c/embeddings.parquet")
    assert [(r.n, r.whitened, r.explained, r.deviation) for r in QUERIES["op12_whitening"](spark, f"{tmp_path}/c").collect()] == [(1, None, None, 0)] * 4


def test_result_does_not_depend_on_layout(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet")
    models = [whiten.fit(table.repartition(k)) for k in (1, 7)]
    assert np.array_equal(models[0].vectors, models[1].vectors) and np.array_equal(models[0].values, models[1].values)


def test_large_deviation_is_null(spark):
    table = spark.createDataFrame([(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 2.0])], "vec_id int, embedding array<double>")
    got = whiten.apply(table, whiten.fit(table), ["vec_id"]).collect()
    assert {r.vec_id for r in got if r.deviation is None} == {1, 2}


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1, 33.0), np.ones(32), [1] * 10 + [2] * 20 + [3] * 34, 1 + 1e-9 * np.arange(64),
        [5, 5 + 1e-13, 5 + 2e-13, 1, 1, 0, 0, 0], 10.0 ** -np.arange(12), [0.0, 0.0], [3.0],
        np.concatenate([1 + 1e-6 * np.arange(10), 1 + 1e-12 * np.arange(10), np.linspace(0, 1, 40)]),
    ],
)
def test_eigenvectors(values):
    draw, d = np.random.default_rng(1), len(values)
    q = np.linalg.qr(draw.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(d) - q.T @ q) / 2
    a = (q * np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    e, x = whiten.eigen(a)
    scale = max(np.abs(values).max(), 1e-300)
    assert np.abs(a @ x - x * e).max() < 1e-16 * scale
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-16
    assert np.abs(e - np.sort(np.array(values, np.longdouble))[::-1]).max() < 1e-16 * scale
