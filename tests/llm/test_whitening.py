"""Whitening against numpy and whole-number arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from reelspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n int, X int, w int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1, 1, 1) for i, v in rows], SCHEMA)


def check(out, ids, vectors, tolerance=1e-9):
    x = [[math.floor(1024 * Fraction(float(np.float32(c)))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    d = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(r, sums)] for r in x])
    values, axes = np.linalg.eigh(d.T @ d / n)
    values, axes = values[::-1], axes[:, ::-1]
    count = min(8, d.shape[1])
    rows = sorted(out.collect(), key=lambda r: (r["vec_id"], r["component"]))
    assert [(r["vec_id"], r["component"]) for r in rows] == [(i, k + 1) for i in sorted(ids) for k in range(count)]
    at = {i: k for k, i in enumerate(ids)}
    assert all(r["n"] == n and r["deviation"] == deviation[at[r["vec_id"]]] for r in rows)
    got = np.array([r["whitened"] for r in rows]).reshape(n, count)
    want = (d @ axes[:, :count] / np.sqrt(values[:count]))[[at[i] for i in sorted(ids)]]
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < tolerance
    assert np.allclose([r["explained"] for r in rows[:count]], values[:count] / values.sum(), rtol=1e-9)
    errors = {r["identity_error"] for r in rows}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_given_table(spark):
    source = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = source.collect()
    check(whitening.whiten(source), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_odd_rows(spark):
    random = np.random.default_rng(8)
    good = [(i, [float(c) for c in random.normal(size=4) * 3]) for i in range(60)]
    odd = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0]), (103, [math.nan] * 4), (104, [math.inf] * 4), (105, [1.0])]
    check(whitening.whiten(frame(spark, good + odd)), [i for i, _ in good], [v for _, v in good])
    zero = whitening.whiten(frame(spark, [(1, [0.0] * 3), (None, [0.0] * 3), (1, [0.0] * 3)])).collect()
    assert len(zero) == 9
    assert {tuple(r)[1:] for r in zero} == {(k, 3, 0, None, None, None) for k in (1, 2, 3)}
    assert whitening.whiten(frame(spark, odd[:-1])).count() == 0
    assert whitening.whiten(frame(spark, [])).columns == whitening.whiten(frame(spark, good)).columns


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**30 + 64 * i), float(-(2**12) * (i % 5)), 0.5 * i]) for i in range(50)]
    check(whitening.whiten(frame(spark, rows)), [i for i, _ in rows], [v for _, v in rows], 1e-6)
    far = whitening.whiten(frame(spark, [(1, [1e12, 0.0]), (2, [-1e12, 0.0])])).collect()
    assert {r["deviation"] for r in far} == {None}
    assert sorted(abs(r["whitened"]) for r in far if r["component"] == 1) == pytest.approx([1, 1])


@pytest.mark.parametrize(
    "values",
    [[5, 5, 5, 1, 1 + 1e-9, 1 + 1e-7, 0.5, 0.1], [4, 3, 2, 1, 0, 0, 0, 0], list(np.linspace(1, 1.00001, 8)), [3] * 8, [0] * 8],
)
def test_clustered_eigenvalues(values):
    random = np.random.default_rng(1)
    turn = np.linalg.qr(random.normal(size=(8, 8)))[0].astype(np.longdouble)
    matrix = (turn * np.array(values, dtype=np.longdouble)) @ turn.T
    found, axes = whitening.eigen((matrix + matrix.T) / 2)
    assert np.abs(axes.T @ axes - np.eye(8)).max() < 1e-16
    assert np.abs(matrix @ axes - axes * found).max() < 1e-16
    assert np.abs(found.astype(float) - sorted(values, reverse=True)).max() < 1e-13


def test_float32_alone_would_not_do():
    """The refined vectors are right where those in single precision are not."""
    random = np.random.default_rng(3)
    turn = np.linalg.qr(random.normal(size=(40, 40)))[0].astype(np.longdouble)
    values = np.linspace(2, 1, 40).astype(np.longdouble)
    matrix = (turn * values) @ turn.T
    start = np.linalg.eigh(matrix.astype(np.float32))[1][:, ::-1].astype(np.longdouble)
    off = lambda x: np.abs(matrix @ x - x * (x * (matrix @ x)).sum(axis=0)).max()
    assert off(whitening.eigen(matrix)[1]) < 1e-17 < 1e-9 < off(start)
