"""Whitening against exact arithmetic, and refined eigenvectors of matrices that are known."""

import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from rillflow.llm import eigen, whiten

EMBEDDINGS = "vec_id bigint, embedding array<float>"


def orthogonal(size, seed):
    """An orthogonal matrix to extended precision."""
    x = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0].astype(np.longdouble)
    for _ in range(3):
        x = x + x @ (np.eye(size) - x.T @ x) / 2
    return x


def known(values, seed=1):
    values = np.array(values, np.longdouble)
    x = orthogonal(len(values), seed)
    return x, (x * values) @ x.T


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 1], [1e6, 1, 1e-3, 1e-6], list(range(64, 0, -1)), [5, 5 - 1e-5, 5 - 2e-5, 1],
    [3, 3 - 1e-7, 3 - 2e-7, 3 - 3e-7, 1, 1 - 1e-8, 0.5], [1 + 1e-9, 1, 1 - 1e-9, 1 - 2e-9],
    [2, 1e-3, 1e-3 - 1e-9, 1e-3 - 2e-9, 0],
])
def test_refined_vectors_are_the_known_ones(values):
    x, matrix = known(values)
    found, vectors = eigen.eigen(matrix)
    assert np.abs(found - np.array(values, np.longdouble)).max() < 1e-17 * max(values)
    gaps = np.abs(np.subtract.outer(np.array(values), np.array(values)))
    least = (gaps + np.diag([np.inf] * len(values))).min()
    # What rounding of the matrix itself leaves open.
    assert np.abs(np.abs((x * vectors).sum(0)) - 1).max() < 1e-15
    off = np.abs(x.T @ vectors) - np.eye(len(values))
    assert np.abs(off).max() < max(1e-16, 1e-16 * max(values) / least)


@pytest.mark.parametrize("values", [[4, 4, 4, 1], [1, 1, 1], [0, 0, 0], [2, 0, 0, 0], [7]])
def test_repeated_eigenvalues(values):
    _, matrix = known(values)
    found, vectors = eigen.eigen(matrix)
    assert np.abs(found - values).max() < 1e-17 * max(max(values), 1)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-17
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-17 * max(max(values), 1)


def test_single_precision_alone_is_worse():
    _, matrix = known([3, 3 - 1e-7, 3 - 2e-7, 3 - 3e-7, 1, 1 - 1e-8, 0.5])
    rough = np.linalg.eigh(matrix.astype(np.float32))[1].astype(np.longdouble)
    inner = rough.T @ matrix @ rough
    assert np.abs(inner - np.diag(inner.diagonal())).max() > 1e-8
    fine = eigen.eigen(matrix)[1]
    inner = fine.T @ matrix @ fine
    assert np.abs(inner - np.diag(inner.diagonal())).max() < 1e-17


def rows_of(seed, count, size=6):
    random = np.random.default_rng(seed)
    table = (random.normal(size=(count, size)) @ random.normal(size=(size, size))).astype(np.float32)
    return [(i, [float(c) for c in v]) for i, v in enumerate(table)]


def stepped(vector):
    return tuple(math.floor(256 * float(c)) for c in vector)


def check(rows, out):
    """Counts and deviations exactly, the rest against NumPy on the exact covariance."""
    usable = [
        (i, stepped(v)) for i, v in rows
        if v is not None and v and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = sorted({x for _, x in usable})
    n, size = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(size)]
    away = [[n * x[k] - s[k] for k in range(size)] for x in fit]
    exact = [[Fraction(sum(a[i] * a[j] for a in away), n**3) for j in range(size)] for i in range(size)]
    values, vectors = np.linalg.eigh(np.array(exact, float))
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    kept = min(4, size)
    assert len(out) == kept * len(usable)
    signs = {}
    got = Counter()
    for r in out:
        got[(r["vec_id"], r["component"], r["n"], r["deviation"])] += 1
        k = r["component"] - 1
        assert r["explained"] == pytest.approx(values[k] / float(sum(exact[i][i] for i in range(size))), rel=1e-9)
        assert r["identity_error"] < 1e-9
    wanted = Counter()
    for i, x in usable:
        for k in range(kept):
            wanted[(i, k + 1, n, sum((n * x[d] - s[d]) ** 2 for d in range(size)))] += 1
    assert got == wanted
    by_row = {}
    for r in out:
        by_row.setdefault((r["vec_id"], r["component"]), set()).add(r["whitened"])
    for i, x in usable:
        for k in range(kept) if i is not None else ():
            centred = [float(Fraction(n * x[d] - s[d], n)) for d in range(size)]
            value = float(np.dot(centred, vectors[:, k])) / math.sqrt(values[k])
            (mine,) = by_row[(i, k + 1)]
            if abs(value) > 1e-3:
                sign = signs.setdefault(k, 1 if mine * value > 0 else -1)
                assert mine == pytest.approx(sign * value, rel=1e-9, abs=1e-9)


def test_whitening_equals_exact_arithmetic(spark):
    rows = rows_of(1, 200)
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6),
           (903, [1.0, 2.0, 3.0, 4.0, 5.0, float("-inf")]), (904, [])]
    again = [(300 + i, rows[0][1]) for i in range(400)] + [rows[3], rows[3]]
    data = rows + bad + again
    more = [(*r, "clash", i, 1) for i, r in enumerate(data)]
    df = spark.createDataFrame(more, f"{EMBEDDINGS}, x string, n int, component int").repartition(5)
    check(data, whiten.whiten(spark, df).collect())


def test_few_dimensions_and_null_ids(spark):
    rows = rows_of(2, 50, 3) + [(None, [0.5, 0.25, -3.0])]
    check(rows, whiten.whiten(spark, spark.createDataFrame(rows, EMBEDDINGS)).collect())


def test_large_values_stay_exact(spark):
    rows = [(i, [float(np.float32(c * 2e5)) if k == 0 else c for k, c in enumerate(v)]) for i, v in rows_of(3, 10, 4)]
    check(rows, whiten.whiten(spark, spark.createDataFrame(rows, EMBEDDINGS)).collect())


def test_deviations_beyond_64_bits_are_null(spark):
    rows = [(0, [1e15, 1.0]), (1, [-1e15, 2.0]), (2, [0.0, 3.0]), (3, [1e30, 5.0])]
    out = whiten.whiten(spark, spark.createDataFrame(rows, EMBEDDINGS)).collect()
    assert len(out) == 8 and all(r["deviation"] is None for r in out)


def test_components_without_variance(spark):
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(10)]
    out = whiten.whiten(spark, spark.createDataFrame(rows, EMBEDDINGS)).collect()
    assert {(r["component"], r["whitened"] is None) for r in out} == {(1, False), (2, True), (3, True)}
    assert all(r["identity_error"] < 1e-12 for r in out)
    one = whiten.whiten(spark, spark.createDataFrame([(1, [1.0, 2.0])] * 3, EMBEDDINGS)).collect()
    assert len(one) == 6
    for r in one:
        assert (r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (
            1, 0, None, 0.0, None)


def test_other_dimensions_are_left_out(spark):
    rows = rows_of(4, 40) + [(500, [1.0, 2.0]), (501, [1.0] * 7)]
    out = whiten.whiten(spark, spark.createDataFrame(rows, EMBEDDINGS)).collect()
    check(rows[:40], out)


def test_empty_table(spark):
    df = spark.createDataFrame([], EMBEDDINGS)
    assert whiten.whiten(spark, df).collect() == []
    assert whiten.whiten(spark, spark.createDataFrame([(1, None)], EMBEDDINGS)).count() == 0
