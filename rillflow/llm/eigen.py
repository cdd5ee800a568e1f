"""Eigenvectors of a symmetric matrix by mixed-precision refinement.

Eigenvectors in single precision are corrected by the iterations of Ogita and Aishima, which are
matrix products in extended precision and converge quadratically. Eigenvalues that lie too close
to be told apart are a cluster: the matrix is shifted by their mean, restricted to their subspace
and solved again by the same method, where their differences are no longer small.
"""

from __future__ import annotations

import numpy as np

WIDE = np.longdouble
STEPS = 40
# A pair is corrected by itself when its gap is so many times what is still wrong; closer ones
# would be turned too far in one step.
MARGIN = 16
# How often a cluster may be solved anew; each time its width shrinks by the single precision.
DEPTH = 6
SOLVES = 3


def _norm(matrix: np.ndarray) -> np.longdouble:
    return np.sqrt((matrix * matrix).sum())


def _clusters(values: np.ndarray, apart: np.longdouble) -> list[np.ndarray]:
    """Indices of eigenvalues in runs whose neighbours are at most ``apart``; runs of two or more."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def _start(matrix: np.ndarray, scale: np.longdouble) -> np.ndarray:
    """Eigenvectors in single precision."""
    return np.linalg.eigh((matrix / scale).astype(np.float32))[1].astype(WIDE)


def _solve(matrix: np.ndarray, noise: np.longdouble, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors; values closer than ``noise`` are taken as one."""
    size = len(matrix)
    largest = np.abs(matrix).max(initial=0)
    if size == 1 or largest <= noise:
        return matrix.diagonal().copy(), np.eye(size, dtype=WIDE)
    vectors, one = _start(matrix, largest), np.eye(size, dtype=WIDE)
    norm, last, pairs, solved = _norm(matrix), np.inf, 0, 0
    for _ in range(STEPS):
        off = one - vectors.T @ vectors
        inner = vectors.T @ matrix @ vectors
        # Rounding must not differ on the two sides of the diagonal: a small gap would enlarge it.
        off, inner = (off + off.T) / 2, (inner + inner.T) / 2
        values = inner.diagonal() / (1 - off.diagonal())
        rest = inner - np.diag(inner.diagonal())
        apart = MARGIN * (2 * (_norm(rest) + norm * _norm(off)) + noise)
        gap = values[None, :] - values[:, None]
        told = np.abs(gap) > apart
        change = np.where(
            told, (inner + values[None, :] * off) / np.where(told, gap, 1), off / 2
        )
        step = np.abs(change).max()
        vectors = vectors + vectors @ change
        if step > np.finfo(WIDE).eps * size and (step < last / 2 or told.sum() > pairs):
            last, pairs = step, told.sum()
            continue
        # What can be told apart has converged; the clusters are solved in their own subspaces.
        runs = _clusters(values, apart)
        if not runs or solved == SOLVES or depth == 0:
            break
        for run in runs:
            part = vectors[:, run]
            middle = values[run].mean()
            inside = part.T @ (matrix @ part) - middle * (part.T @ part)
            vectors[:, run] = part @ _solve((inside + inside.T) / 2, noise, depth - 1)[1]
        solved, last = solved + 1, np.inf
    inner = (vectors * (matrix @ vectors)).sum(0)
    return inner / (vectors * vectors).sum(0), vectors


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns, both in extended precision.

    The largest entry of each vector is positive. Eigenvalues that differ by less than the
    extended precision of the largest have some basis of their subspace.
    """
    matrix = np.asarray(matrix, WIDE)
    matrix = (matrix + matrix.T) / 2
    noise = np.finfo(WIDE).eps * _norm(matrix) * 4
    values, vectors = _solve(matrix, noise, DEPTH)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    vectors = vectors / np.sqrt((vectors * vectors).sum(0))
    largest = vectors[np.abs(vectors).argmax(0), np.arange(len(values))]
    return values, vectors * np.where(largest < 0, -1, 1)
