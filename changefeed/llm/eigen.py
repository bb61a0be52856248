"""Leading eigenvalues and eigenvectors of a symmetric matrix.

Householder reflections make the matrix tridiagonal, bisection on Sturm counts
finds the leading eigenvalues, and inverse iteration the vectors, orthogonalised
anew within clusters of close eigenvalues. The matrix has the size of a vector's
width squared, whatever the number of rows it came from.
"""

from __future__ import annotations

import numpy as np

EPSILON = np.finfo(float).eps
#: Eigenvalues closer than this share of the norm are treated as one cluster.
CLUSTER = 1e-3
ROUNDS = 6


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the reflections that led there, first one first."""
    a = np.array(matrix, dtype=float)
    n, reflections = len(a), []
    for k in range(n - 2):
        column = a[k + 1 :, k].copy()
        length = np.linalg.norm(column)
        u = np.zeros(n)
        if np.abs(column[1:]).max() > 0:
            column[0] += length if column[0] >= 0 else -length
            u[k + 1 :] = column / np.linalg.norm(column)
            p = a @ u
            w = p - u * (u @ p)
            a -= 2 * (np.outer(u, w) + np.outer(w, u))
        reflections.append(u)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each number in ``at``, how many eigenvalues are below it."""
    least = max(np.finfo(float).tiny, EPSILON**2 * float(np.abs(beside).max(initial=0)) ** 2)
    q = diagonal[0] - at
    below = (q < 0).astype(int)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < least, -least, q)
        q = diagonal[i] - at - beside[i - 1] ** 2 / q
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, beside: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection of all at once."""
    size = np.abs(beside)
    reach = np.concatenate([size, [0]]) + np.concatenate([[0], size])
    scale = float((np.abs(diagonal) + reach).max())
    low = np.full(count, float((diagonal - reach).min()) - EPSILON * scale)
    high = np.full(count, float((diagonal + reach).max()) + EPSILON * scale)
    # The k-th largest lies where fewer than n - k eigenvalues are below.
    rank = len(diagonal) - np.arange(count)
    for _ in range(200):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        under = sturm_counts(diagonal, beside, middle) >= rank
        high = np.where(under, middle, high)
        low = np.where(under, low, middle)
    return (low + high) / 2


def solve_shifted(diagonal: np.ndarray, beside: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solves (T - shift) y = right by elimination with row exchanges."""
    n = len(diagonal)
    main, upper = diagonal - shift, np.append(beside, 0.0)
    second, y = np.zeros(n), right.copy()
    for i in range(n - 1):
        lower = beside[i]
        if abs(lower) > abs(main[i]):
            main[i], lower = lower, main[i]
            upper[i], main[i + 1] = main[i + 1], upper[i]
            second[i], upper[i + 1] = upper[i + 1], 0.0
            y[i], y[i + 1] = y[i + 1], y[i]
        elif abs(main[i]) < least:
            main[i] = least
        factor = lower / main[i]
        main[i + 1] -= factor * upper[i]
        upper[i + 1] -= factor * second[i]
        y[i + 1] -= factor * y[i]
    if abs(main[-1]) < least:
        main[-1] = least
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            y[i] -= upper[i] * y[i + 1]
        if i + 2 < n:
            y[i] -= second[i] * y[i + 2]
        y[i] /= main[i]
    return y


def leading_vectors(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit eigenvector of the tridiagonal matrix in each column, by inverse iteration."""
    n = len(diagonal)
    norm = float((np.abs(diagonal) + np.append(np.abs(beside), 0) + np.insert(np.abs(beside), 0, 0)).max()) or 1.0
    start = np.random.default_rng(n)
    found = np.zeros((n, len(values)))
    first, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        # Equal eigenvalues are shifted apart a little, lest they give the same vector.
        shift = value if k == first else min(value, shift - 10 * EPSILON * norm)
        vector = start.standard_normal(n)
        for _ in range(ROUNDS):
            for other in found[:, first:k].T:
                vector -= other * (other @ vector)
            vector = solve_shifted(diagonal, beside, shift, vector / np.linalg.norm(vector), EPSILON * norm)
            vector /= np.abs(vector).max()
            for other in found[:, first:k].T:
                vector -= other * (other @ vector)
            vector /= np.linalg.norm(vector)
        found[:, k] = vector
    return found


def leading_pairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and unit eigenvectors as columns.

    Signs, and the choice within a space of equal eigenvalues, are arbitrary but
    the same for the same matrix.
    """
    count = min(count, len(matrix))
    if not count:
        return np.zeros(0), np.zeros((len(matrix), 0))
    scale = float(np.abs(matrix).max()) or 1.0
    diagonal, beside, reflections = tridiagonal(matrix / scale)
    values = leading_values(diagonal, beside, count)
    vectors = leading_vectors(diagonal, beside, values)
    for u in reversed(reflections):
        vectors -= 2 * np.outer(u, u @ vectors)
    return values * scale, vectors
