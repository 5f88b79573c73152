"""Leading eigenpairs of a symmetric matrix that fits one machine.

Householder reflections make the matrix tridiagonal, counts of sign changes
(Sturm) bisect the leading eigenvalues, inverse iteration gives the vectors of the
tridiagonal matrix.  Vectors of eigenvalues that lie close together are made
orthogonal again at every step, then all are reflected back.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
NEAR = 1e-3          # eigenvalues closer than this share of the norm form a cluster
STEPS = 6            # inverse iterations per vector


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, reflectors): row k of the last is the unit vector of step k, or zero."""
    a = np.array(matrix, dtype=float)
    size = len(a)
    mirrors = np.zeros((max(0, size - 2), size))
    for k in range(size - 2):
        column = a[k + 1:, k]
        longest = np.abs(column).max()
        if longest == 0 or np.abs(column[1:]).max() == 0:
            continue
        v = column / longest
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        mirrors[k, k + 1:] = v
        rest = a[k + 1:, k + 1:]
        image = rest @ v
        image -= (v @ image) * v
        rest -= 2 * (np.outer(v, image) + np.outer(image, v))
        a[k + 1:, k] -= 2 * v * (v @ column)
        a[k, k + 1:] = a[k + 1:, k]
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each point of ``at``."""
    smallest = EPS * max(np.abs(off).max(initial=0.0), np.abs(diagonal).max(initial=0.0), 1e-290)
    found = np.zeros(len(at), dtype=np.int64)
    pivot = np.ones(len(at))
    squares = np.concatenate([[0.0], off * off])
    for value, square in zip(diagonal, squares):
        pivot = (value - at) - square / pivot
        pivot = np.where(np.abs(pivot) < smallest * EPS, -smallest * EPS, pivot)
        found += pivot < 0
    return found


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection down to neighbouring doubles or so."""
    size = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    slack = 2 * EPS * size * max(abs(low[0]), abs(high[0])) + 1e-300
    low, high = low - slack, high + slack
    wanted = size - np.arange(count)         # so many eigenvalues lie at or below the k-th largest
    for _ in range(1100):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = below(diagonal, off, middle) >= wanted
        high = np.where(above, middle, high)
        low = np.where(above, low, middle)
    return low + (high - low) / 2


def _factors(diagonal: np.ndarray, off: np.ndarray, at: float, tiny: float):
    """The shifted matrix as pivoted triangular factors: (rows of the upper one, multipliers, exchanges)."""
    size = len(diagonal)
    upper = np.zeros((size, 3))
    multiplier, swapped = np.zeros(size), np.zeros(size, dtype=bool)
    row = [diagonal[0] - at, off[0] if size > 1 else 0.0, 0.0]
    for k in range(size - 1):
        following = [off[k], diagonal[k + 1] - at, off[k + 1] if k + 2 < size else 0.0]
        if abs(following[0]) > abs(row[0]):
            row, following = following, row
            swapped[k] = True
        if row[0] == 0:
            row[0] = tiny
        multiplier[k] = following[0] / row[0]
        upper[k] = row
        row = [following[1] - multiplier[k] * row[1], following[2] - multiplier[k] * row[2], 0.0]
    upper[size - 1] = [row[0] if row[0] else tiny, 0.0, 0.0]
    return upper, multiplier, swapped


def _solved(factors, right: np.ndarray, tiny: float) -> np.ndarray:
    upper, multiplier, swapped = factors
    x = right.copy()
    size = len(x)
    for k in range(size - 1):
        if swapped[k]:
            x[k], x[k + 1] = x[k + 1], x[k]
        x[k + 1] -= multiplier[k] * x[k]
    for k in range(size - 1, -1, -1):
        rest = upper[k, 1] * x[k + 1] if k + 1 < size else 0.0
        rest += upper[k, 2] * x[k + 2] if k + 2 < size else 0.0
        pivot = upper[k, 0]
        x[k] = (x[k] - rest) / (pivot if abs(pivot) > tiny else np.copysign(tiny, pivot))
        if abs(x[k]) > 1e200:                # scale before it overflows; only the direction counts
            x /= abs(x[k])
    return x


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, seed: int = 12) -> np.ndarray:
    """Unit eigenvectors as rows, one for each of the falling ``values``."""
    size = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0.0) + 2 * np.abs(off).max(initial=0.0), 1e-300)
    tiny = EPS * norm
    draw = np.random.default_rng(seed)
    rows = np.zeros((len(values), size))
    start, shift = 0, 0.0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > NEAR * norm:
            start = k
        # equal eigenvalues are set a few roundings apart, so that each solve differs
        shift = min(value, shift - 4 * tiny) if k > start else value
        factors = _factors(diagonal, off, shift, tiny)
        x = draw.standard_normal(size)
        for _ in range(STEPS):
            for _twice in range(2):
                x -= rows[start:k].T @ (rows[start:k] @ x)
            x /= np.linalg.norm(x)
            x = _solved(factors, x, tiny)
            x /= np.abs(x).max()
        for _twice in range(2):
            x -= rows[start:k].T @ (rows[start:k] @ x)
            x /= np.linalg.norm(x)
        rows[k] = x
    return rows


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as rows) of the ``count`` largest eigenvalues."""
    size = len(matrix)
    count = min(count, size)
    if count == 0:
        return np.zeros(0), np.zeros((0, size))
    scale = np.abs(matrix).max()
    if scale == 0 or not np.isfinite(scale):
        return np.zeros(count), np.eye(size)[:count]
    diagonal, off, mirrors = tridiagonal(np.asarray(matrix, dtype=float) / scale)
    values = leading_values(diagonal, off, count)
    rows = tridiagonal_vectors(diagonal, off, values)
    for v in mirrors[::-1]:
        rows -= 2 * np.outer(rows @ v, v)
    return values * scale, rows / np.linalg.norm(rows, axis=1, keepdims=True)
