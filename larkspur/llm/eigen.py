"""Leading eigenvectors of a symmetric matrix: Householder, Sturm counts, inverse iteration."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and reflectors (one a row) of a similar tridiagonal matrix."""
    a = np.array(matrix, dtype=float)
    n = len(a)
    reflectors = np.zeros((max(0, n - 2), n))
    for k in range(n - 2):
        column = a[k + 1:, k]
        scale = np.abs(column).max()
        # A column without anything to reflect stays as it is.
        if not scale or not np.abs(column[1:]).max():
            continue
        v = column / scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        block = a[k + 1:, k + 1:]
        p = block @ v
        w = 2 * (p - (v @ p) * v)
        block -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] -= 2 * (v @ column) * v
        a[k, k + 1:] = a[k + 1:, k]
        reflectors[k, k + 1:] = v
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix lie below each point (Sturm's sign changes)."""
    tiny = np.finfo(float).tiny / EPS
    squares = np.concatenate(([0.0], off * off))
    count, q = np.zeros(len(points), dtype=np.int64), np.ones(len(points))
    for d, e in zip(diagonal, squares):
        q = d - points - e / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection on counts."""
    n = len(diagonal)
    radius = np.concatenate(([0.0], np.abs(off))) + np.concatenate((np.abs(off), [0.0]))
    span = max(np.abs(diagonal).max(), radius.max(), np.finfo(float).tiny)
    low = np.full(k, (diagonal - radius).min() - 2 * EPS * span)
    high = np.full(k, (diagonal + radius).max() + 2 * EPS * span)
    wanted = n - 1 - np.arange(k)
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high) & (high - low > EPS * np.maximum(np.abs(low), np.abs(high)))
        if not open_.any():
            return middle
        below = count_below(diagonal, off, middle) > wanted
        high, low = np.where(open_ & below, middle, high), np.where(open_ & ~below, middle, low)


def _solver(diagonal: np.ndarray, off: np.ndarray, value: float, span: float):
    """Solves (T - value) x = b by elimination with row exchanges."""
    n = len(diagonal)
    d, up, far = (diagonal - value).tolist(), off.tolist() + [0.0], [0.0] * n
    down, swapped, factor = off.tolist(), [False] * n, [0.0] * n
    small = EPS * span
    for i in range(n - 1):
        if abs(down[i]) > abs(d[i]):
            swapped[i] = True
            d[i], down[i] = down[i], d[i]
            up[i], d[i + 1] = d[i + 1], up[i]
            far[i], up[i + 1] = up[i + 1], 0.0
        if abs(d[i]) < small:
            d[i] = small
        factor[i] = down[i] / d[i]
        d[i + 1] -= factor[i] * up[i]
        up[i + 1] -= factor[i] * far[i]
    if abs(d[-1]) < small:
        d[-1] = small

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.tolist()
        for i in range(n - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factor[i] * x[i]
        for i in reversed(range(n)):
            rest = x[i]
            if i + 1 < n:
                rest -= up[i] * x[i + 1]
            if i + 2 < n:
                rest -= far[i] * x[i + 2]
            x[i] = rest / d[i]
        return np.array(x)

    return solve


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, one a row, by inverse iteration.

    Vectors of values closer than a thousandth of the matrix' size belong to a
    cluster and are made orthogonal to each other in every step; values of a
    cluster that agree are set apart by a few units in the last place.
    """
    n = len(diagonal)
    span = max(np.abs(diagonal).max(), np.abs(off).max() if len(off) else 0.0, np.finfo(float).tiny)
    rng = np.random.default_rng(0)
    vectors, start, before = np.zeros((len(values), n)), 0, np.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * span:
            start = i
        shifted = min(value, before - 4 * EPS * span) if i > start else value
        before = shifted
        solve = _solver(diagonal, off, shifted, span)
        x = rng.uniform(-1, 1, n)
        for _ in range(5):
            for _ in range(2):
                x -= vectors[start:i].T @ (vectors[start:i] @ x)
            x /= np.linalg.norm(x)
            x = solve(x)
            x /= np.abs(x).max()
        for _ in range(2):
            x -= vectors[start:i].T @ (vectors[start:i] @ x)
            x /= np.linalg.norm(x)
        vectors[i] = x
    return vectors


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors, one a row.

    Each vector's entry of greatest size is positive.
    """
    n = len(matrix)
    k = min(k, n)
    size = np.abs(matrix).max() if k else 0.0
    if not size:
        return np.zeros(k), np.eye(k, n)
    diagonal, off, reflectors = tridiagonal(matrix / size)
    values = leading_values(diagonal, off, k)
    vectors = leading_vectors(diagonal, off, values)
    for v in reflectors[::-1]:
        vectors -= 2 * np.outer(vectors @ v, v)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    peak = vectors[np.arange(k), np.abs(vectors).argmax(axis=1)]
    return values * size, vectors * np.sign(peak)[:, None]
