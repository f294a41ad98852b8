"""Singular values and right singular vectors of a small square matrix.

Householder reflections make it upper bidiagonal, dqds finds the singular values to
nearly full relative accuracy, and a twisted factorisation of B'B - s^2 gives each vector.
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny
CLOSE = 1e-9  # of the largest squared singular value: closer ones get orthogonal vectors


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(u, beta) such that x - beta u (u'x) is zero but for its first entry."""
    norm = float(np.linalg.norm(x))
    u = x.copy()
    if norm == 0.0:
        return u, 0.0
    u[0] += math.copysign(norm, x[0])
    return u, 2.0 / float(u @ u)


def bidiagonalised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, float]]]:
    """(diagonal, superdiagonal, right reflectors by their first column)."""
    a = matrix.astype(float).copy()
    d = len(a)
    right: list[tuple[int, np.ndarray, float]] = []
    for k in range(d):
        u, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(u, u @ a[k:, k:])
        if k < d - 2:
            u, beta = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ u, u)
            right.append((k + 1, u, beta))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform, and the least of its d; None where the shift is too large."""
    qq, ee = [], []
    d = q[0] - shift
    least = d
    for i in range(len(e)):
        if d < 0.0:
            return None
        pivot = d + e[i]
        ratio = q[i + 1] / pivot if pivot > TINY else 0.0
        qq.append(pivot)
        ee.append(e[i] * ratio)
        d = (d * ratio if pivot > TINY else q[i + 1]) - shift
        least = min(least, d)
    if not d >= 0.0:
        return None
    qq.append(d)
    return qq, ee, least


def squared_singular_values(diagonal: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix by dqds, falling."""
    scale = max([*np.abs(diagonal), *np.abs(off), 0.0])
    if scale == 0.0:
        return np.zeros(len(diagonal))
    q = [float(v / scale) ** 2 for v in diagonal]
    e = [float(v / scale) ** 2 for v in off]
    found: list[float] = []
    total, least, sweeps = 0.0, 0.0, 0
    while q:
        small = (10 * EPS) ** 2
        if len(q) == 1 or e[-1] <= small * max(total + q[-1], TINY):
            found.append(total + q.pop())
            if e:
                e.pop()
            least, sweeps = 0.0, 0
            continue
        if 1.5 * q[0] < q[-1]:
            q.reverse()
            e.reverse()
        # The lesser eigenvalue of the last two rows is at least the least of all; what couples
        # them to the rest bounds how much larger it is.
        half = 0.5 * (q[-2] - q[-1] - e[-1])
        corner = q[-1] + e[-1] - q[-2] * e[-1] / (half + math.copysign(math.hypot(half, math.sqrt(q[-2] * e[-1])), half)) if half else q[-1]
        coupled = math.sqrt(q[-2] * e[-2]) if len(q) > 2 else 0.0
        guesses = [s for s in (min(corner - coupled, least), 0.9 * least, 0.25 * least) if s > 0.0]
        step = next((s for s in ((_sweep(q, e, g), g) for g in guesses) if s[0]), None) or (_sweep(q, e, 0.0), 0.0)
        (q, e, least), shift = step
        total += shift
        sweeps += 1
        if sweeps > 10_000:
            raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(found))[::-1] * scale**2


def _twisted(diagonal: np.ndarray, off: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """Unit v with B'B v = value v, orthogonal to ``others``, vectors of values close to it.

    The stationary transform from above and the progressive one from below meet at the row
    with the least residual; close vectors twist elsewhere.
    """
    n = len(diagonal)
    q, e, b = diagonal**2, off**2, diagonal[:-1] * off
    floor = EPS * EPS * max(float(np.max(q)), float(np.max(e, initial=0.0)), TINY)

    def pivot(x: float) -> float:
        return x if abs(x) > floor else math.copysign(floor, x)

    above, below = np.zeros(n), np.zeros(n)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        above[i] = pivot(s[i] + q[i])
        s[i + 1] = e[i] * s[i] / above[i] - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        below[i + 1] = pivot(e[i] + p[i + 1])
        p[i] = p[i + 1] * q[i] / below[i + 1] - value
    gamma = np.abs(s + p + value)
    best, kept = None, -1.0
    for k in np.argsort(gamma, kind="stable")[: 1 + 4 * len(others)].tolist():
        v = np.zeros(n)
        v[k] = 1.0
        for i in range(k - 1, -1, -1):
            v[i] = -b[i] / above[i] * v[i + 1]
        for i in range(k, n - 1):
            v[i + 1] = -b[i] / below[i + 1] * v[i]
        v /= np.linalg.norm(v)
        for _ in range(2):
            for other in others:
                v -= (other @ v) * other
        left = float(np.linalg.norm(v))
        if left > kept:
            best, kept = v / max(left, TINY), left
        if kept > 0.5:
            break
    return best


def leading_directions(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(squared singular values, unit right singular vectors as rows, sum of all squared values).

    Values of zero, up to rounding, have no direction and are left out.
    """
    diagonal, off, right = bidiagonalised(matrix)
    values = squared_singular_values(diagonal, off)
    top = values[0] if len(values) else 0.0
    chosen = [float(v) for v in values[:count] if v > top * (len(values) * EPS) ** 2 and v > 0.0]
    vectors: list[np.ndarray] = []
    for j, value in enumerate(chosen):
        close = [vectors[i] for i in range(j) if chosen[i] - value <= CLOSE * top]
        vectors.append(_twisted(diagonal, off, value, close))
    directions = []
    for v in vectors:
        v = v.copy()
        for first, u, beta in reversed(right):
            v[first:] -= beta * u * (u @ v[first:])
        directions.append(v / np.linalg.norm(v))
    return np.array(chosen), np.array(directions).reshape(len(chosen), len(diagonal)), float(values.sum())
