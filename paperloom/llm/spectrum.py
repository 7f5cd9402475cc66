"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The number of positive pivots of LDL' of A - s is the number of eigenvalues above s. Bisecting on that count isolates each
leading eigenvalue, Rayleigh quotient iteration then finds its pair with cubic convergence, and counts on both sides of
the value found certify its number.
"""

from __future__ import annotations

import numpy as np

#: Bunch and Kaufman's bound on a pivot's growth. Fixed value.
ALPHA = (1 + 17**0.5) / 8
EPS = float(np.finfo(float).eps)


def count_above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` exceed ``shift``: the positive part of the inertia of L D L', pivots of one or two rows."""
    m = a - shift * np.eye(len(a))
    positive = 0
    while len(m):
        below = np.abs(m[1:, 0])
        largest = below.max() if len(below) else 0.0
        take = 1
        if largest > 0 and abs(m[0, 0]) < ALPHA * largest:
            r = 1 + int(below.argmax())
            row = np.abs(m[r])
            row[r] = 0.0
            other = row.max()
            if abs(m[0, 0]) * other < ALPHA * largest**2:
                place = 0
                if abs(m[r, r]) < ALPHA * other:
                    take, place = 2, 1
                m[[place, r]] = m[[r, place]]
                m[:, [place, r]] = m[:, [r, place]]
        if take == 1:
            pivot, column = m[0, 0], m[1:, 0]
            positive += bool(pivot > 0)
            m = m[1:, 1:] - np.outer(column, column / pivot) if pivot else m[1:, 1:].copy()
        else:  # a pivot of two rows has one eigenvalue of either sign
            positive += 1
            columns = m[2:, :2]
            m = m[2:, 2:] - columns @ np.linalg.solve(m[:2, :2], columns.T)
    return positive


class Slices:
    """Counts of the eigenvalues above the shifts tried so far."""

    def __init__(self, a: np.ndarray):
        self.a = a
        self.norm = float(np.abs(a).sum(1).max())
        self.tolerance = 4 * len(a) * EPS * self.norm
        self.counts = {-2 * self.norm: len(a), 2 * self.norm: 0}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = count_above(self.a, shift)
        return self.counts[shift]

    def bracket(self, number: int) -> tuple[float, float]:
        """The narrowest known (low, high] with eigenvalue ``number``, counted from the top."""
        return max(s for s, c in self.counts.items() if c >= number), min(s for s, c in self.counts.items() if c < number)

    def isolate(self, number: int) -> tuple[float, float]:
        """Bisect until the interval holds this eigenvalue alone, or several that cannot be told apart."""
        low, high = self.bracket(number)
        while self.counts[low] - self.counts[high] > 1 and high - low > self.tolerance:
            self.above((low + high) / 2)
            low, high = self.bracket(number)
        return low, high

    def certified(self, number: int, value: float) -> bool:
        margin = 2 * self.tolerance
        return self.above(value - margin) >= number and self.above(value + margin) < number


def _refine(slices: Slices, low: float, high: float, found: np.ndarray, start: np.ndarray) -> tuple[float, np.ndarray]:
    """Inverse iteration at the middle of the interval, then Rayleigh quotients; vectors already found are kept out."""
    a, shift, x = slices.a, (low + high) / 2, start
    near = np.eye(len(a))
    value = shift
    for step in range(40):
        x = x - found.T @ (found @ x)
        x /= np.linalg.norm(x)
        value = float(x @ a @ x)
        if step and np.linalg.norm(a @ x - value * x) <= slices.tolerance / 2:
            break
        if step > 1 and low <= value <= high:
            shift = value
        try:
            y = np.linalg.solve(a - shift * near, x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(a - (shift + slices.tolerance) * near, x)
        x = y / np.abs(y).max()
    return value, x / np.linalg.norm(x)


def leading(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The (at most ``most``) largest eigenvalues above rounding, falling, and their unit vectors as rows.

    The largest entry of a vector is positive. Equal eigenvalues get orthogonal vectors of their common space.
    """
    size = len(a)
    values, vectors = [], np.zeros((0, size))
    if not size or not np.abs(a).max():
        return np.zeros(0), vectors
    slices = Slices(a)
    starts = np.random.default_rng(1)
    for number in range(1, min(most, slices.above(slices.tolerance)) + 1):
        low, high = slices.isolate(number)
        for _ in range(60):
            value, x = _refine(slices, low, high, vectors, starts.standard_normal(size))
            if slices.certified(number, value):
                break
            slices.above((low + high) / 2)
            low, high = slices.bracket(number)
        else:
            raise ArithmeticError(f"eigenvalue {number} could not be certified")
        values.append(value)
        vectors = np.vstack([vectors, x * np.sign(x[np.abs(x).argmax()])])
    return np.array(values), vectors
