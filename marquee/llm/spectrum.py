"""Eigendecompositions kept up to date by rank-one updates.

A ``Spectrum`` holds the number of vectors seen, their mean, and the eigenvalues and eigenvectors of their
scatter (the sum of the squares of what lies off the mean). One more vector changes the scatter by a single
square: the new eigenvalues are the roots of a secular equation, one between each two old ones, found for all
at once by rational steps inside brackets. Directions that the vector does not touch, and repeated eigenvalues,
turned so that only one of them is touched, are deflated: they stay as they are. The vectors follow from the
roots by recomputed weights (Gu and Eisenstat), which keeps them orthogonal.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
_STEPS = 60


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum(weights / (poles - x)), and the matrix of poles less roots.

    ``poles`` rise strictly and ``weights`` are positive, so the k-th root lies above the k-th pole and below the
    next (the last: below the pole and all weights together). A root is sought as its distance from the nearer
    pole, so differences keep their digits.
    """
    m = len(poles)
    upper = np.append(poles[1:], poles[-1] + weights.sum() * (1 + m * _EPS))
    middle = (upper - poles) / 2
    at_middle = 1 + (weights / (poles - poles[:, None] - middle[:, None])).sum(1)
    from_left = (at_middle >= 0) | (np.arange(m) == m - 1)
    origin = np.where(from_left, poles, upper)
    distance = poles - origin[:, None]
    left, right = poles - origin, upper - origin
    low, high = np.where(from_left, np.where(at_middle >= 0, left, middle), left + middle), np.where(at_middle >= 0, np.where(from_left, middle, right - middle), right)
    x = (low + high) / 2
    own = np.tri(m, dtype=bool)
    for _ in range(_STEPS):
        away = distance - x[:, None]
        terms = weights / away
        f = 1 + terms.sum(1)
        done = np.abs(f) <= 4 * _EPS * (1 + np.abs(terms).sum(1))
        if done.all():
            break
        slopes = terms / away
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        # The two poles around the root carry the curve; the rest is taken as constant.
        below = np.where(own, slopes, 0).sum(1)
        above = slopes.sum(1) - below
        to_left, to_right = left - x, right - x
        c = f - to_left * below - to_right * above
        a = (to_left + to_right) * f - to_left * to_right * (below + above)
        b = to_left * to_right * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # Above the last pole there is no other: the curve of this one alone.
            step[-1] = to_left[-1] + to_left[-1] ** 2 * below[-1] / (f[-1] - to_left[-1] * below[-1])
        new = x + step
        wrong = ~((new > low) & (new < high))
        new[wrong] = ((low + high) / 2)[wrong]
        x = np.where(done, x, new)
    return origin + x, (distance - x[:, None]).T


def rank_one_update(values: np.ndarray, vectors: np.ndarray, direction: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """The decomposition after weight * direction * direction' is added; values rise."""
    z = vectors.T @ direction * np.sqrt(weight)
    length = float(np.sqrt(z @ z))
    if not length > 0:
        return values, vectors
    tiny = 8 * _EPS * max(float(values[-1]), length * length)
    vectors = vectors.copy()
    bounds = [0, *(np.flatnonzero(np.diff(values) > tiny) + 1).tolist(), len(values)]
    if len(bounds) <= len(values):
        for a, b in zip(bounds, bounds[1:]):
            size = float(np.sqrt(z[a:b] @ z[a:b])) if b - a > 1 else 0.0
            if size > 0:
                mirror = z[a:b].copy()
                sign = 1.0 if mirror[-1] >= 0 else -1.0
                mirror[-1] += sign * size
                vectors[:, a:b] -= np.outer(vectors[:, a:b] @ mirror, mirror * (2 / (mirror @ mirror)))
                z[a:b] = 0
                z[b - 1] = -sign * size
    live = np.flatnonzero(np.abs(z) * length > tiny)
    if not len(live):
        return values, vectors
    poles = values[live]
    roots, away = secular_roots(poles, z[live] ** 2)
    gaps = poles[:, None] - poles
    np.fill_diagonal(gaps, -1.0)
    recomputed = np.sqrt(np.abs((away / gaps).prod(1))) * np.sign(z[live])
    turn = recomputed[:, None] / away
    turn /= np.sqrt((turn * turn).sum(0))
    values = values.copy()
    values[live] = roots
    vectors[:, live] = vectors[:, live] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    def __init__(self, dimension: int) -> None:
        self.count = 0
        self.mean = np.zeros(dimension)
        self.values = np.zeros(dimension)
        self.vectors = np.eye(dimension)

    def add(self, vector: np.ndarray, times: int = 1) -> None:
        """Take in a vector that occurs so many times."""
        off, total = vector - self.mean, self.count + times
        if self.count:
            self.values, self.vectors = rank_one_update(self.values, self.vectors, off, self.count / total * times)
        self.mean = self.mean + off * (times / total)
        self.count = total

    def join(self, other: Spectrum) -> None:
        """Take in all that another one has seen: its squares one by one, then that of the way between the means."""
        if not other.count:
            return
        for value, direction in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one_update(self.values, self.vectors, direction, float(value))
        off, total = other.mean - self.mean, self.count + other.count
        if self.count:
            self.values, self.vectors = rank_one_update(self.values, self.vectors, off, self.count / total * other.count)
        self.mean = self.mean + off * (other.count / total)
        self.count = total
