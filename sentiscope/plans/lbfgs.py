"""L-BFGS whose vectors are sums of gradients, kept as one share per gradient.

The steps and the line search (strong Wolfe conditions, cubic interpolation) are those of the optimiser behind Spark ML's
logistic regression.  It needs of the problem only ``add_gradient(point)`` (inner products of the gradient at a point with all
gradients so far) and ``along(point, way)`` (loss and slope), so the gradients themselves stay where they are.
"""

from __future__ import annotations

import math

import numpy as np

MEMORY, TOLERANCE, VALUES, TRIES = 10, 1e-6, 20, 10
ENOUGH, CURVED = 1e-4, 0.9


class SearchFailed(Exception):
    """No step along a direction, or no direction."""


def _longer(v: np.ndarray, size: int) -> np.ndarray:
    return np.concatenate([v, np.zeros(size - len(v))])


class Search:
    def __init__(self, problem, max_iter: int):
        self.problem, self.max_iter = problem, max_iter
        self.points: list[np.ndarray] = []
        self.gram = np.zeros((0, 0))

    def _dot(self, u: np.ndarray, v: np.ndarray) -> float:
        return float(u @ self.gram[:len(u), :len(v)] @ v)

    def _add(self, point: np.ndarray) -> np.ndarray:
        """The gradient at a point, as shares."""
        products = self.problem.add_gradient(point)
        size = len(products)
        gram = np.zeros((size, size))
        gram[:-1, :-1] = self.gram
        gram[-1, :] = gram[:, -1] = products
        self.gram = gram
        self.points.append(point)
        return np.eye(size)[-1]

    def _direction(self, gradient: np.ndarray, steps: list, changes: list) -> np.ndarray:
        size = len(gradient)
        steps, changes = [_longer(s, size) for s in steps], [_longer(c, size) for c in changes]
        scale = 1.0
        if steps:
            sy, yy = self._dot(steps[0], changes[0]), self._dot(changes[0], changes[0])
            if not sy >= 0 or not yy > 0:
                raise SearchFailed("the history is of no use")
            scale = sy / yy
        way, shares, rhos = gradient.copy(), [], []
        for s, y in zip(steps, changes):
            rhos.append(self._dot(s, y))
            shares.append(self._dot(s, way) / rhos[-1] if rhos[-1] else math.nan)
            if math.isnan(shares[-1]):
                raise SearchFailed("the history is of no use")
            way = way - shares[-1] * y
        way = way * scale
        for s, y, a, rho in reversed(list(zip(steps, changes, shares, rhos))):
            way = way + (a - self._dot(y, way) / rho) * s
        return -way

    def run(self) -> np.ndarray:
        """The last point, as shares of the gradients at ``points``."""
        point, steps, changes, values, failed = np.zeros(0), [], [], [math.inf], False
        gradient = self._add(point)
        value, _ = self.problem.along(_longer(point, 1), np.zeros(1))
        first, point, done = value, _longer(point, 1), 0
        while done < self.max_iter:
            size = math.sqrt(max(self._dot(gradient, gradient), 0.0))
            if size <= max(TOLERANCE * abs(value), 1e-8) or (len(values) >= 2 and abs(value - max(values)) <= TOLERANCE * first):
                break
            try:
                way = self._direction(gradient, steps, changes)
                length = math.sqrt(max(self._dot(way, way), 0.0))
                at, found = self._step(point, way, value, 1.0 if done else 1.0 / length)
                if at * size < 1e-10:
                    raise SearchFailed("the step is too short")
            except SearchFailed:
                if failed:
                    break
                steps, changes, failed = [], [], True
                continue
            failed, done = False, done + 1
            ahead, value = point + at * way, found
            values = [*values, value][-VALUES:]
            if done == self.max_iter:
                point = ahead
                break
            before, gradient = gradient, self._add(ahead)
            n = len(gradient)
            steps = [_longer(ahead - point, n), *steps][:MEMORY]
            changes = [gradient - _longer(before, n), *changes][:MEMORY]
            point = _longer(ahead, n)
        return point

    def _step(self, point: np.ndarray, way: np.ndarray, value: float, t: float) -> tuple[float, float]:
        """A step length that meets the conditions, and the loss there."""
        slope = self._dot(np.eye(len(way))[-1], way)  # the last gradient is that of the point
        if slope > 0:
            raise SearchFailed("uphill")

        def phi(t: float):
            found, dd = self.problem.along(point + t * way, way)
            return t, found, dd

        def zoom(low, high):
            for _ in range(TRIES):
                c = phi(_between(high, low) if low[0] > high[0] else _between(low, high))
                if c[1] > value + ENOUGH * c[0] * slope or c[1] >= low[1]:
                    high = c
                else:
                    if abs(c[2]) <= CURVED * abs(slope):
                        return c[0], c[1]
                    if c[2] * (high[0] - low[0]) >= 0:
                        high = low
                    low = c
            raise SearchFailed("no step between the bounds")

        low = (0.0, value, slope)
        for i in range(TRIES):
            c = phi(t)
            if math.isinf(c[1]) or math.isnan(c[1]):
                t /= 2.0
                continue
            if c[1] > value + ENOUGH * t * slope or (c[1] >= low[1] and i > 0):
                return zoom(low, c)
            if abs(c[2]) <= CURVED * abs(slope):
                return c[0], c[1]
            if c[2] >= 0:
                return zoom(c, low)
            low, t = c, t * 1.5
        raise SearchFailed("no step")


def _between(left, right) -> float:
    """The minimum of the cubic through both ends, not too near to them."""
    (lt, lv, ld), (rt, rv, rd) = left, right
    d1 = ld + rd - 3 * (lv - rv) / (lt - rt)
    root = d1 * d1 - ld * rd
    d2 = math.sqrt(root) if root >= 0 else math.nan
    t = rt - (rt - lt) * (rd + d2 - d1) / (rd - ld + 2 * d2)
    low, high = lt + 0.1 * (rt - lt), lt + 0.9 * (rt - lt)
    return low if t < low else high if t > high else t
