"""Geometry that column expressions cannot express: vectorised over Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

LINE = "array<array<double>>"


def _points(value) -> np.ndarray:
    return np.array([list(p) for p in value], float).reshape(-1, len(value[0])) if len(value) else np.empty((0, 2))


def simplified(points: np.ndarray, tolerance: float) -> np.ndarray:
    """The points that D. Douglas and T. Peucker's method (1973) keeps; a stack instead of recursion."""
    n = len(points)
    keep = np.zeros(n, bool)
    keep[[0, -1]] = True
    held = [(0, n - 1)]
    while held:
        a, b = held.pop()
        if b - a < 2:
            continue
        p, q, inner = points[a, :2], points[b, :2], points[a + 1 : b, :2]
        along = q - p
        norm = float(along @ along)
        t = np.clip(((inner - p) @ along) / norm, 0, 1) if norm else np.zeros(len(inner))
        d = np.hypot(*(inner - (p + t[:, None] * along)).T)
        i = int(d.argmax())
        if d[i] > tolerance:
            keep[a + 1 + i] = True
            held += [(a, a + 1 + i), (a + 1 + i, b)]
    return points[keep]


def simplify(tolerance: float):
    """A function of a line column: the line without points that lie within the tolerance."""

    @F.pandas_udf(LINE)
    def run(lines: pd.Series) -> pd.Series:
        return lines.map(lambda v: None if v is None else simplified(_points(v), tolerance).tolist() if len(v) > 2 else [list(p) for p in v])

    return run


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, counter-clockwise (A. Andrew's monotone chain, 1979)."""
    order = sorted({(float(x), float(y)) for x, y, *_ in points})
    if len(order) < 3:
        return np.array(order).reshape(-1, 2)

    def chain(ps):
        out: list = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out

    return np.array(chain(order)[:-1] + chain(order[::-1])[:-1])


def area_centre(ring: np.ndarray) -> tuple[float, float]:
    """Area centroid of an open ring; the mean point where the area is 0."""
    x, y = ring[:, 0], ring[:, 1]
    x1, y1 = np.roll(x, -1), np.roll(y, -1)
    cross = x * y1 - x1 * y
    if abs(cross.sum()) < 1e-12:
        return float(x.mean()), float(y.mean())
    return float(((x + x1) * cross).sum() / (3 * cross.sum())), float(((y + y1) * cross).sum() / (3 * cross.sum()))


def hull_centre(points):
    """Centroid of the convex hull of a point array column."""

    @F.pandas_udf("array<double>")
    def run(points: pd.Series) -> pd.Series:
        return points.map(lambda v: None if v is None or not len(v) else list(area_centre(hull(_points(v)))))

    return run(points)


def hausdorff(a, b):
    """Largest distance from a point of either array column to the nearest of the other."""

    def one(p, q):
        if p is None or q is None or not len(p) or not len(q):
            return None
        d = np.hypot(*(_points(p)[:, None, :2] - _points(q)[None, :, :2]).transpose(2, 0, 1))
        return float(max(d.min(axis=1).max(), d.min(axis=0).max()))

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([one(p, q) for p, q in zip(a, b, strict=True)], dtype="float64")

    return run(a, b)
