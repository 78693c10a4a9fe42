"""NumPy kernels for one scene in memory: components, contours, ellipses, hulls, distances, textures."""

from __future__ import annotations

import numpy as np

#: Steps of a chamfer distance over 3 x 3 pixels: along an axis, and diagonal.
CHAMFER = (0.955, 1.3693)


def components(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """8-connected components of True, numbered from 1 by their first pixel in raster order.

    Rows are taken as runs; runs of neighbouring rows that touch are united.
    """
    h, w = mask.shape
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, start = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    n = len(row)
    up = np.arange(n)

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    begin = np.searchsorted(row, np.arange(h + 1))
    for y in range(1, h):
        a, b = begin[y - 1], begin[y]
        while a < begin[y] and b < begin[y + 1]:
            if start[a] <= end[b] and start[b] <= end[a]:
                i, j = root(a), root(b)
                up[max(i, j)] = min(i, j)
            if end[a] < end[b]:
                a += 1
            else:
                b += 1
    roots = np.array([root(i) for i in range(n)], dtype=np.int64)
    kinds, number = np.unique(roots, return_inverse=True)
    out = np.zeros((h, w), dtype=np.int32)
    for y, s, e, k in zip(row, start, end, number, strict=True):
        out[y, s:e] = k + 1
    return out, len(kinds)


#: Neighbours in clockwise order from the west.
AROUND = ((0, -1), (-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1))


def contour(mask: np.ndarray) -> np.ndarray:
    """The outer boundary of the component with the first pixel in raster order, as (x, y) of pixel centres, by Moore tracing."""
    at = np.argwhere(mask)
    if not len(at):
        return np.empty((0, 2), dtype=np.int64)
    padded = np.pad(mask, 1)
    here = first = (int(at[0][0]) + 1, int(at[0][1]) + 1)
    back, out, begun = 0, [], None
    while True:
        for k in range(1, 9):
            d = (back + k) % 8
            y, x = here[0] + AROUND[d][0], here[1] + AROUND[d][1]
            if padded[y, x]:
                break
        else:
            return np.array([[first[1] - 1, first[0] - 1]])
        if here == first and begun is None:
            begun = d
        elif here == first and d == begun:
            return np.array(out)
        out.append((here[1] - 1, here[0] - 1))
        here = (y, x)
        back = (d + 4) % 8


def perimeter(points: np.ndarray) -> float:
    """Length of the closed polygon."""
    return float(np.hypot(*(np.roll(points, -1, axis=0) - points).T).sum()) if len(points) else 0.0


def polygon_centroid(points: np.ndarray) -> tuple[float, float] | None:
    """Centroid by Green's theorem; None for polygons without area."""
    x, y = points.T.astype(float)
    u, v = np.roll(x, -1), np.roll(y, -1)
    cross = x * v - u * y
    area = cross.sum() / 2
    if abs(area) < 1e-12:
        return None
    return float(((x + u) * cross).sum() / (6 * area)), float(((y + v) * cross).sum() / (6 * area))


def ellipse_axes(points: np.ndarray) -> tuple[float, float] | None:
    """Major and minor axis of the least-squares ellipse through the points; None where there is none."""
    p = points - points.mean(axis=0)
    scale = np.abs(p).max() or 1.0
    x, y = (p / scale).T
    quad, rest = np.stack((x * x, x * y, y * y), axis=1), np.stack((x, y, np.ones_like(x)), axis=1)
    cross = rest.T @ rest
    if np.linalg.matrix_rank(cross) < 3:
        return None
    fold = -np.linalg.solve(cross, rest.T @ quad)
    m = quad.T @ quad + (quad.T @ rest) @ fold
    m = np.array([m[2] / 2, -m[1], m[0] / 2])
    values, vectors = np.linalg.eig(m)
    vectors = vectors.real
    good = np.flatnonzero(4 * vectors[0] * vectors[2] - vectors[1] ** 2 > 1e-12)
    if not len(good):
        return None
    a, b, c = vectors[:, good[0]]
    d, e, f = fold @ vectors[:, good[0]]
    conic = np.array([[a, b / 2], [b / 2, c]])
    centre = np.linalg.solve(-2 * conic, np.array([d, e]))
    level = -(f + (d * centre[0] + e * centre[1]) / 2)
    axes = level / np.linalg.eigvalsh(conic)
    if (axes <= 0).any():
        return None
    half = np.sqrt(axes) * scale
    return float(2 * half.max()), float(2 * half.min())


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, counter-clockwise, by monotone chains."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def chain(seq) -> list:
        out: list = []
        for q in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(chain(p) + chain(p[::-1]))


def box_axes(points: np.ndarray) -> tuple[float, float]:
    """Sides of the rectangle of least area around the points, longer first."""
    corners = hull(points).astype(float)
    if len(corners) < 2:
        return 0.0, 0.0
    sides = np.roll(corners, -1, axis=0) - corners
    best = None
    for dx, dy in sides[np.hypot(*sides.T) > 0]:
        u = np.array([dx, dy]) / np.hypot(dx, dy)
        span = [float(np.ptp(corners @ v)) for v in (u, np.array([-u[1], u[0]]))]
        if best is None or span[0] * span[1] < best[0] * best[1]:
            best = span
    return (max(best), min(best)) if best else (0.0, 0.0)


def chamfer(mask: np.ndarray, steps: tuple[float, float] = CHAMFER) -> np.ndarray:
    """Distance of every pixel to the nearest True by 3 x 3 steps, in a forward and a backward pass."""
    far = 1e9
    d = np.pad(np.where(mask, 0.0, far), 1, constant_values=far)
    a, b = steps
    w = mask.shape[1]
    ramp = np.arange(w + 2) * a
    for rows, up in ((range(1, d.shape[0] - 1), -1), (range(d.shape[0] - 2, 0, -1), 1)):
        for y in rows:
            above = d[y + up]
            d[y, 1:-1] = np.minimum.reduce([d[y, 1:-1], above[1:-1] + a, above[:-2] + b, above[2:] + b])
            right = np.minimum.accumulate(d[y] - ramp) + ramp
            left = np.minimum.accumulate((d[y] + ramp)[::-1])[::-1] - ramp
            d[y, 1:-1] = np.minimum(right, left)[1:-1]
    return d[1:-1, 1:-1]


def disc(r: int) -> np.ndarray:
    """Offsets (dy, dx) of an elliptic kernel of 2r + 1 pixels."""
    out = []
    for dy in range(-r, r + 1):
        dx = round(r * (1 - (dy / r) ** 2) ** 0.5) if r else 0
        out += [(dy, x) for x in range(-dx, dx + 1)]
    return np.array(out)


def dilate(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    r = int(np.abs(offsets).max())
    padded, out = np.pad(mask, r), np.zeros_like(mask)
    h, w = mask.shape
    for dy, dx in offsets:
        out |= padded[r - dy : r - dy + h, r - dx : r - dx + w]
    return out


def glcm(gray: np.ndarray, offsets: tuple[tuple[int, int], ...]) -> tuple[float, float]:
    """Mean contrast and homogeneity of symmetric co-occurrences over the offsets (dy, dx)."""
    out = []
    h, w = gray.shape
    for dy, dx in offsets:
        a = gray[max(0, -dy) : h - max(0, dy), max(0, -dx) : w - max(0, dx)].astype(float)
        b = gray[max(0, dy) : h - max(0, -dy), max(0, dx) : w - max(0, -dx)].astype(float)
        diff = (a - b) ** 2
        out.append((diff.mean(), (1 / (1 + diff)).mean()) if diff.size else (0.0, 0.0))
    return tuple(float(x) for x in np.mean(out, axis=0))
