"""Kernels on 3-D grids."""

from __future__ import annotations

import numpy as np


def reach(fwhm: float, spacing: float, truncate: float = 4.0) -> int:
    """Voxels that a sampled Gaussian reaches to each side."""
    return int(truncate * fwhm / (np.sqrt(8 * np.log(2)) * spacing) + 0.5)


def gaussian_weights(sigma: float, truncate: float = 4.0) -> np.ndarray:
    """Weights of a sampled Gaussian, summing to 1."""
    half = int(truncate * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-half, half + 1) / sigma) ** 2) if sigma > 0 else np.ones(1)
    return w / w.sum()


def along(volume: np.ndarray, weights: np.ndarray, axis: int) -> np.ndarray:
    """Weighted sum of neighbours on one axis; nothing beyond the edge."""
    half = len(weights) // 2
    out = np.zeros_like(volume, float)
    n = volume.shape[axis]
    for i, w in enumerate(weights):
        d = i - half
        if abs(d) < n:
            to = [slice(None)] * volume.ndim
            of = [slice(None)] * volume.ndim
            to[axis], of[axis] = slice(max(0, -d), n - max(0, d)), slice(max(0, d), n - max(0, -d))
            out[tuple(to)] += w * volume[tuple(of)]
    return out


def smooth(volume: np.ndarray, mask: np.ndarray, fwhm: float, spacing: tuple[float, float, float]) -> np.ndarray:
    """Gaussian smoothing of the last three axes inside a mask: divided by the smoothed mask, cut to the mask, 0 where undefined."""
    weights = [gaussian_weights(fwhm / (np.sqrt(8 * np.log(2)) * s)) for s in spacing]
    top, bottom = volume * mask, mask.astype(float)
    for axis, w in enumerate(weights):
        top, bottom = along(top, w, axis - 3), along(bottom, w, axis - 3)
    with np.errstate(invalid="ignore", divide="ignore"):
        out = np.where(mask, top / bottom, 0.0)
    return np.nan_to_num(out, nan=0.0, posinf=0.0, neginf=0.0)


def rigid(parameters: np.ndarray) -> np.ndarray:
    """4x4 matrix of three translations and three rotations (radians, about x, y, z in turn)."""
    mx, my, mz, a, b, c = parameters
    ca, sa, cb, sb, cc, sc = np.cos(a), np.sin(a), np.cos(b), np.sin(b), np.cos(c), np.sin(c)
    out = np.eye(4)
    out[:3, :3] = np.array([[1, 0, 0], [0, ca, -sa], [0, sa, ca]]) @ np.array([[cb, 0, sb], [0, 1, 0], [-sb, 0, cb]]) @ np.array([[cc, -sc, 0], [sc, cc, 0], [0, 0, 1]])
    out[:3, 3] = (mx, my, mz)
    return out


def displacement(points: np.ndarray, motion: np.ndarray) -> np.ndarray:
    """Mean distance that points move from each frame to the next; 0 at the last frame."""
    moved = np.stack([(np.linalg.inv(rigid(m)) @ np.c_[points, np.ones(len(points))].T)[:3].T for m in motion])
    step = np.sqrt(((moved[1:] - moved[:-1]) ** 2).sum(axis=2)).mean(axis=1)
    return np.append(step, 0.0)


def otsu(histogram: np.ndarray, centres: np.ndarray, classes: int) -> np.ndarray:
    """Thresholds that give the greatest variance between classes, by dynamic programming over bins."""
    n = len(histogram)
    w = np.concatenate([[0], np.cumsum(histogram)])
    m = np.concatenate([[0], np.cumsum(histogram * centres)])
    gain = lambda i, j: (m[j] - m[i]) ** 2 / (w[j] - w[i]) if w[j] > w[i] else 0.0
    best = [[gain(0, j) for j in range(n + 1)]]
    back = []
    for _ in range(classes - 1):
        row, at = [0.0] * (n + 1), [0] * (n + 1)
        for j in range(1, n + 1):
            row[j], at[j] = max((best[-1][i] + gain(i, j), -i) for i in range(j))
            at[j] = -at[j]
        best.append(row)
        back.append(at)
    cuts, j = [], n
    for at in reversed(back):
        j = at[j]
        cuts.append(j)
    return centres[np.maximum(np.array(sorted(cuts)) - 1, 0)]


def reorder(direction: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each axis of right-anterior-superior order: the source axis and its sign (greatest cosine, each axis once)."""
    d = np.array(direction, float)
    axes, signs, free = np.zeros(3, int), np.ones(3, int), set(range(3))
    for world in range(3):
        source = max(free, key=lambda k: abs(d[world, k]))
        free.remove(source)
        axes[world], signs[world] = source, 1 if d[world, source] >= 0 else -1
    return axes, signs


def mirrored(i: np.ndarray, n: int) -> np.ndarray:
    """Indices reflected about the first and the last."""
    if n == 1:
        return np.zeros_like(i)
    i = np.abs(i) % (2 * n - 2)
    return np.where(i < n, i, 2 * n - 2 - i)


def spline_matrix(n: int) -> np.ndarray:
    """What takes a line's coefficients of the cubic B-spline to its values, mirrored at the ends."""
    out = np.zeros((n, n))
    for shift, weight in ((-1, 1 / 6), (0, 4 / 6), (1, 1 / 6)):
        np.add.at(out, (np.arange(n), mirrored(np.arange(n) + shift, n)), weight)
    return out


def cubic(d: np.ndarray) -> np.ndarray:
    d = np.abs(d)
    return np.where(d < 1, 2 / 3 - d**2 + d**3 / 2, np.where(d < 2, np.maximum(2 - d, 0) ** 3 / 6, 0.0))


#: Interpolators by name: reach in voxels, weight of a distance, and what lies beyond an edge.
INTERPOLATORS = {
    "linear": (1, lambda d: np.maximum(1 - np.abs(d), 0), "edge"),
    "bspline": (2, cubic, "mirror"),
    "lanczos": (3, lambda d: np.sinc(d) * np.sinc(d / 3) * (np.abs(d) < 3), "edge"),
    "cosine": (3, lambda d: np.sinc(d) * np.cos(np.pi * d / 6) * (np.abs(d) < 3), "edge"),
}


def interpolated(box: np.ndarray, points: np.ndarray, kind: str, shape: tuple[int, int, int], corner: np.ndarray) -> np.ndarray:
    """Values at points (n, 3) in voxel coordinates of a grid of which ``box`` is the part from ``corner`` on; 0 over half a voxel outside the grid.

    For bspline, the box holds coefficients.
    """
    reach, weight, beyond = INTERPOLATORS[kind]
    base, steps = np.floor(points).astype(int), np.arange(1 - reach, reach + 1)
    inside = ((points >= -0.5) & (points < np.array(shape) - 0.5)).all(axis=1)
    index, w = [], []
    for axis, n in enumerate(shape):
        at = base[:, axis, None] + steps
        at = mirrored(at, n) if beyond == "mirror" else np.clip(at, 0, n - 1)
        index.append(np.clip(at - corner[axis], 0, box.shape[axis] - 1))
        w.append(weight(base[:, axis, None] + steps - points[:, axis, None]))
    out = np.zeros(len(points))
    for i in range(len(steps)):
        for j in range(len(steps)):
            row = box[index[0][:, i, None], index[1][:, j, None], index[2]]
            out += w[0][:, i] * w[1][:, j] * (row * w[2]).sum(axis=1)
    return np.where(inside, out, 0.0)
