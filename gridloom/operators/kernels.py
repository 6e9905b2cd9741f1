"""Dense optical flow and resampling kernels in NumPy, and the tile operators that run them.

Flow after Brigot et al. 2016 and the Lucas-Kanade equations: images are rank-transformed; from the coarsest image of a
pyramid to the finest, and from the widest window to the narrowest, the least-squares shift of each window is solved a few
times, the moving image being sampled where the shift so far points. Tiles carry a halo copied from their neighbours, so
each is computed alone.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from .tiles import map_tiles

#: Added to the diagonal of a window's equations, so that flat windows have a solution.
DAMPING = 1e-8
SMOOTH = (0.05, 0.25, 0.4, 0.25, 0.05)  # five-tap weights of Burt and Adelson
#: Cubic convolution's free constant. Fixed value: the one of the common image library's cubic resampling.
CUBIC = -0.75


def box_mean(a: np.ndarray, radius: int) -> np.ndarray:
    """Mean over (2 radius + 1)^2 pixels, zeros outside, by running sums."""
    side = 2 * radius + 1
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (radius + 1, radius)
        total = np.cumsum(np.pad(a, pad), axis=axis)
        n = a.shape[axis]
        a = np.take(total, np.arange(side, side + n), axis) - np.take(total, np.arange(n), axis)
    return a / side**2


def halved(a: np.ndarray) -> np.ndarray:
    """The next image of the pyramid: smoothed along both axes, zeros outside, every second pixel."""
    for axis in (0, 1):
        a = np.apply_along_axis(np.convolve, axis, a, SMOOTH)
        a = np.take(a, np.arange(2, a.shape[axis] - 2, 2), axis)
    return a


def doubled(a: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Each pixel twice in both directions, cropped to shape, zeros beyond."""
    rows, cols = (np.arange(n) // 2 for n in shape)
    inside = (rows < a.shape[0])[:, None] & (cols < a.shape[1])[None, :]
    return np.where(inside, a[np.minimum(rows, a.shape[0] - 1)[:, None], np.minimum(cols, a.shape[1] - 1)[None, :]], 0.0)


def rank(a: np.ndarray, radius: int) -> np.ndarray:
    """Neighbours in the square window strictly above the centre; outside counts as zero."""
    side = 2 * radius + 1
    windows = np.lib.stride_tricks.sliding_window_view(np.pad(a, radius), (side, side))
    return sum((windows[:, :, k // side, k % side] > a).astype(float) for k in range(side * side))


def sample_linear(a: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """a at (x, y), coordinates clamped to the edge."""
    x, y = np.clip(x, 0, a.shape[1] - 1), np.clip(y, 0, a.shape[0] - 1)
    x0, y0 = np.minimum(x.astype(int), max(a.shape[1] - 2, 0)), np.minimum(y.astype(int), max(a.shape[0] - 2, 0))
    x1, y1, fx, fy = np.minimum(x0 + 1, a.shape[1] - 1), np.minimum(y0 + 1, a.shape[0] - 1), x - x0, y - y0
    return (a[y0, x0] * (1 - fx) + a[y0, x1] * fx) * (1 - fy) + (a[y1, x0] * (1 - fx) + a[y1, x1] * fx) * fy


def sample_cubic(a: np.ndarray, x: np.ndarray, y: np.ndarray, sharp: float = CUBIC) -> np.ndarray:
    """a at (x, y) by cubic convolution over 16 pixels, zero outside."""
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)

    def weight(t: np.ndarray) -> np.ndarray:
        t = np.abs(t)
        near, far = (sharp + 2) * t**3 - (sharp + 3) * t**2 + 1, sharp * t**3 - 5 * sharp * t**2 + 8 * sharp * t - 4 * sharp
        return np.where(t <= 1, near, np.where(t < 2, far, 0.0))

    out = np.zeros(x.shape)
    for i in range(-1, 3):
        for j in range(-1, 3):
            r, c = y0 + i, x0 + j
            inside = (r >= 0) & (r < a.shape[0]) & (c >= 0) & (c < a.shape[1])
            out += np.where(inside, a[np.clip(r, 0, a.shape[0] - 1), np.clip(c, 0, a.shape[1] - 1)], 0.0) * weight(y - r) * weight(x - c)
    return out


def _window_shift(reference: np.ndarray, moving: np.ndarray, shift: np.ndarray, radius: int, turns: int) -> np.ndarray:
    """shift (2, h, w), refined: per window, the d that minimises the sum of (grad . d - difference)^2, solved turns times."""
    mean = lambda stack: np.stack([box_mean(layer, radius) for layer in stack])
    slope = np.stack(np.gradient(reference)[::-1])  # along columns, along rows
    place = np.stack(np.meshgrid(*(np.arange(float(n)) for n in reference.shape[::-1])))
    cc, rr, cr = mean((slope[0] ** 2, slope[1] ** 2, slope[0] * slope[1]))
    cc, rr = cc + DAMPING, rr + DAMPING
    inverse = np.stack([np.stack([rr, -cr]), np.stack([-cr, cc])])
    with np.errstate(all="ignore"):
        inverse = inverse / (cc * rr - cr * cr)
        for _ in range(turns):
            difference = reference - sample_linear(moving, *(place + shift)) + (slope * shift).sum(axis=0)
            shift = np.einsum("ijhw,jhw->ihw", inverse, mean(slope * difference))
            shift = np.where(np.isfinite(shift), shift, 0.0)
    return shift


def _unit(a: np.ndarray) -> np.ndarray:
    low, high = float(a.min()), float(a.max())
    return (a - low) / (high - low) if high > low else np.zeros(a.shape)


def flow(reference: np.ndarray, moving: np.ndarray, radii: tuple[int, ...] = (32, 24, 16, 8), iterations: int = 8, rank_radius: int = 4, levels: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(u, v) such that moving at (x + u, y + v) is reference at (x, y); levels counts the images of the pyramid."""
    pyramid = [(_unit(reference.astype(float)), _unit(moving.astype(float)))]
    while len(pyramid) < levels and min(pyramid[-1][0].shape) >= 4:
        pyramid.append(tuple(map(halved, pyramid[-1])))
    shift = np.zeros((2, *pyramid[-1][0].shape))
    for pair in reversed(pyramid):
        if shift.shape[1:] != pair[0].shape:
            shift = np.stack([2 * doubled(layer, pair[0].shape) for layer in shift])
        ref, mov = (rank(image, rank_radius) if rank_radius else image for image in pair)
        for radius in radii:
            shift = _window_shift(ref, mov, shift, radius, iterations)
    return shift[0], shift[1]


def stretched(a: np.ndarray, floor: float = -32000.0, least: int = 100) -> np.ndarray:
    """Values between the 2nd and 98th percentile of the positive ones as 0..1; zeros with fewer than least of them."""
    a = np.where(a <= floor, 0.0, a)
    some = a > 0
    if some.sum() < least:
        return np.zeros(a.shape)
    low, high = np.percentile(a[some], (2, 98))
    return np.clip((a - low) / (high - low + 1e-6), 0, 1)


def dense_flow(px: DataFrame, size: int, halo: int, flow_fn: Callable = flow, stretch: bool = False, keys: tuple[str, ...] = (), only: DataFrame | None = None, **settings) -> DataFrame:
    """(keys, r, c, u, v) of px (keys, r, c, reference, moving): the flow of each tile, computed with its halo.

    stretch: both images of a tile are stretched between their percentiles first. keys and only as map_tiles has them.
    """

    def kernel(a: dict, here: np.ndarray, r0: int, c0: int) -> dict:
        pair = [stretched(a[k]) if stretch else a[k] for k in ("reference", "moving")]
        u, v = flow_fn(*pair, **settings)
        return {"u": u.astype(float), "v": v.astype(float)}

    return map_tiles(px, ["reference", "moving"], size, halo, kernel, "u double, v double", keys, only)


def cubic_warp(px: DataFrame, size: int, halo: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, r, c, dn) of px (keys, r, c, dn, u, v): dn sampled once by cubic convolution at (c + u, r + v), rounded and clipped.

    Shifts of more than halo pixels need a greater halo.
    """

    def kernel(a: dict, here: np.ndarray, r0: int, c0: int) -> dict:
        rows, cols = np.meshgrid(*(np.arange(n) for n in here.shape), indexing="ij")
        out = np.round(sample_cubic(a["dn"], cols + a["u"], rows + a["v"]), 9)  # sums that differ in their last bits round alike
        return {"dn": np.clip(np.rint(out), 0, 255).astype(np.int32)}

    return map_tiles(px, ["dn", "u", "v"], size, halo, kernel, "dn int", keys)
