"""Small numpy helpers that run inside tasks on whole frames or blocks."""

from __future__ import annotations

import math

import numpy as np

# The cubic B-spline taps of the a-trous transform.
SPLINE_TAPS = (1 / 16, 4 / 16, 6 / 16, 4 / 16, 1 / 16)


def reflect_index(size: int, before: int, after: int) -> np.ndarray:
    """Source positions for an axis extended by mirroring with the edge sample repeated."""
    pos = np.arange(-before, size + after) % (2 * size)
    return np.where(pos < size, pos, 2 * size - 1 - pos)


def weighted_shift_sum(a: np.ndarray, axis: int, taps: dict[int, float]) -> np.ndarray:
    """Sum of ``weight * a`` shifted along one axis, mirrored at the ends."""
    reach = max(abs(d) for d in taps)
    size = a.shape[axis]
    wide = np.take(a, reflect_index(size, reach, reach), axis=axis)
    out = np.zeros_like(a, dtype=np.float64)
    for d, weight in taps.items():
        out += weight * np.take(wide, np.arange(reach + d, reach + d + size), axis=axis)
    return out


def gaussian_taps(sigma: float, window: float) -> dict[int, float]:
    """Normalised Gaussian weights out to ``ceil(window * sigma)`` samples on each side."""
    reach = int(math.ceil(window * sigma))
    if reach == 0 or sigma == 0:
        return {0: 1.0}
    raw = {d: math.exp(-0.5 * (d / sigma) ** 2) for d in range(-reach, reach + 1)}
    scale = sum(raw.values())
    return {d: v / scale for d, v in raw.items()}


def spline_taps(level: int) -> dict[int, float]:
    """Taps of the a-trous smoothing step ``level`` (1 is the finest)."""
    hole = 2 ** (level - 1)
    return {(i - 2) * hole: w for i, w in enumerate(SPLINE_TAPS)}


def rank_filter(stack: np.ndarray, size: int, rank: int) -> np.ndarray:
    """Element ``rank`` of the sorted ``size`` x ``size`` neighbourhood in every frame."""
    before, after = size // 2, size - 1 - size // 2
    _, h, w = stack.shape
    wide = stack[:, reflect_index(h, before, after)][:, :, reflect_index(w, before, after)]
    views = np.lib.stride_tricks.sliding_window_view(wide, (size, size), axis=(1, 2))
    flat = views.reshape(*views.shape[:3], size * size)
    return np.partition(flat, rank, axis=-1)[..., rank]


def spread_labels(mask: np.ndarray) -> np.ndarray:
    """8-connected region labels of one frame: 0 outside, else 1 + the region's first pixel."""
    h, w = mask.shape
    none = h * w
    lab = np.where(mask, np.arange(h * w).reshape(h, w), none)
    while True:
        wide = np.pad(lab, 1, constant_values=none)
        rows = np.minimum(np.minimum(wide[:-2], wide[1:-1]), wide[2:])
        low = np.minimum(np.minimum(rows[:, :-2], rows[:, 1:-1]), rows[:, 2:])
        low = np.where(mask, low, none)
        # Follow each label to its own label, which halves the remaining distance.
        jump = np.append(low.ravel(), none)
        low = np.where(mask, np.minimum(low, jump[low]), none)
        if np.array_equal(low, lab):
            return np.where(mask, lab + 1, 0)
        lab = low


def flood(region: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Grow positive seeds through equal region labels one 8-neighbour step at a time.

    A pixel reached by two seeds in the same step goes to the lower seed number.
    """
    none = np.iinfo(np.int64).max
    owner = np.where((seeds > 0) & (region > 0), seeds, none).astype(np.int64)
    h, w = region.shape
    wide_region = np.pad(region, 1)
    while True:
        wide = np.pad(owner, 1, constant_values=none)
        best = np.full((h, w), none, dtype=np.int64)
        for dy in (0, 1, 2):
            for dx in (0, 1, 2):
                same = wide_region[dy:dy + h, dx:dx + w] == region
                best = np.minimum(best, np.where(same, wide[dy:dy + h, dx:dx + w], none))
        grown = np.where((owner == none) & (region > 0), best, owner)
        if np.array_equal(grown, owner):
            return np.where(owner == none, 0, owner)
        owner = grown
