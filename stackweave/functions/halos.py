"""Halo sizes of the block operators, as plain numbers known before any job runs."""

from __future__ import annotations

import math
from collections.abc import Sequence


def baseline_halo(
    half_window: int, t_sigma: float, t_window: float, s_sigma: float, s_window: float, ndim: int = 3,
    chained: bool = False,
) -> tuple[int, ...]:
    """Halo of the baseline extraction: time first, then the same for every space axis.

    The time steps run one after the other, so only their sum (``chained``) makes the result
    independent of the blocks; the larger of the two is the smaller, approximate halo.
    """
    reach = math.ceil(t_window * t_sigma)
    time = reach + half_window if chained else max(reach, half_window)
    return (time,) + (math.ceil(s_window * s_sigma),) * (ndim - 1)


def wavelet_halo(scale: int | Sequence[int], ndim: int = 3) -> tuple[int, ...]:
    """Sum of ``2^j`` for j = 1 to the scale, per axis."""
    scales = (scale,) * ndim if isinstance(scale, int) else tuple(scale)
    return tuple(2 ** (s + 1) - 2 for s in scales)


def normalize_halo(ndim: int = 3) -> tuple[int, ...]:
    """Normalisation needs no neighbours."""
    return (0,) * ndim
