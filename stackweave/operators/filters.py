"""Neighbourhood filters in space and time."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave.functions.halos import baseline_halo, wavelet_halo
from stackweave.functions.kernels import gaussian_taps, rank_filter, spline_taps, weighted_shift_sum
from stackweave.model import global_stat
from stackweave.operators.blocks import map_to_frames
from stackweave.operators.elementwise import map_values
from stackweave.operators.frames import map_frames
from stackweave.session import Scratch


def median_filter(frames: DataFrame, size: int = 3) -> DataFrame:
    """Spatial median of each frame, mirrored at the border; even sizes take the upper middle."""
    rank = size * size // 2
    return map_frames(frames, lambda stack: rank_filter(stack, size, rank))


def reset_minimum(filtered: DataFrame, original: DataFrame) -> DataFrame:
    """Shift a filtered stack so that its minimum equals the original's."""
    moved = filtered.withColumn("_s", global_stat(original, "min") - global_stat(filtered, "min"))
    return map_values(moved, lambda v: v + F.col("_s")).drop("_s")


def denoise(frames: DataFrame, size: int = 3, scratch: Scratch | None = None) -> DataFrame:
    """Median filter, then the original minimum.

    The filtered stack is written first, so that its minimum and its pixels are read back
    instead of filtering twice.
    """
    scratch = scratch or Scratch(frames.sparkSession, "denoise")
    return reset_minimum(scratch.write(median_filter(frames, size)), frames)


def smooth_levels(stack: np.ndarray, scales: tuple[int, int, int]) -> list[np.ndarray]:
    """The stack and its a-trous smoothings, level after level, each axis up to its scale."""
    out = [stack]
    for level in range(1, max(scales) + 1):
        cur = out[-1]
        for axis, scale in enumerate(scales):
            if scale >= level:
                cur = weighted_shift_sum(cur, axis, spline_taps(level))
        out.append(cur)
    return out


def detail(stack: np.ndarray, scales: tuple[int, int, int], level: int | None = None) -> np.ndarray:
    """Detail ``level`` (the coarsest by default); level + 1 is the residual."""
    levels = smooth_levels(stack, scales)
    top = len(levels) - 1
    level = top if level is None else level
    return levels[top] if level == top + 1 else levels[level - 1] - levels[level]


def wavelet_transform(
    frames: DataFrame, scale: int | tuple[int, int, int], level: int | None = None, block: tuple[int, int, int] | None = None
) -> DataFrame:
    """One detail level of the a-trous transform; one scale per axis (t, y, x), or one for all.

    Without a time scale each frame is on its own and nothing is shuffled; with one, haloed
    blocks are mapped. ``block`` defaults to whole frames as far as they fit a task, then to tiles.
    """
    scales = (scale,) * 3 if isinstance(scale, int) else tuple(scale)
    if scales[0] == 0 and block is None:
        return map_frames(frames, lambda stack: detail(stack, scales, level))
    return map_to_frames(frames, lambda stack: detail(stack, scales, level), block, wavelet_halo(scales))


def wavelet_2d(frames: DataFrame, scale: int, level: int | None = None) -> DataFrame:
    """Spatial a-trous detail of each frame."""
    return map_frames(frames, lambda stack: detail(stack, (0, scale, scale), level))


def rolling_quantile(stack: np.ndarray, half_window: int, quantile: float) -> np.ndarray:
    """Interpolated quantile over time within ``half_window`` frames, cut at the ends."""
    n = len(stack)
    width = 2 * half_window + 1
    out = np.empty_like(stack, dtype=np.float64)
    if n >= width:
        views = np.lib.stride_tricks.sliding_window_view(stack, width, axis=0)
        for i in range(len(views)):
            out[half_window + i] = np.quantile(views[i], quantile, axis=-1)
    ends = range(n) if n < width else [*range(half_window), *range(n - half_window, n)]
    for i in ends:
        out[i] = np.quantile(stack[max(0, i - half_window):i + half_window + 1], quantile, axis=0)
    return out


def extract_f0(
    frames: DataFrame, half_window: int, quantile: float, t_sigma: float = 0.0, t_window: float = 0.0,
    s_sigma: float = 0.0, s_window: float = 0.0, bias: float | None = None, return_f0: bool = False,
    block: tuple[int, int, int] | None = None, **extra,
) -> DataFrame:
    """Relative change over a smoothed rolling-quantile baseline, or the baseline itself.

    Steps: add the bias (by default ``1 - min`` of the whole stack), smooth over time, take
    the rolling quantile, smooth over space. The halo is the sum of the time steps, so the
    result does not depend on the block size.
    """
    if extra:
        raise TypeError(f"unexpected arguments {sorted(extra)}")
    lift = F.lit(float(bias)) if bias is not None else F.lit(1.0) - global_stat(frames, "min")
    lifted = map_values(frames.withColumn("_b", lift), lambda v: v + F.col("_b")).select("t", "h", "w", "px")
    t_taps, s_taps = gaussian_taps(t_sigma, t_window), gaussian_taps(s_sigma, s_window)

    def run(stack: np.ndarray) -> np.ndarray:
        base = rolling_quantile(weighted_shift_sum(stack, 0, t_taps), half_window, quantile)
        base = weighted_shift_sum(weighted_shift_sum(base, 1, s_taps), 2, s_taps)
        return base if return_f0 else (stack - base) / base

    halo = baseline_halo(half_window, t_sigma, t_window, s_sigma, s_window, chained=True)
    return map_to_frames(lifted, run, block, halo)
