"""Per-frame normalisation: a narrow map over the frame form, or one aggregate per frame in pixel form.

Pixel tables may have any number of coordinates, so volumes are normalised like images; absent pixels
take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackweave.functions.arrays import let, mean, norm
from stackweave.model import is_frames


def _with_frame_value(pixels: DataFrame, value: Column, body) -> DataFrame:
    """``v`` changed by ``body(v, value of its frame)``; partial sums make the value, the join is on the frame."""
    known = pixels.join(pixels.groupBy("t").agg(value.alias("_f")), "t")
    return known.withColumn("v", body(F.col("v"), F.col("_f"))).select(*pixels.columns)


def pixel_norm(v: Column, order: float | str = 2) -> Column:
    """Norm of a column of values as an aggregate: 0, 1, 2, ``inf``, ``-inf`` or any positive p."""
    order = float(order)
    if order == 0:
        return F.sum(F.when(v != 0, 1.0).otherwise(0.0))
    if order == float("inf"):
        return F.max(F.abs(v))
    if order == float("-inf"):
        return F.min(F.abs(v))
    return F.pow(F.sum(F.pow(F.abs(v), F.lit(order))), F.lit(1.0 / order))


def zeroed_mean(stack: DataFrame) -> DataFrame:
    """Subtract each frame's own mean."""
    if not is_frames(stack):
        return _with_frame_value(stack, F.avg("v"), lambda v, m: v - m)
    px = F.col("px")
    return stack.withColumn("px", let(mean(px), lambda m: F.transform(px, lambda v: v - m)))


def _over(v: Column, n: Column) -> Column:
    return F.when(n != 0, v / F.nullif(n, F.lit(0.0))).otherwise(v)


def renormalize(stack: DataFrame, order: float | str = 2) -> DataFrame:
    """Divide each frame by its norm; frames of norm 0 stay as they are."""
    if not is_frames(stack):
        return _with_frame_value(stack, pixel_norm(F.col("v"), order), _over)
    px = F.col("px")
    return stack.withColumn("px", let(norm(px, order), lambda n: F.transform(px, lambda v: _over(v, n))))


def normalize_data(stack: DataFrame, order: float | str = 2) -> DataFrame:
    """Zero mean, then unit norm."""
    return renormalize(zeroed_mean(stack), order)


def normalize_min(stack: DataFrame, order: float | str = 2) -> DataFrame:
    """Frame minimum to 0, then unit norm."""
    if not is_frames(stack):
        return renormalize(_with_frame_value(stack, F.min("v"), lambda v, low: v - low), order)
    px = F.col("px")
    shifted = stack.withColumn("px", let(F.array_min(px), lambda low: F.transform(px, lambda v: v - low)))
    return renormalize(shifted, order)
