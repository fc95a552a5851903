"""Statistics over time per pixel, and the stacks corrected by them.

All of them explode frames straight into a partial aggregate: each task sends at most one
row per pixel position, however many frames it has read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackweave.functions.arrays import let
from stackweave.model import explode_frames, global_stat, is_frames, to_pixels

KEYS = ("y", "x")


def stack_bounds(stack: DataFrame) -> DataFrame:
    """One row with the smallest and largest value, without exploding frames."""
    if is_frames(stack):
        return stack.agg(F.min(F.array_min("px")).alias("v_min"), F.max(F.array_max("px")).alias("v_max"))
    return stack.agg(F.min("v").alias("v_min"), F.max("v").alias("v_max"))


def project(stack: DataFrame, space: tuple[str, ...] = KEYS, **aggregates: Column) -> DataFrame:
    """The coordinates plus one column per named aggregate of ``v``.

    Pixel tables may have any number of coordinate columns, for example ``("z", "y", "x")``.
    """
    pixels = to_pixels(stack) if is_frames(stack) else stack
    return pixels.groupBy(*space).agg(*[c.alias(n) for n, c in aggregates.items()])


def proj_min(stack: DataFrame, space: tuple[str, ...] = KEYS) -> DataFrame:
    return project(stack, space, value=F.min("v"))


def proj_max(stack: DataFrame, space: tuple[str, ...] = KEYS) -> DataFrame:
    return project(stack, space, value=F.max("v"))


def proj_mean(stack: DataFrame, space: tuple[str, ...] = KEYS) -> DataFrame:
    return project(stack, space, value=F.avg("v"))


def proj_std(stack: DataFrame, space: tuple[str, ...] = KEYS) -> DataFrame:
    """Population standard deviation."""
    return project(stack, space, value=F.stddev_pop("v"))


def proj_moments(stack: DataFrame, count: int, space: tuple[str, ...] = KEYS) -> DataFrame:
    """Raw moments of order 0 to ``count - 1`` as rows ``(order, y, x, value)``."""
    wide = project(stack, space, **{f"m{k}": F.avg(F.pow("v", F.lit(float(k)))) for k in range(count)})
    moments = F.array(*[F.struct(F.lit(k).alias("order"), F.col(f"m{k}").alias("value")) for k in range(count)])
    return wide.select(*space, F.inline(moments)).select("order", *space, "value")


def _shifted_inverse(stack: DataFrame) -> DataFrame:
    pixels = stack.withColumn("_s", global_stat(stack, "min") - F.lit(1.0))
    if is_frames(stack):
        pixels = explode_frames(pixels, "_s")
    return pixels.withColumn("_i", F.lit(1.0) / (F.col("v") - F.col("_s")))


def _with_hmean(stack: DataFrame, space: tuple[str, ...] = KEYS, **others: Column) -> DataFrame:
    """``(y, x, hmean)`` and other aggregates of ``v``, all from one pass after the minimum."""
    named = [c.alias(n) for n, c in others.items()]
    rows = _shifted_inverse(stack).groupBy(*space).agg(F.avg("_i").alias("_m"), F.max("_s").alias("_s"), *named)
    return rows.select(*space, (F.lit(1.0) / F.col("_m") + F.col("_s")).alias("hmean"), *others)


def proj_hmean(stack: DataFrame, space: tuple[str, ...] = KEYS) -> DataFrame:
    """Harmonic mean of the stack raised so that its minimum is 1, lowered again after."""
    return _with_hmean(stack, space).withColumnRenamed("hmean", "value")


def projections(stack: DataFrame, space: tuple[str, ...] = KEYS) -> DataFrame:
    """Harmonic mean, minimum, maximum, mean and standard deviation in one pass."""
    return _with_hmean(stack, space, min=F.min("v"), max=F.max("v"), mean=F.avg("v"), std=F.stddev_pop("v"))


def background_subtract(
    stack: DataFrame, stats: DataFrame | None = None, space: tuple[str, ...] = KEYS
) -> DataFrame:
    """Remove the harmonic-mean image, then shift the whole result to a minimum of 0.

    The minimum of the result is the smallest ``min - hmean`` over the pixels, so both numbers
    come from the projections (``stats``, if they are stored already) and the stack is read
    once more only. In frame form the image is one array from a scalar subquery, no larger
    than every frame is; in pixel form the planner picks the join by the image's size.
    """
    if stats is None:
        stats = _with_hmean(stack, space, min=F.min("v"))
    lowest = F.min(F.col("min") - F.col("hmean")).alias("low")
    if not is_frames(stack):
        joined = stack.join(stats.select(*space, "hmean"), list(space)).withColumn("_low", stats.agg(lowest).scalar())
        return joined.select("t", *space, (F.col("v") - F.col("hmean") - F.col("_low")).alias("v"))
    # Image rows are gathered by many tasks; one task only strings together one array per image row.
    first, *rest = space
    line = F.transform(F.array_sort(F.collect_list(F.struct(*rest, "hmean"))), lambda c: c["hmean"])
    lines = stats.groupBy(first).agg(line.alias("line"), lowest)
    image = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(first, "line"))), lambda c: c["line"]))
    known = stack.withColumn("_b", lines.agg(F.struct(image.alias("img"), F.min("low").alias("low"))).scalar())
    moved = let(F.col("_b.low"), lambda low: F.zip_with("px", "_b.img", lambda v, b: v - b - low))
    return known.withColumn("px", moved).drop("_b")
