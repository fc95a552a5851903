"""Operators that change or select pixels one by one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackweave.functions.arrays import let
from stackweave.model import frame_total, global_stat, is_frames

# Bounds of the integer output types of norm_layer.
INTEGER_BOUNDS = {
    "int8": (-128, 127), "int16": (-32768, 32767), "int32": (-2147483648, 2147483647),
    "int64": (-9223372036854775808, 9223372036854775807),
    "uint8": (0, 255), "uint16": (0, 65535), "uint32": (0, 4294967295), "uint64": (0, 18446744073709551615),
}


TOP_LONG = 9.223372036854775807e18
TOP_UNSIGNED = 1.8446744073709551615e19


def _unsigned(v: Column) -> Column:
    """A whole double from 0 to 2**64 as decimal(20,0), digit by digit the same number; the top becomes 2**64 - 1."""
    upper = F.floor(v / F.lit(4294967296.0)).cast("long")
    lower = (v - upper.cast("double") * F.lit(4294967296.0)).cast("long")
    exact = (upper.cast("decimal(20,0)") * F.lit(4294967296).cast("decimal(10,0)") + lower.cast("decimal(20,0)")).cast("decimal(20,0)")
    top = F.lit(str(INTEGER_BOUNDS["uint64"][1])).cast("decimal(20,0)")
    return F.when(v >= F.lit(TOP_UNSIGNED), top).otherwise(exact)


def _half(v: Column) -> Column:
    """The nearest 16-bit float of a value from 0 to 1, as a double; halves go to the even neighbour."""
    exponent = F.greatest(F.floor(F.log2(F.nullif(v, F.lit(0.0)))), F.lit(-14)) - 10
    step = F.pow(F.lit(2.0), exponent)
    return F.when(F.isnan(v) | (v == 0), v).otherwise(F.rint(v / step) * step)


def map_values(stack: DataFrame, fn) -> DataFrame:
    """Apply a column function to every pixel value of either form."""
    if is_frames(stack):
        return stack.withColumn("px", F.transform("px", fn))
    return stack.withColumn("v", fn(F.col("v")))


def with_scalar(stack: DataFrame, scalar: Column, fn) -> DataFrame:
    """Apply ``fn(value, scalar)`` per pixel, with a global scalar from a subquery."""
    bound = stack.withColumn("_s", scalar)
    if is_frames(stack):
        bound = bound.withColumn("px", let(F.col("_s"), lambda s: F.transform("px", lambda v: fn(v, s))))
    else:
        bound = bound.withColumn("v", fn(F.col("v"), F.col("_s")))
    return bound.drop("_s")


def trim_frames(stack: DataFrame, front: int = 0, back: int = 0) -> DataFrame:
    """Drop frames at both ends and renumber from 0; both bounds reach the scan."""
    kept = stack.where((F.col("t") >= front) & (F.col("t") < frame_total(stack) - back))
    return kept.withColumn("t", F.col("t") - F.lit(front).cast("long"))


def inverse_frames(stack: DataFrame) -> DataFrame:
    """``1 / (v - (min - 1))``: the divisor is at least 1."""
    return with_scalar(stack, global_stat(stack, "min"), lambda v, low: F.lit(1.0) / (v - (low - F.lit(1.0))))


def subtract_minimum(stack: DataFrame) -> DataFrame:
    """Shift the stack so that its smallest value is 0."""
    return with_scalar(stack, global_stat(stack, "min"), lambda v, low: v - low)


def crop_to_common(stack: DataFrame, shifts: DataFrame, shape: tuple[int, int]) -> DataFrame:
    """Keep the area all rolled frames share, always on the origin side (pixel form).

    ``shifts(t, dy, dx)`` is read once for its largest absolute shift per axis.
    """
    h, w = shape
    cut_y = shifts.agg(F.max(F.abs("dy"))).scalar()
    cut_x = shifts.agg(F.max(F.abs("dx"))).scalar()
    return stack.where((F.col("y") < F.lit(h) - cut_y) & (F.col("x") < F.lit(w) - cut_x))


def norm_layer(stack: DataFrame, dtype: str = "uint8") -> DataFrame:
    """Rescale to the bounds of an output type, ints truncated.

    Infinite results become the bounds. NaN becomes 0 for integers and stays NaN for floats;
    a constant stack has no scale and counts as NaN everywhere. ``uint64`` is given as decimal(20,0),
    ``float16`` as doubles that a 16-bit float can hold.
    """
    whole = dtype in INTEGER_BOUNDS
    if not whole and dtype not in ("float16", "float32", "float64"):
        raise ValueError(f"unknown output type {dtype!r}")
    low_out, high_out = map(float, INTEGER_BOUNDS.get(dtype, (0, 1)))
    low, high = global_stat(stack, "min"), global_stat(stack, "max")
    # The scale is found once per row; a constant, NaN or infinite range makes it NaN or 0, and
    # the products below are then NaN as in plain floating-point arithmetic.
    bounds = stack.withColumn("_lo", low).withColumn("_span", high - F.col("_lo"))
    scale = F.when(F.col("_span") == 0, F.lit(float("nan"))).otherwise(F.lit(high_out - low_out) / F.nullif("_span", F.lit(0.0)))

    def rescale(v: Column, lowest: Column, factor: Column) -> Column:
        scaled = (v - lowest) * factor + F.lit(low_out)
        if not whole:
            kept = F.when(F.isnan(scaled), scaled).otherwise(F.least(F.greatest(scaled, F.lit(low_out)), F.lit(high_out)))
            return _half(kept) if dtype == "float16" else kept
        clipped = F.least(F.greatest(F.nanvl(scaled, F.lit(0.0)), F.lit(low_out)), F.lit(high_out))
        if dtype == "uint64":
            return _unsigned(clipped - F.pmod(clipped, F.lit(1.0)))
        # The top of a 64-bit range is no double, so it is set and not cast.
        return F.when(clipped >= F.lit(TOP_LONG), F.lit(INTEGER_BOUNDS["int64"][1])).otherwise(clipped.cast("long")) if dtype == "int64" else clipped.cast("long")

    bounds = bounds.withColumn("_scale", scale)
    if is_frames(stack):
        state = F.struct(F.col("_lo").alias("lo"), F.col("_scale").alias("scale"))
        made = bounds.withColumn("px", let(state, lambda b: F.transform("px", lambda v: rescale(v, b["lo"], b["scale"]))))
    else:
        made = bounds.withColumn("v", rescale(F.col("v"), F.col("_lo"), F.col("_scale")))
    return made.drop("_lo", "_span", "_scale")
