"""The two table forms of an image stack and the ways between them.

* pixel form ``(t long, y int, x int, v double)``: one row per pixel; a missing row is unknown.
* frame form ``(t long, h int, w int, px array<double>)``: one row per frame, row-major.

The frame form is the working form: whatever needs one frame only is a narrow map over it,
and time projections explode it straight into a partial aggregate, so no pixel is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRAME_COLS = ("t", "h", "w", "px")
PIXEL_COLS = ("t", "y", "x", "v")
ROI_PIXELS = "roi_id int, y int, x int, w double"
ROI_TABLE = (
    "roi_id int, atom long, area long, cy double, cx double, major double, "
    "minor double, eccentricity double, max_v double"
)


def check_form(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Raise ValueError unless ``df`` has the named columns with numeric coordinates."""
    types = {f.name: f.dataType for f in df.schema.fields}
    for name in cols:
        if name not in types:
            raise ValueError(f"column {name!r} is missing; found {df.columns}")
        kind = types[name].elementType if name == "px" and isinstance(types[name], T.ArrayType) else types[name]
        if not isinstance(kind, T.NumericType):
            raise ValueError(f"column {name!r} must be numeric, not {types[name].simpleString()}")
    return df


def is_frames(df: DataFrame) -> bool:
    return "px" in df.columns


def promote(frames: DataFrame) -> DataFrame:
    """Frames in the working type: 32-bit floats, or doubles if that is what they are.

    Stored stages keep this type, half the bytes; sums and averages over it are taken in doubles.
    """
    kind = frames.schema["px"].dataType.elementType
    return frames if isinstance(kind, T.DoubleType) else frames.withColumn("px", F.col("px").cast("array<float>"))


def as_type_of(frames: DataFrame, other: DataFrame) -> DataFrame:
    """``frames`` with the pixel type of ``other``."""
    return frames.withColumn("px", F.col("px").cast(other.schema["px"].dataType))


def frames_from(df: DataFrame, t: str, px: str, shape: tuple[int, int], dtype: str | None = "double") -> DataFrame:
    """Frame form of a table that already holds one array per frame; ``dtype`` None keeps its numbers as they are."""
    return df.select(
        F.col(t).cast("long").alias("t"),
        F.lit(shape[0]).cast("int").alias("h"),
        F.lit(shape[1]).cast("int").alias("w"),
        (F.col(px).cast(f"array<{dtype}>") if dtype else F.col(px)).alias("px"),
    )


def explode_frames(frames: DataFrame, *keep: str | Column, px: str = "px", value: str = "v") -> DataFrame:
    """Rows ``(t, y, x, value)`` plus ``keep``; stays in the scan's stage."""
    flat = frames.select("t", "w", *keep, F.posexplode(px).alias("_p", value))
    kept = [c for c in flat.columns if c not in ("t", "w", "_p", value)]
    return flat.select(
        "t",
        F.expr("cast(_p div w as int)").alias("y"),
        F.expr("cast(_p % w as int)").alias("x"),
        value,
        *kept,
    )


def to_pixels(stack: DataFrame) -> DataFrame:
    """Pixel form of either form."""
    if is_frames(stack):
        return explode_frames(check_form(stack, FRAME_COLS))
    return check_form(stack, PIXEL_COLS).select("t", "y", "x", "v")


def to_frames(pixels: DataFrame, shape: tuple[int, int], fill: float | None = 0.0) -> DataFrame:
    """Frame form of a pixel table; absent pixels become ``fill``.

    One group is one frame, so its size is fixed by ``shape`` and not by the data. Pixels outside
    ``shape``, and several rows for one pixel, are errors.
    """
    check_form(pixels, PIXEL_COLS)
    h, w = shape
    blank = np.nan if fill is None else float(fill)

    def scatter(batches):
        for batch in batches:
            cells = batch.column("cells")
            start = cells.offsets.to_numpy()
            part = cells.values
            pos, val = part.field("p").to_numpy(), part.field("v").to_numpy()
            out = np.full((len(cells), h * w), blank)
            row = np.repeat(np.arange(len(cells)), np.diff(start))
            places = row * (h * w) + pos[start[0]:start[-1]]
            if len(places) and np.bincount(places, minlength=out.size).max() > 1:
                raise ValueError("a frame has several values for one pixel")
            out.ravel()[places] = val[start[0]:start[-1]]
            yield frame_batch({"t": batch.column("t")}, out.reshape(-1, h, w))

    inside = F.col("y").between(0, h - 1) & F.col("x").between(0, w - 1)
    outside = F.raise_error(F.concat(F.lit(f"pixel outside of {shape}: "), F.concat_ws(", ", F.col("y").cast("string"), F.col("x").cast("string"))))
    place = F.when(inside, (F.col("y") * w + F.col("x")).cast("int")).otherwise(outside.cast("int"))
    cell = F.struct(place.alias("p"), F.col("v").cast("double").alias("v"))
    grouped = pixels.groupBy(F.col("t").cast("long").alias("t")).agg(F.collect_list(cell).alias("cells"))
    return grouped.mapInArrow(scatter, "t long, h int, w int, px array<double>")


def frame_batch(keys: dict, stack: np.ndarray) -> pa.RecordBatch:
    """An Arrow batch of frames from key columns and an ``(n, h, w)`` array."""
    n, h, w = stack.shape
    cols = dict(keys)
    cols["h"] = pa.array(np.full(n, h, dtype=np.int32))
    cols["w"] = pa.array(np.full(n, w, dtype=np.int32))
    cols["px"] = list_array(stack.reshape(n, h * w))
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def list_array(rows: np.ndarray, dtype=np.float64) -> pa.ListArray:
    n, k = rows.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(np.ascontiguousarray(rows, dtype=dtype).ravel())
    )


def batch_stacks(batch: pa.RecordBatch, column: str = "px"):
    """Yield ``(row numbers, (n, h, w) array)`` per frame shape in an Arrow batch."""
    heights, widths = batch.column("h").to_numpy(), batch.column("w").to_numpy()
    px = batch.column(column)
    flat = px.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    start = px.offsets.to_numpy()
    for h, w in sorted(set(zip(heights.tolist(), widths.tolist()))):
        rows = np.nonzero((heights == h) & (widths == w))[0]
        if len(rows) == len(batch):
            yield rows, flat[start[0]:start[-1]].reshape(-1, h, w)
        else:
            yield rows, np.stack([flat[start[r]:start[r + 1]] for r in rows]).reshape(-1, h, w)


def frame_total(stack: DataFrame) -> Column:
    """Number of frames as an uncorrelated scalar subquery; no join, no driver round trip."""
    return stack.agg((F.max("t") + 1).alias("n")).scalar()


def global_stat(stack: DataFrame, how: str) -> Column:
    """Global ``min`` or ``max`` of a stack as a scalar subquery."""
    agg = {"min": F.min, "max": F.max}[how]
    if is_frames(stack):
        inner = {"min": F.array_min, "max": F.array_max}[how]
        return stack.agg(agg(inner("px")).alias("s")).scalar()
    return stack.agg(agg("v").alias("s")).scalar()


#: Pixels of the grid that one task generates.
GRID_PIXELS = 4_000_000


def densify(pixels: DataFrame, shape: tuple[int, int], fill: float = 0.0) -> DataFrame:
    """Every pixel of every frame between the first and last ``t``; absent ones get ``fill``."""
    h, w = shape
    ends = pixels.agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    lo, hi = (0, -1) if ends["lo"] is None else (int(ends["lo"]), int(ends["hi"]))
    # A range has the partitions it is given, so a long time axis is generated by many tasks.
    fine = pixels.sparkSession.range(lo, hi + 1, 1, max(1, (hi + 1 - lo) * h * w // GRID_PIXELS + 1)).withColumnRenamed("id", "t")
    grid = fine.select("t", F.explode(F.sequence(F.lit(0), F.lit(h * w - 1))).alias("p")).select(
        "t", F.expr(f"cast(p div {w} as int)").alias("y"), F.expr(f"cast(p % {w} as int)").alias("x")
    )
    return grid.join(pixels, ["t", "y", "x"], "left").select(
        "t", "y", "x", F.coalesce(F.col("v"), F.lit(float(fill))).alias("v")
    )
