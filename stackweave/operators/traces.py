"""One time series per region of interest, and series operators on it.

Series windows are cut into time blocks with a halo, so no task ever holds the whole time
axis of a series: a block has ``block + 2 * halo`` frames at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackweave.functions.kernels import spline_taps
from stackweave.model import is_frames


#: Pixels of one tile of a frame where frames meet masks, and frames whose tiles share a key.
TILE, TIME_BLOCK = 4096, 1 << 14


def _frame_sums(frames: DataFrame, masks: DataFrame) -> DataFrame:
    """Weighted sums ``(roi_id, t, part, w_sum)`` of frames, tile by tile: pixels are never rows.

    Masks become runs of (place in the tile, weight) per region and tile; frames are cut into the same
    tiles as arrays. The join is on the tile and a block of time, so a camera of few tiles and many frames has many keys;
    masks are copied once per time block. The planner sees how large they are.
    """
    # One entry per frame shape, and the ends of time, in one pass over narrow columns.
    about = frames.agg(F.struct(F.collect_set("w").alias("ws"), F.min("t").alias("first"), F.max("t").alias("last"))).scalar()
    flat = masks.withColumn("_about", about).withColumn("fw", F.explode("_about.ws")).where("x >= 0 and x < fw and y >= 0")
    flat = flat.withColumn("p", F.col("y").cast("long") * F.col("fw") + F.col("x"))
    cell = F.struct((F.col("p") % TILE).cast("int").alias("i"), F.col("w").alias("k"))
    runs = flat.groupBy("roi_id", "fw", F.expr(f"cast(p div {TILE} as int)").alias("tile")).agg(
        F.collect_list(cell).alias("cells"), F.max("w_sum").alias("w_sum"), F.first("_about").alias("_about"))
    block = lambda t: F.floor(t / F.lit(TIME_BLOCK)).cast("long")
    runs = runs.withColumn("tb", F.explode(F.sequence(block(F.col("_about.first")), block(F.col("_about.last"))))).drop("_about")
    cut = F.transform(F.sequence(F.lit(0), F.expr(f"cast((size(px) - 1) div {TILE} as int)")), lambda c: F.slice("px", c * TILE + 1, F.lit(TILE)))
    tiles = frames.where(F.size("px") > 0).select("t", block(F.col("t")).alias("tb"), F.col("w").alias("fw"), F.posexplode(cut).alias("tile", "v"))
    inside = F.filter("cells", lambda c: c["i"] < F.size("v"))
    part = F.aggregate(inside, F.lit(0.0), lambda total, c: total + c["k"] * F.coalesce(F.get("v", c["i"]).cast("double"), F.lit(0.0)))
    met = tiles.join(runs, ["fw", "tile", "tb"]).where(F.size(inside) > 0)
    return met.select("roi_id", "t", part.alias("part"), "w_sum")


def roi_traces(
    stack: DataFrame, roi_pixels: DataFrame, rois: DataFrame | None = None, space: tuple[str, ...] = ("y", "x")
) -> DataFrame:
    """Weighted mean of each region's pixels in each frame: ``(roi_id, t, value)``.

    The weights are summed over the whole mask, so a sparse stack still divides by all of
    it. Regions listed in ``rois`` without any pixel get a NULL trace. Frames meet masks tile by tile as
    arrays; pixel tables join them by coordinate. Either way one row per region, frame and task is shuffled.
    """
    weight = roi_pixels.groupBy("roi_id").agg(F.sum("w").alias("w_sum"))
    masks = roi_pixels.join(weight, "roi_id").select("roi_id", *space, "w", "w_sum")
    if is_frames(stack):
        parts = _frame_sums(stack, masks)
    else:
        parts = stack.join(masks, list(space)).select("roi_id", "t", (F.col("w") * F.col("v")).alias("part"), "w_sum")
    traces = parts.groupBy("roi_id", "t").agg((F.sum("part") / F.nullif(F.max("w_sum"), F.lit(0.0))).alias("value"))
    if rois is None:
        return traces
    empty = rois.join(roi_pixels, "roi_id", "left_anti").agg(F.collect_set("roi_id").alias("ids")).scalar()
    blank = stack.select("t").distinct().select(F.explode(empty).alias("roi_id"), "t")
    return traces.unionByName(blank.withColumn("value", F.lit(None).cast("double")))


def dense_series(series: DataFrame, fill: float = 0.0, key: str = "roi_id") -> DataFrame:
    """Give every series a value at every ``t`` between the overall first and last."""
    lo, hi = series.agg(F.min("t")).scalar(), series.agg(F.max("t")).scalar()
    ids = series.select(key).distinct().withColumn("lo", lo).withColumn("hi", hi)
    # Two steps, so that no row ever holds a whole time axis.
    step = 4096
    coarse = ids.select(key, "lo", "hi", F.explode(F.expr(f"sequence(0L, (hi - lo) div {step})")).alias("c"))
    grid = coarse.select(key, F.explode(F.expr(f"sequence(lo + c * {step}, least(hi, lo + c * {step} + {step - 1}))")).alias("t"))
    return grid.join(series, [key, "t"], "left").select(
        key, "t", F.coalesce(F.col("value"), F.lit(float(fill))).alias("value")
    )


def time_blocks(rows: DataFrame, block: int, halo: int) -> DataFrame:
    """Copy each row into every time block whose haloed span holds it.

    Adds ``tb`` and ``core``; a row is in the core of exactly one block.
    """
    own = f"cast(floor(t / {block}) as long)"
    copies = F.expr(f"sequence(cast(floor((t - {halo}) / {block}) as long), cast(floor((t + {halo}) / {block}) as long))")
    return rows.withColumn("tb", F.explode(copies)).withColumn("core", F.expr(f"tb = {own}"))


def windowed(rows: DataFrame, keys: list[str], block: int, halo: int, **columns) -> DataFrame:
    """Add window columns over ``t - halo .. t + halo`` of each series, block by block.

    Each value is ``fn(window_by_t, ordered_window)``: the first spans the halo by frame
    number, the second is the plain order inside the block for lag and lead.
    """
    order = Window.partitionBy(*keys, "tb").orderBy("t")
    blocked = time_blocks(rows, block, halo)
    for name, fn in columns.items():
        blocked = blocked.withColumn(name, fn(order.rangeBetween(-halo, halo), order))
    return blocked.where("core").drop("tb", "core")


def rolling_baseline(
    rows: DataFrame, half_window: int, quantile: float, keys: list[str], value: str = "value", block: int = 4096
) -> DataFrame:
    """Add ``f0``: the interpolated quantile over ``t - half_window .. t + half_window``."""
    return windowed(rows, keys, block, half_window, f0=lambda span, _: F.percentile(value, F.lit(quantile)).over(span))


def dff(
    rows: DataFrame, half_window: int, quantile: float, keys: list[str], bias: Column | None = None,
    value: str = "value", block: int = 4096,
) -> DataFrame:
    """``(b - f0) / f0`` with ``b`` the biased series; the default bias lifts the minimum to 1."""
    if bias is None:
        bias = F.lit(1.0) - rows.agg(F.min(value)).scalar()
    lifted = rows.withColumn(value, F.col(value) + bias)
    base = rolling_baseline(lifted, half_window, quantile, keys, value, block)
    return base.withColumn("dff", F.try_divide(F.col(value) - F.col("f0"), F.col("f0")))


def wavelet_1d(series: DataFrame, scale: int, key: str = "roi_id", block: int = 4096) -> DataFrame:
    """A-trous transform of dense series: rows ``(key, t, level, value)``.

    Levels 1 to ``scale`` are the details, level ``scale + 1`` the residual; they add up to
    the input. Beyond the ends the edge sample repeats. The halo covers all levels.
    """
    halo = 2 ** (scale + 1) - 2
    order = Window.partitionBy(key, "tb").orderBy("t")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = time_blocks(series, block, halo).withColumn("c0", F.col("value"))
    for level in range(1, scale + 1):
        prev = f"c{level - 1}"
        first, last = F.first(prev).over(whole), F.last(prev).over(whole)
        smooth = F.lit(0.0)
        for d, weight in spline_taps(level).items():
            if d < 0:
                near = F.coalesce(F.lag(prev, -d).over(order), first)
            elif d > 0:
                near = F.coalesce(F.lead(prev, d).over(order), last)
            else:
                near = F.col(prev)
            smooth = smooth + F.lit(weight) * near
        rows = rows.withColumn(f"c{level}", smooth)
    parts = [
        F.struct(F.lit(j).alias("level"), (F.col(f"c{j - 1}") - F.col(f"c{j}")).alias("value"))
        for j in range(1, scale + 1)
    ]
    parts.append(F.struct(F.lit(scale + 1).alias("level"), F.col(f"c{scale}").alias("value")))
    return rows.where("core").select(key, "t", F.inline(F.array(*parts)))
