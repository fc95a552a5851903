"""Regions of interest: find them in atom images, describe, merge and draw them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stackweave.functions.arrays import let, mean, spread
from stackweave.functions.kernels import flood, spread_labels
from stackweave.model import ROI_PIXELS, ROI_TABLE, explode_frames
from stackweave.operators.filters import detail
from stackweave.operators.frames import add_images
from stackweave.operators.graph import connected_groups
from stackweave.session import Scratch


@dataclass(frozen=True)
class ExtractParams:
    """Limits of the region search, in pixels and standard deviations."""

    significance: float = 3.0
    wavelet_scale: int = 3
    noise: float = 3.0
    major_axis: tuple[float, float] = (0.0, 25.0)
    below_peak: float = 0.8
    peak_distance: float = 16.0
    area: tuple[float, float] = (25, 600)
    eccentricity: tuple[float, float] = (0.0, 0.9)


@dataclass(frozen=True)
class MergeParams:
    alignment: float = 0.6
    overlap: float = 0.6
    keep_fraction: float = 0.01


def empty_rois(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """No regions: the region table and its pixels, with their schemas."""
    return spark.createDataFrame([], ROI_TABLE), spark.createDataFrame([], ROI_PIXELS)


# -- per image ---------------------------------------------------------------------------


def noise_level(px: Column, significance: float = 3.0) -> Column:
    """Standard deviation of the values within ``significance`` deviations of the mean."""
    stats = F.struct(mean(px).alias("m"), spread(px).alias("s"))
    kept = let(stats, lambda k: F.filter(px, lambda v: F.abs(v - k["m"]) <= k["s"] * significance))
    return let(kept, spread)


def significant_mask(frames: DataFrame, noise: float = 3.0, significance: float = 3.0, column: str = "px", out: str = "mask") -> DataFrame:
    """Add a 0/1 image of the pixels above ``noise`` times the image's noise level."""
    px = F.col(column)
    mark = let(noise_level(px, significance) * noise, lambda n: F.transform(px, lambda v: F.when(v > n, 1.0).otherwise(0.0)))
    return frames.withColumn(out, mark)


def region_labels(masks: np.ndarray) -> np.ndarray:
    return np.stack([spread_labels(m > 0) for m in masks])


def peak_marks(stack: np.ndarray) -> np.ndarray:
    wide = np.pad(stack, ((0, 0), (1, 1), (1, 1)), constant_values=-np.inf)
    views = np.lib.stride_tricks.sliding_window_view(wide, (3, 3), axis=(1, 2))
    return stack >= views.max(axis=(3, 4))


def label_regions(frames: DataFrame, column: str = "mask", out: str = "region") -> DataFrame:
    """Add the label image of 8-connected regions: 1 + the first pixel of the region, or 0."""
    return add_images(frames, lambda masks: [region_labels(masks)], [column], [out])


def mark_peaks(frames: DataFrame, column: str = "px", out: str = "peak") -> DataFrame:
    """Add a 0/1 image of the pixels no 8-neighbour exceeds."""
    return add_images(frames, lambda stack: [peak_marks(stack)], [column], [out])


# -- per region --------------------------------------------------------------------------


def region_props(pixels: DataFrame, *keys: str, value: str = "w") -> DataFrame:
    """Area, centroid, axes, eccentricity and peak value per region.

    Axes are ``4 * sqrt`` of the eigenvalues of the pixel covariance. Sums of whole numbers
    make it one partial aggregate, exact for any size of region.
    """
    y, x = F.col("y").cast("long"), F.col("x").cast("long")
    sums = pixels.groupBy(*keys).agg(
        F.count("*").alias("area"), F.sum(y).alias("sy"), F.sum(x).alias("sx"), F.sum(y * y).alias("syy"),
        F.sum(x * x).alias("sxx"), F.sum(y * x).alias("sxy"), F.max(value).alias("max_v"),
    )
    n = F.col("area")
    cy, cx = F.col("sy") / n, F.col("sx") / n
    vy, vx, vxy = F.col("syy") / n - cy * cy, F.col("sxx") / n - cx * cx, F.col("sxy") / n - cy * cx
    half, gap = (vy + vx) / 2, F.sqrt((vy - vx) * (vy - vx) / 4 + vxy * vxy)
    shaped = sums.select(
        *keys, "area", cy.alias("cy"), cx.alias("cx"), F.greatest(half + gap, F.lit(0.0)).alias("l1"),
        F.greatest(half - gap, F.lit(0.0)).alias("l2"), "max_v",
    )
    flat = F.col("l1") > 1e-12
    return shaped.select(
        *keys, "area", "cy", "cx",
        (F.sqrt("l1") * 4).alias("major"), (F.sqrt("l2") * 4).alias("minor"),
        F.when(flat, F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("l2") / F.when(flat, F.col("l1")).otherwise(1.0)))).otherwise(0.0).alias("eccentricity"),
        "max_v",
    )


def within(props: DataFrame, **limits: tuple[float, float]) -> DataFrame:
    """Regions whose named properties lie in the closed ranges."""
    for name, (low, high) in limits.items():
        props = props.where(F.col(name).between(low, high))
    return props


def keep_high_peaks(pixels: DataFrame, peaks: DataFrame, below: float, *keys: str, value: str = "wav") -> DataFrame:
    """Peaks that enough of their region lies below (a share of at least ``below``)."""
    region = Window.partitionBy(*keys)
    under = (F.rank().over(region.orderBy(value)) - 1) / F.count("*").over(region)
    ranked = pixels.withColumn("_under", under).where(F.col("_under") >= below)
    return peaks.join(ranked.select(*keys, "y", "x"), [*keys, "y", "x"], "left_semi")


def keep_distant_peaks(peaks: DataFrame, distance: float, key: str = "t", value: str = "wav") -> DataFrame:
    """Drop each peak with a stronger one of the same image closer than ``distance``.

    Peaks meet only those of the nine grid cells around them, and a cell of side ``distance``
    has a fixed number of pixels. Of equals the first in row-major order is the stronger.
    """
    if distance <= 0:
        return peaks
    side = max(int(np.ceil(distance)), 1)
    cell = peaks.withColumn("_cy", F.expr(f"y div {side}")).withColumn("_cx", F.expr(f"x div {side}"))
    near = F.array(*[F.struct((F.col("_cy") + dy).alias("_cy"), (F.col("_cx") + dx).alias("_cx")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)])
    rivals = cell.select(F.col(key).alias("_k"), F.col("y").alias("_y"), F.col("x").alias("_x"), F.col(value).alias("_v"), F.inline(near))
    mine = cell.alias("p")
    other = rivals.withColumnRenamed("_cy", "_ry").withColumnRenamed("_cx", "_rx")
    gap_y, gap_x = F.col("y") - F.col("_y"), F.col("x") - F.col("_x")
    stronger = (F.col("_v") > F.col(value)) | (
        (F.col("_v") == F.col(value)) & ((F.col("_y") < F.col("y")) | ((F.col("_y") == F.col("y")) & (F.col("_x") < F.col("x"))))
    )
    beaten = (F.col(key) == F.col("_k")) & (F.col("_cy") == F.col("_ry")) & (F.col("_cx") == F.col("_rx")) & stronger & (
        gap_y * gap_y + gap_x * gap_x < distance * distance
    )
    return mine.join(other, beaten, "left_anti").drop("_cy", "_cx")


def split_regions(pixels: DataFrame, peaks: DataFrame) -> DataFrame:
    """Divide regions ``(t, region)`` among their peaks by growing the peaks: adds ``seg``.

    A group is one image, and all its regions grow together. Regions without a peak disappear.
    """
    seeded = pixels.join(peaks.select("t", "region", "y", "x", F.lit(1).alias("seed")), ["t", "region", "y", "x"], "left")
    names = seeded.columns
    kept = [c for c in names if c != "seed"]

    def grow(table: pa.Table) -> pa.Table:
        y, x = table.column("y").to_numpy(), table.column("x").to_numpy()
        y, x = y - y.min(), x - x.min()
        region = np.zeros((y.max() + 1, x.max() + 1), dtype=np.int64)
        region[y, x] = np.unique(table.column("region").to_numpy(), return_inverse=True)[1] + 1
        marked = np.nonzero(table.column("seed").is_valid().to_numpy(zero_copy_only=False))[0]
        order = marked[np.lexsort((x[marked], y[marked]))]
        seeds = np.zeros_like(region)
        seeds[y[order], x[order]] = np.arange(1, len(order) + 1)
        seg = flood(region, seeds)[y, x]
        return table.select(kept).append_column("seg", pa.array(seg, pa.int64())).filter(pa.array(seg > 0))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in seeded.schema.fields if f.name != "seed")
    return seeded.groupBy("t").applyInArrow(grow, f"{fields}, seg long")


def extract_rois(atoms: DataFrame, scratch: Scratch, params: ExtractParams = ExtractParams()) -> tuple[DataFrame, DataFrame]:
    """Regions found in atom images ``(atom, h, w, px)``: the region table and its pixels.

    Wavelet detail, noise, significant pixels and connected regions are narrow steps on the
    images; from there on only significant pixels travel. Regions that are too long fall
    back to the next finer detail once. ``w`` of a region pixel is the atom's value there.
    """
    p = params
    scale, finer = (0, p.wavelet_scale, p.wavelet_scale), (0, *[max(p.wavelet_scale - 1, 1)] * 2)
    images = atoms.withColumnRenamed("atom", "t")
    images = add_images(images, lambda px: [detail(px, scale), detail(px, finer)], ["px"], ["wav", "fine"])
    images = significant_mask(images, p.noise, p.significance, "wav", "wav_mask")
    images = significant_mask(images, p.noise, p.significance, "fine", "fine_mask")
    images = add_images(
        images, lambda wav, mask, fine: [region_labels(mask), region_labels(mask * fine), peak_marks(wav)],
        ["wav", "wav_mask", "fine_mask"], ["region", "fine_region", "peak"],
    )
    # Read several times below, so the numpy steps run once and their few pixels are kept.
    rows = scratch.write(_significant_rows(images, F.arrays_zip("px", "wav", "region", "fine_region", "peak")))
    fits = within(region_props(rows, "t", "region"), major=p.major_axis).select("t", "region", F.lit(True).alias("fits"))
    rows = rows.join(fits, ["t", "region"], "left").withColumn(
        "region", F.when(F.col("fits"), F.col("region")).when(F.col("fine") > 0, -F.col("fine"))
    ).where("region IS NOT NULL").drop("fits", "fine")
    peaks = rows.where("peak").select("t", "region", "y", "x", "wav")
    peaks = keep_distant_peaks(keep_high_peaks(rows, peaks, p.below_peak, "t", "region"), p.peak_distance)
    parts = scratch.write(split_regions(rows.select("t", "region", "y", "x", "w"), peaks))
    props = within(region_props(parts, "t", "region", "seg"), area=p.area, eccentricity=p.eccentricity)
    numbered = scratch.write(number_rois(props))
    pixels = parts.join(numbered.select("t", "region", "seg", "roi_id"), ["t", "region", "seg"])
    table = numbered.select("roi_id", F.col("t").alias("atom"), "area", "cy", "cx", "major", "minor", "eccentricity", "max_v")
    return table, pixels.select("roi_id", "y", "x", "w")


def _significant_rows(images: DataFrame, cells: Column) -> DataFrame:
    flat = explode_frames(images.withColumn("_all", cells), px="_all", value="c").where("c.region > 0")
    return flat.select(
        "t", "y", "x", F.col("c.px").alias("w"), F.col("c.wav").alias("wav"), F.col("c.region").cast("long").alias("region"),
        F.col("c.fine_region").cast("long").alias("fine"), (F.col("c.peak") > 0).alias("peak"),
    )


def number_rois(props: DataFrame, bucket: int = 1000) -> DataFrame:
    """Number regions from 1 by atom, region and segment.

    Regions are counted per ``bucket`` atoms and ranked inside; the window over the counts is that much
    shorter than the list of atoms, which may be as long as the stack.
    """
    dealt = props.withColumn("_b", F.expr(f"t div {bucket}"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_b").agg(F.count("*").alias("n")).select("_b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("t", "region", "seg"))
    return dealt.join(starts, "_b").withColumn("roi_id", (F.col("start") + rank).cast("int")).drop("start", "_b")


def renumber(roi_pixels: DataFrame, bucket: int = 1000) -> DataFrame:
    """Replace region numbers by 1..n in the same order.

    Positions are counted per bucket of numbers; the window over the buckets is ``bucket``
    times shorter than the list of regions.
    """
    ids = roi_pixels.select("roi_id").distinct().withColumn("_b", F.expr(f"roi_id div {bucket}"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = ids.groupBy("_b").agg(F.count("*").alias("n")).select("_b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("roi_id"))
    numbers = ids.join(starts, "_b").select("roi_id", (F.col("start") + rank).cast("int").alias("_new"))
    return roi_pixels.join(numbers, "roi_id").drop("roi_id").withColumnRenamed("_new", "roi_id").select("roi_id", "y", "x", "w")


# -- merging -----------------------------------------------------------------------------


def unit_pixels(roi_pixels: DataFrame) -> DataFrame:
    """Region pixels with unit-norm weight ``u`` and the region's area ``n``; zero pixels dropped."""
    live = roi_pixels.where("w <> 0")
    norms = live.groupBy("roi_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.count("*").alias("n"))
    return live.join(norms, "roi_id").select("roi_id", "y", "x", (F.col("w") / F.col("norm")).alias("u"), "n")


def copy_groups(roi_pixels: DataFrame) -> DataFrame:
    """The lowest region with exactly the same pixels and weights: ``(roi_id, rep)``.

    Regions are told apart by their pixel count and 192 bits of hashes, xor-ed over the
    pixels: partial aggregates, so that no region is collected. A group of any number of
    copies is then one partial minimum.
    """
    bits = [F.bit_xor(F.xxhash64(F.lit(salt), "y", "x", "w")).alias(f"h{salt}") for salt in (1, 2, 3)]
    prints = roi_pixels.where("w <> 0").groupBy("roi_id").agg(F.count("*").alias("n"), *bits)
    same = ["n", "h1", "h2", "h3"]
    return prints.join(prints.groupBy(*same).agg(F.min("roi_id").alias("rep")), same).select("roi_id", "rep")


#: Words of 64 slots in the sketch of a region's pixels.
SKETCH_WORDS = 4


def _sketch() -> list[Column]:
    """Bits of the slots that the pixels of a region fall into: ``s0``, ``s1``, ..."""
    slot, whole = F.expr(f"cast(pmod(xxhash64(y, x), {64 * SKETCH_WORDS}) as int)"), Window.partitionBy("roi_id")
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(y, x), {64 * SKETCH_WORDS}) % 64 as int))")
    return [F.bit_or(F.when(F.floor(slot / 64) == k, bit).otherwise(F.lit(0).cast("long"))).over(whole).alias(f"s{k}") for k in range(SKETCH_WORDS)]


def prefixes(unit: DataFrame, params: MergeParams) -> DataFrame:
    """The pixels by which a region can be found by any region it aligns with, each with the region's sketch.

    Pixels are taken from the rarest to the most common. Once the rest of a region has a norm
    below the alignment it cannot reach that product with a unit image, so two aligned regions
    share a pixel before that point in both. Common pixels come last and are mostly left out.
    ``rest`` and ``after`` are the squared norm and the number of the pixels still to come; norms are of 32 bits,
    which ``_promising`` leaves room for.
    """
    rarity = unit.groupBy("y", "x").agg(F.count("*").alias("freq"))
    order = Window.partitionBy("roi_id").orderBy("freq", "y", "x")
    used = F.sum(F.col("u") * F.col("u")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = unit.join(rarity, ["y", "x"]).withColumn("rest", 1.0 - used).withColumn("after", F.col("n") - F.row_number().over(order))
    reach = F.col("rest") + F.col("u") * F.col("u") + 1e-9 >= params.alignment * params.alignment
    short = [F.col("u").cast("float").alias("u"), F.col("rest").cast("float").alias("rest"), F.col("after").cast("int").alias("after"), F.col("n").cast("int").alias("n")]
    sketched = ranked.select("roi_id", "y", "x", "u", "rest", "after", "n", *_sketch())
    return sketched.where(reach).select("roi_id", "y", "x", *short, *[f"s{k}" for k in range(SKETCH_WORDS)])


def _side(keys: DataFrame, name: str) -> DataFrame:
    carried = [c for c in keys.columns if c not in ("roi_id", "y", "x")]
    return keys.select(F.col("roi_id").alias(name), "y", "x", *[F.col(c).alias(f"{c}_{name}") for c in carried])


def _may_share(p: MergeParams) -> Column:
    """Whether two regions can have enough pixels in common, whatever pixel they meet at.

    Every slot that only one of them has holds a pixel of its own at least, so this many are not shared.
    """
    def left(one: str, other: str) -> Column:
        own = [F.bit_count(F.col(f"s{k}_{one}").bitwiseAND(F.bitwise_not(F.col(f"s{k}_{other}")))) for k in range(SKETCH_WORDS)]
        return F.col(f"n_{one}") - sum(own[1:], own[0])

    return F.least(left("a", "b"), left("b", "a")) >= p.overlap * F.least("n_a", "n_b") - 1e-6


def _promising(p: MergeParams) -> Column:
    """Whether regions meeting at their first common pixel can still reach both thresholds.

    Pairs also meet at later pixels, where the bound may be too low; that does no harm, as
    the first one lies in both prefixes and keeps every pair that qualifies.
    """
    ahead = F.sqrt(F.greatest(F.col("rest_a").cast("double"), F.lit(0.0)) * F.greatest(F.col("rest_b").cast("double"), F.lit(0.0)))
    aligned = F.col("u_a").cast("double") * F.col("u_b") + ahead + 1e-6 >= p.alignment
    shared = 1 + F.least("after_a", "after_b") >= p.overlap * F.least("n_a", "n_b") - 1e-6
    return aligned & shared & _may_share(p)


def measure_pairs(pairs: DataFrame, unit: DataFrame) -> DataFrame:
    """Alignment and overlap of region pairs ``(a, b)``; pairs without a common pixel vanish."""
    left = unit.select(F.col("roi_id").alias("a"), "y", "x", F.col("u").alias("ua"), F.col("n").alias("na"))
    right = unit.select(F.col("roi_id").alias("b"), "y", "x", F.col("u").alias("ub"), F.col("n").alias("nb"))
    met = pairs.join(left, "a").join(right, ["b", "y", "x"])
    sums = met.groupBy("a", "b").agg(
        F.sum(F.col("ua") * F.col("ub")).alias("alignment"),
        (F.count("*") / F.least(F.max("na"), F.max("nb"))).alias("overlap"),
    )
    return sums


def _linked(measured: DataFrame, p: MergeParams) -> DataFrame:
    # Products of equal images may fall short of 1 by rounding.
    return measured.where((F.col("alignment") >= p.alignment - 1e-9) & (F.col("overlap") >= p.overlap - 1e-9))


def similar_pairs(roi_pixels: DataFrame, scratch: Scratch, params: MergeParams = MergeParams()) -> DataFrame:
    """All pairs of distinct region images to be merged: ``(a, b, alignment, overlap)``, a < b.

    Exact copies stand for one image under their lowest number (see ``copy_groups``).
    """
    unit, keys, _ = _searchable(roi_pixels, scratch, params)
    met = _side(keys, "a").join(_side(keys, "b"), ["y", "x"]).where((F.col("a") < F.col("b")) & _promising(params))
    met = scratch.write(met.select("a", "b").distinct())
    return scratch.write(_linked(measure_pairs(met, unit), params))


def _searchable(roi_pixels: DataFrame, scratch: Scratch, params: MergeParams) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Unit images and prefixes of the distinct images, and the copies; written, as each is read often."""
    copies = scratch.write(copy_groups(roi_pixels))
    distinct = copies.where("roi_id = rep").select("roi_id")
    unit = scratch.write(unit_pixels(roi_pixels).join(distinct, "roi_id", "left_semi"))
    return unit, scratch.write(prefixes(unit, params)), copies


def merge_groups(roi_pixels: DataFrame, scratch: Scratch, params: MergeParams = MergeParams()) -> DataFrame:
    """The group of every region that merges with another: ``(id, grp)``.

    Only connections matter here, so not every similar pair is formed. Copies hang on one
    image. Then each prefix pixel ties its regions to its lowest one; the regions that this
    has not joined to the pixel's main group are the only ones compared with all others.
    """
    unit, keys, copies = _searchable(roi_pixels, scratch, params)
    searched = scratch.step
    stars = copies.where("roi_id <> rep").select(F.col("rep").alias("a"), F.col("roi_id").alias("b"))
    told = ["roi_id", "n", *[f"s{k}" for k in range(SKETCH_WORDS)]]
    hubs = keys.groupBy("y", "x").agg(F.min(F.struct(*told)).alias("h")).select("y", "x", "h.*")
    spokes = _side(keys.select("y", "x", *told), "b").join(_side(hubs, "a"), ["y", "x"]).where((F.col("a") != F.col("b")) & _may_share(params))
    spokes = scratch.write(spokes.select("a", "b").distinct())
    first = scratch.write(_linked(measure_pairs(spokes, unit), params).select("a", "b").union(stars.select("a", "b")))
    known = connected_groups(first, scratch)
    member = keys.join(known.withColumnRenamed("id", "roi_id"), "roi_id", "left").withColumn("grp", F.coalesce("grp", "roi_id"))
    member = scratch.write(member)
    scratch.drop_before(searched)  # the keys, which members now hold with their groups
    members = scratch.step
    sizes = member.groupBy("y", "x", "grp").agg(F.count("*").alias("n"))
    main = sizes.groupBy("y", "x").agg(F.max_by("grp", F.struct("n", "grp")).alias("main"))
    outside = scratch.write(member.join(main, ["y", "x"]).where("grp <> main").drop("main"))
    met = _side(outside, "a").join(_side(member, "b"), ["y", "x"]).where((F.col("grp_a") != F.col("grp_b")) & _promising(params))
    rest = scratch.write(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for step in (members, members + 1):
        scratch.drop_before(step)
    second = scratch.write(_linked(measure_pairs(rest, unit), params).select("a", "b"))
    scratch.drop_before(searched - 1)
    return join_groups(known, second, scratch)


def join_groups(known: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``known(id, grp)`` after further ``edges(a, b)``: only the edges between groups are contracted."""
    ends = [known.select(F.col("id").alias(c), F.col("grp").alias(f"grp_{c}")) for c in ("a", "b")]
    between = edges.join(ends[0], "a", "left").join(ends[1], "b", "left")
    between = between.select("a", "b", F.coalesce("grp_a", "a").alias("ga"), F.coalesce("grp_b", "b").alias("gb"))
    fused = connected_groups(between.where("ga <> gb").select(F.col("ga").alias("a"), F.col("gb").alias("b")), scratch)
    fused = fused.select(F.col("id").alias("grp"), F.col("grp").alias("lower"))
    pairs = F.array(F.struct(F.col("a").alias("id"), F.col("ga").alias("grp")), F.struct(F.col("b").alias("id"), F.col("gb").alias("grp")))
    members = known.select("id", "grp").union(between.select(F.inline(pairs))).distinct()
    return scratch.write(members.join(fused, "grp", "left").select("id", F.coalesce("lower", "grp").alias("grp")))


def merge_rois(roi_pixels: DataFrame, scratch: Scratch, params: MergeParams = MergeParams()) -> DataFrame:
    """Fuse connected regions: the mean image of a group, without its faintest pixels.

    Groups take their lowest region number. The result does not depend on the row order.
    """
    groups = merge_groups(roi_pixels, scratch, params)
    tagged = roi_pixels.join(groups.withColumnRenamed("id", "roi_id"), "roi_id", "left")
    # Read for members and sums: written once, so the join with the groups runs once.
    tagged = scratch.write(tagged.select(F.coalesce("grp", "roi_id").alias("grp"), "roi_id", "y", "x", "w"))
    members = tagged.select("grp", "roi_id").distinct().groupBy("grp").agg(F.count("*").alias("members"))
    sums = tagged.groupBy("grp", "y", "x").agg(F.sum("w").alias("w")).join(members, "grp")
    fused = scratch.write(sums.select("grp", "y", "x", (F.col("w") / F.col("members")).alias("w")))
    tops = fused.groupBy("grp").agg(F.max("w").alias("top"))
    kept = fused.join(tops, "grp").where(F.col("w") >= F.col("top") * params.keep_fraction)
    return kept.select(F.col("grp").alias("roi_id"), "y", "x", "w")


# -- drawing -----------------------------------------------------------------------------


def masks_of(roi_pixels: DataFrame) -> DataFrame:
    """Binary masks: the pixels above 0 with weight 1."""
    return roi_pixels.where("w > 0").withColumn("w", F.lit(1.0))


def label_image(roi_pixels: DataFrame, shape: tuple[int, int], label: str = "roi_id") -> DataFrame:
    """The highest label of every pixel, 0 without one: ``(y, x, label, label8)``.

    ``label8`` keeps the lowest 8 bits. The grid has one row per pixel of one image, made in
    pieces of one image row.
    """
    h, w = shape
    top = roi_pixels.groupBy("y", "x").agg(F.max(F.col(label).cast("long")).alias("label"))
    grid = roi_pixels.sparkSession.range(h).select(
        F.col("id").cast("int").alias("y"), F.explode(F.sequence(F.lit(0), F.lit(w - 1))).alias("x")
    )
    filled = grid.join(top, ["y", "x"], "left").withColumn("label", F.coalesce("label", F.lit(0).cast("long")))
    return filled.withColumn("label8", F.col("label").bitwiseAND(F.lit(255)).cast("int"))


def roi_contours(roi_pixels: DataFrame) -> DataFrame:
    """Outline of each mask grown by one pixel towards +y and +x: ``(roi_id, ys, xs)``.

    Outline pixels miss at least one of their four neighbours. They are sorted by the angle
    ``atan2(x - cx, y - cy)`` about their centroid; angles equal to 9 places go by position.
    """
    steps = F.array(*[F.struct((F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x")) for dy in (0, 1) for dx in (0, 1)])
    grown = roi_pixels.where("w <> 0").select("roi_id", F.inline(steps)).distinct()
    # Every mask pixel counts itself once and tells its four neighbours about it.
    votes = F.array(*[
        F.struct((F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x"), F.lit(int(dy == dx == 0)).alias("self"))
        for dy, dx in ((0, 0), (0, 1), (0, -1), (1, 0), (-1, 0))
    ])
    seen = grown.select("roi_id", F.inline(votes)).groupBy("roi_id", "y", "x").agg(F.sum("self").alias("self"), F.count("*").alias("votes"))
    line = seen.where("self = 1 AND votes < 5").select("roi_id", "y", "x")
    own = Window.partitionBy("roi_id")
    turned = line.withColumn("cy", F.avg("y").over(own)).withColumn("cx", F.avg("x").over(own))
    point = F.struct(F.round(F.atan2(F.col("x") - F.col("cx"), F.col("y") - F.col("cy")), 9).alias("a"), "y", "x")
    lists = turned.groupBy("roi_id").agg(F.array_sort(F.collect_list(point)).alias("pts"))
    return lists.select("roi_id", F.col("pts.y").alias("ys"), F.col("pts.x").alias("xs"))
