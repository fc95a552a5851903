"""Regions of images cut into tiles: labels and splits that cross tile borders.

The tile form is ``(t, y0, x0, h, w, px)``: rectangles that cover an image without overlap, all cut along the same
lines. No task ever holds more than a tile with the pixels around it; what is shuffled are border pixels and names
of regions. Images may be of any size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave.functions.kernels import spread_labels
from stackweave.model import batch_stacks, list_array
from stackweave.operators.graph import connected_groups
from stackweave.session import Scratch

TILE_KEY = ("t", "y0", "x0")
PLACE = "t long, y0 int, x0 int, h int, w int"
FAR = np.iinfo(np.int64).max
#: Pixels of the small tiles that are worked on together, about.
TOGETHER_PIXELS = 1 << 17


def cut_tiles(frames: DataFrame, size: tuple[int, int], *columns: str) -> DataFrame:
    """Tiles of at most ``size`` pixels of frames ``(t, h, w, ...)``, with each of the named image columns (``px``).

    A narrow map: a frame becomes tile rows in its own task.
    """
    columns = columns or ("px",)
    by, bx = size

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times = batch.column("t").to_numpy()
            stacks = [dict((tuple(rows.tolist()), stack) for rows, stack in batch_stacks(batch, c)) for c in columns]
            for rows, first in stacks[0].items():
                n, h, w = first.shape
                for y in range(0, h, by):
                    for x in range(0, w, bx):
                        parts = [s[rows][:, y:y + by, x:x + bx] for s in stacks]
                        yield _rows(times[list(rows)], y, x, parts, columns)

    return frames.select("t", "h", "w", *columns).mapInArrow(cut, f"{PLACE}, " + ", ".join(f"{c} array<double>" for c in columns))


def _rows(t: np.ndarray, y0: int, x0: int, parts: list[np.ndarray], names: Iterable[str], dtypes: Iterable = ()) -> pa.RecordBatch:
    n, h, w = parts[0].shape
    fixed = [pa.array(np.full(n, v, np.int32)) for v in (y0, x0, h, w)]
    kinds = list(dtypes) or [np.float64] * len(parts)
    return pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), *fixed, *[list_array(p.reshape(n, -1), k) for p, k in zip(parts, kinds)]],
                                      names=["t", "y0", "x0", "h", "w", *names])


def _alike(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int, int]]:
    """Rows of tiles of one size with that size, as many at a time as hold ``TOGETHER_PIXELS``."""
    heights, widths = batch.column("h").to_numpy(), batch.column("w").to_numpy()
    for h, w in sorted(set(zip(heights.tolist(), widths.tolist()))):
        rows = np.flatnonzero((heights == h) & (widths == w))
        most = max(1, TOGETHER_PIXELS // max(1, h * w))
        for k in range(0, len(rows), most):
            yield rows[k:k + most], h, w


def _images(column: pa.Array, rows: np.ndarray, h: int, w: int) -> np.ndarray:
    return column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), h, w)


def _lists(lengths: np.ndarray, values: pa.Array | np.ndarray) -> pa.ListArray:
    """One list of each length, one after the other from ``values``."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), values if isinstance(values, pa.Array) else pa.array(values))


def _with_width(tiles: DataFrame, scratch: Scratch) -> DataFrame:
    """Tiles with the width of their whole image: one row per image meets its tiles."""
    widths = scratch.write(tiles.groupBy("t").agg(F.max(F.col("x0") + F.col("w")).cast("long").alias("width"), F.max(F.col("y0") + F.col("h")).cast("long").alias("height")))
    # Work per byte is high from here on, so the number of tasks is not left to the size of the tiles.
    tasks = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tiles.repartition(tasks, *TILE_KEY).join(widths, "t")


def _local_labels(column: str):
    """Labels inside each tile, by the number of their first pixel in the whole image, and the tile's border pixels.

    Small tiles are labelled many at a time, one below the other with a blank row between them.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, h, w in _alike(batch):
                n = len(rows)
                mask = _images(batch.column(column), rows, h, w) > 0
                y0, x0, width = (batch.column(c).to_numpy()[rows].astype(np.int64)[:, None, None] for c in ("y0", "x0", "width"))
                local = spread_labels(np.pad(mask, ((0, 0), (0, 1), (0, 0))).reshape(n * (h + 1), w)).reshape(n, h + 1, w)[:, :h]
                at = np.maximum(local - 1 - np.arange(n)[:, None, None] * ((h + 1) * w), 0)
                label = np.where(local > 0, (y0 + at // w) * width + x0 + at % w + 1, 0)
                edge = np.zeros((h, w), bool)
                edge[[0, -1], :] = True
                edge[:, [0, -1]] = True
                tile, places = np.nonzero((edge & (label > 0)).reshape(n, -1))
                count = np.bincount(tile, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array(rows)) for c in ("t", "y0", "x0", "h", "w")]
                    + [list_array(label.reshape(n, -1), np.int64), _lists(count, places.astype(np.int64)), _lists(count, label.reshape(n, -1)[tile, places])],
                    names=["t", "y0", "x0", "h", "w", "region", "places", "labels"])

    return run


def label_tiles(tiles: DataFrame, scratch: Scratch, column: str = "mask", out: str = "region") -> DataFrame:
    """Tiles ``(t, y0, x0, h, w, out)`` with the label image of the 8-connected regions of ``column > 0``, across tiles.

    A region's label is 1 + the number of its first pixel in its whole image, in row-major order, and 0 outside,
    as ``label_regions`` gives it for whole frames. Tiles are labelled alone; border pixels that touch across a
    tile border tie labels to each other; the graph of these ties is contracted, and every tile gets the names that
    changed. Ties and names per tile are bounded by its border.
    """
    known = _with_width(tiles.select("t", "y0", "x0", "h", "w", column), scratch)
    made = scratch.write(known.mapInArrow(_local_labels(column), f"{PLACE}, region array<long>, places array<long>, labels array<long>"))
    pixels = made.select("t", "y0", "x0", "h", "w", F.explode(F.arrays_zip("places", "labels")).alias("e")).select(
        "t", "y0", "x0", (F.col("y0") + F.expr("e.places div w")).alias("y"), (F.col("x0") + F.col("e.places") % F.col("w")).alias("x"),
        F.expr("e.places div w = h - 1").alias("low"), (F.col("e.places") % F.col("w") == F.col("w") - 1).alias("right"),
        (F.col("e.places") % F.col("w") == 0).alias("left"), F.col("e.labels").alias("label"))
    # Steps to the right, down and over both lower corners reach every pair of touching pixels once.
    step = lambda dy, dx: F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"))
    steps = F.array_compact(F.array(F.when(F.col("right"), step(0, 1)), F.when(F.col("low"), step(1, 0)), F.when(F.col("low") | F.col("right"), step(1, 1)),
                                    F.when(F.col("low") | F.col("left"), step(1, -1))))
    asked = pixels.select("t", F.col("label").alias("mine"), "y", "x", F.explode(steps).alias("s")).select(
        "t", "mine", (F.col("y") + F.col("s.dy")).alias("y"), (F.col("x") + F.col("s.dx")).alias("x"))
    ties = scratch.write(asked.join(pixels.select("t", "y", "x", "label"), ["t", "y", "x"]).where("mine <> label").select("t", "mine", "label").distinct())
    # A vertex is an image and a label; numbers of both are packed into one.
    most = made.agg(F.max(F.array_max("region"))).first()[0] or 0
    packed = lambda c: F.col("t") * F.lit(most + 1) + F.col(c)
    groups = connected_groups(ties.select(packed("mine").alias("a"), packed("label").alias("b")), scratch)
    moved = groups.where("id <> grp").select(F.expr(f"id div {most + 1}").alias("t"), (F.col("id") % (most + 1)).alias("label"), (F.col("grp") % (most + 1)).alias("root"))
    owners = made.select("t", "y0", "x0", F.explode(F.array_distinct("labels")).alias("label"))
    renamed = owners.join(moved, ["t", "label"]).groupBy(*TILE_KEY).agg(F.collect_list("label").alias("old"), F.collect_list("root").alias("new"))
    joined = made.select("t", "y0", "x0", "h", "w", "region").join(renamed, list(TILE_KEY), "left")

    def rename(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A name is looked up by the tile's place in the batch and the label, among the old names in that order.
            sizes, changed = (np.asarray(pc.fill_null(pc.list_value_length(batch.column(c)), 0)) for c in ("region", "old"))
            region, old, new = (pc.list_flatten(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("region", "old", "new"))
            if len(old):
                owner = np.repeat(np.arange(len(batch)), changed)
                order = np.lexsort((old, owner))
                names, at = np.unique(np.concatenate((old, region)), return_inverse=True)
                key = np.repeat(np.arange(len(batch)), sizes) * len(names) + at[len(old):]
                known = (owner * len(names) + at[:len(old)])[order]
                place = np.minimum(np.searchsorted(known, key), len(known) - 1)
                region = np.where(known[place] == key, new[order][place], region)
            column = _lists(sizes, region)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("t", "y0", "x0", "h", "w")] + [column], names=["t", "y0", "x0", "h", "w", out])

    return joined.mapInArrow(rename, f"{PLACE}, {out} array<long>")


def tile_pixels(tiles: DataFrame, *columns: str) -> DataFrame:
    """Rows ``(t, y, x, ...)`` of tiles in whole-image coordinates."""
    local = tiles.select("t", "y0", "x0", "w", F.posexplode(F.arrays_zip(*columns)).alias("_p", "_e"))
    return local.select("t", F.expr("cast(y0 + _p div w as int)").alias("y"), F.expr("cast(x0 + _p % w as int)").alias("x"), *[F.col(f"_e.{c}").alias(c) for c in columns])


# -- growing peaks -----------------------------------------------------------------------

#: Steps of the growth are whole numbers; the owner of a pixel is the number of its peak's pixel. The images hold a
#: rim of one pixel around the tile: what its neighbours have sent.
STATE = f"{PLACE}, width long, number int, region array<long>, steps array<long>, owner array<long>"
SENT = "dy int, dx int, region array<long>, steps array<long>, owner array<long>"
IMAGES = ("region", "steps", "owner")
SIDES = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy, dx) != (0, 0)]


def relax(region: np.ndarray, steps: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps and owners of images ``(n, h, w)``: the fewest steps from a peak inside the region, then the lowest owner.

    Every pixel takes the best of its neighbours plus one step until nothing changes. Values only ever fall, so it
    does not matter how often, and with which rims, this is done on the way to the end.
    """
    n, h, w = region.shape
    around = ((0, 0), (1, 1), (1, 1))
    wide_region = np.pad(region, around)
    views = [(slice(None), slice(dy, dy + h), slice(dx, dx + w)) for dy in (0, 1, 2) for dx in (0, 1, 2) if (dy, dx) != (1, 1)]
    same = [(wide_region[v] == region) & (region > 0) for v in views]
    while True:
        wide_steps, wide_owner = np.pad(steps, around, constant_values=FAR), np.pad(owner, around, constant_values=FAR)
        best_steps, best_owner = steps, owner
        for view, linked in zip(views, same):
            near = wide_steps[view]
            usable = linked & (near < FAR)
            taken, theirs = np.where(usable, near, FAR - 1) + 1, wide_owner[view]
            better = usable & ((taken < best_steps) | ((taken == best_steps) & (theirs < best_owner)))
            best_steps, best_owner = np.where(better, taken, best_steps), np.where(better, theirs, best_owner)
        if np.array_equal(best_steps, steps) and np.array_equal(best_owner, owner):
            return steps, owner
        steps, owner = best_steps, best_owner


def _rim(side: int, size: int) -> slice:
    """Where the neighbours on a side lie in a tile padded by one pixel."""
    return {-1: slice(0, 1), 0: slice(1, -1), 1: slice(size + 1, size + 2)}[side]


def _border(side: int) -> slice:
    """The pixels of a padded tile itself along a side."""
    return {-1: slice(1, 2), 0: slice(1, -1), 1: slice(-2, -1)}[side]


def _strips(images: dict[str, np.ndarray], changed: np.ndarray) -> pa.ListArray:
    """Per tile a list of the strips of its border towards the sides ``changed`` (tiles by sides)."""
    tile, side = np.nonzero(changed)
    edges = [(_border(dy), _border(dx)) for dy, dx in SIDES]
    sizes = np.array([images["region"][:1, y, x].size for y, x in edges])
    lengths = sizes[side]
    begin = np.cumsum(lengths) - lengths
    columns = [pa.array(np.array(SIDES, np.int32)[side, k]) for k in (0, 1)]
    for c in IMAGES:
        flat = np.empty(int(lengths.sum()), np.int64)
        for k, (y, x) in enumerate(edges):
            held = np.flatnonzero(side == k)
            flat[begin[held][:, None] + np.arange(sizes[k])] = images[c][:, y, x][tile[held]].reshape(len(held), sizes[k])
        columns.append(_lists(lengths, flat))
    return _lists(changed.sum(axis=1), pa.StructArray.from_arrays(columns, names=["dy", "dx", *IMAGES]))


def _grown(tiles: pa.RecordBatch, number: int, pitch: tuple[int, int], images: dict[str, np.ndarray], before: dict[str, np.ndarray] | None) -> pa.RecordBatch:
    """State rows of padded tiles of one size after growth, with the strips that changed for each neighbour."""
    n = len(tiles)
    steps, owner = relax(*[images[c] for c in IMAGES])
    now = {"region": images["region"], "steps": steps, "owner": owner}
    y0, x0, width = (tiles.column(c).to_numpy().astype(np.int64) for c in ("y0", "x0", "width"))
    changed = np.zeros((n, len(SIDES)), bool)
    for k, (dy, dx) in enumerate(SIDES):
        edge = (slice(None), _border(dy), _border(dx))
        if before is None:
            moved = now["steps"][edge] < FAR
        else:
            moved = (before["steps"][edge] != steps[edge]) | (before["owner"][edge] != owner[edge])
        there = x0 + dx * pitch[1]
        changed[:, k] = moved.any(axis=(1, 2)) & (y0 + dy * pitch[0] >= 0) & (there >= 0) & (there < width)
    columns = [tiles.column(c) for c in ("t", "y0", "x0", "h", "w", "width")] + [pa.array(np.full(n, number, np.int32))]
    columns += [list_array(now[c].reshape(n, -1), np.int64) for c in IMAGES]
    return pa.RecordBatch.from_arrays([*columns, _strips(now, changed)], names=["t", "y0", "x0", "h", "w", "width", "number", *IMAGES, "sent"])


def split_tiles(tiles: DataFrame, scratch: Scratch, out: str = "seg") -> DataFrame:
    """Divide the regions of tiles ``(t, y0, x0, h, w, region, peak)`` among their peaks, across tiles.

    Adds ``out``: 1 + the number of the peak's pixel in the whole image, 0 where no peak grows to. A pixel goes to the
    peak with the fewest steps to it inside its region; of several, to the lowest that a neighbour one step nearer has,
    as ``split_regions`` does on whole images.

    Rounds: a tile grows its peaks as far as they reach, and sends the strips of its border that have changed to
    its eight neighbours; only tiles that get a strip work in the next round, and only their states are written again. There
    are as many rounds as tile borders on the longest path from a peak. All tiles are cut along the same lines.
    """
    known = _with_width(tiles.select("t", "y0", "x0", "h", "w", "region", "peak"), scratch).drop("height")
    found = known.agg(F.max("h").alias("h"), F.max("w").alias("w")).first()
    if found["h"] is None:
        return known.select("t", "y0", "x0", "h", "w", "region", F.col("region").alias(out))
    pitch = (found["h"], found["w"])
    row = f"{STATE}, sent array<struct<dy:int,dx:int,region:array<long>,steps:array<long>,owner:array<long>>>"

    def start(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = ((0, 0), (1, 1), (1, 1))
        for batch in batches:
            for rows, h, w in _alike(batch):
                y0, x0, width = (batch.column(c).to_numpy()[rows].astype(np.int64)[:, None, None] for c in ("y0", "x0", "width"))
                region = _images(batch.column("region"), rows, h, w).astype(np.int64)
                peak = (_images(batch.column("peak"), rows, h, w) > 0) & (region > 0)
                y, x = np.indices((h, w))
                images = {"region": np.pad(region, around), "steps": np.pad(np.where(peak, 0, FAR), around, constant_values=FAR),
                          "owner": np.pad(np.where(peak, (y0 + y) * width + x0 + x + 1, FAR), around, constant_values=FAR)}
                yield _grown(batch.take(pa.array(rows)), 0, pitch, images, None)

    def go_on(number: int):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, h, w in _alike(batch):
                    tiles = batch.take(pa.array(rows))
                    before = {c: _images(batch.column(c), rows, h + 2, w + 2) for c in IMAGES}
                    images = {c: image.copy() for c, image in before.items()}
                    strips = tiles.column("strips").flatten()
                    tile = np.repeat(np.arange(len(rows)), np.asarray(pc.list_value_length(tiles.column("strips"))))
                    sides = np.stack([strips.field(c).to_numpy() for c in ("dy", "dx")])
                    for dy, dx in SIDES:
                        held = np.flatnonzero((sides[0] == dy) & (sides[1] == dx))
                        rim = (tile[held], _rim(dy, h), _rim(dx, w))
                        for c in IMAGES:
                            images[c][rim] = strips.field(c).take(pa.array(held)).flatten().to_numpy(zero_copy_only=False).reshape(images[c][rim].shape)
                    yield _grown(tiles, number, pitch, images, before)

        return run

    def latest(rows: DataFrame) -> DataFrame:
        last = rows.groupBy(*TILE_KEY).agg(F.max("number").alias("number"))
        return rows.join(last, [*TILE_KEY, "number"], "left_semi")

    fresh = scratch.write(known.mapInArrow(start, row))
    grown, number = fresh.drop("sent"), 0
    while True:
        # What a tile sends over its side (dy, dx) is the rim of the neighbour there, on the opposite side.
        sent = fresh.select("t", "y0", "x0", F.explode("sent").alias("s"))
        strip = F.struct((-F.col("s.dy")).alias("dy"), (-F.col("s.dx")).alias("dx"), *[F.col(f"s.{c}").alias(c) for c in IMAGES])
        rims = sent.select("t", (F.col("y0") + F.col("s.dy") * pitch[0]).alias("y0"), (F.col("x0") + F.col("s.dx") * pitch[1]).alias("x0"), strip.alias("strip"))
        rims = scratch.write(rims.groupBy(*TILE_KEY).agg(F.collect_list("strip").alias("strips")))
        if rims.isEmpty():
            break
        number += 1
        fresh = scratch.write(latest(grown.join(rims, list(TILE_KEY), "left_semi")).join(rims, list(TILE_KEY)).mapInArrow(go_on(number), row))
        grown = grown.unionByName(fresh.drop("sent"))
        if number % 8 == 0:
            grown = scratch.write(latest(grown))
    states = latest(grown)
    # The rim is cut off again.
    inner = lambda c: F.flatten(F.transform(F.sequence(F.lit(1), F.col("h")), lambda y: F.slice(F.col(c), y * (F.col("w") + 2) + 2, F.col("w"))))
    owner = F.transform(inner("owner"), lambda o: F.when(o == F.lit(FAR), F.lit(0).cast("long")).otherwise(o))
    return states.select("t", "y0", "x0", "h", "w", inner("region").alias("region"), owner.alias(out))
