"""Map functions over overlapping blocks of a stack.

Frames are cut into tiles inside their own task; one tile row is a small array, so the one
shuffle moves arrays and not pixels. A group is one block with its halo: its size is set by
the block and halo, never by the data. Rows grow by at most the product of
``1 + 2 * halo / block`` over the axes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Union

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave.model import batch_stacks, explode_frames, frame_batch, list_array

Triple = tuple[int, int, int]
BlockSize = Union[Triple, Callable[[Triple], Triple]]

TILES = "tb long, yb int, xb int, t long, y0 int, x0 int, h int, w int, px array<double>"
PIECES = "t long, y0 int, x0 int, h int, w int, px array<double>"


def stack_shape(frames: DataFrame) -> Triple:
    """Frames, height and width, from one small aggregate."""
    row = frames.agg(F.max("t") + 1, F.max("h"), F.max("w")).first()
    return tuple(int(v or 0) for v in row)


def resolve(frames: DataFrame, size: BlockSize) -> Triple:
    """A block or halo given as a triple, or as a function of the stack's shape."""
    made = tuple(size(stack_shape(frames))) if callable(size) else tuple(size)
    if len(made) != 3:
        raise ValueError(f"need one number per axis (t, y, x), got {made}")
    return made


def cut_blocks(frames: DataFrame, block: Triple, halo: Triple) -> DataFrame:
    """Tile rows with their halo, one copy per block that needs them; halos end at the data's edge."""
    (bt, by, bx), (ht, hy, hx) = block, halo

    def cut(batches):
        for batch in batches:
            times = batch.column("t").to_numpy()
            for rows, stack in batch_stacks(batch):
                n, h, w = stack.shape
                t = times[rows]
                first, last = (t - ht) // bt, (t + ht) // bt
                for step in range(int((last - first).max()) + 1):
                    use = first + step <= last
                    tb = (first + step)[use]
                    for yb in range(-(-h // by)):
                        y0, y1 = max(yb * by - hy, 0), min((yb + 1) * by + hy, h)
                        for xb in range(-(-w // bx)):
                            x0, x1 = max(xb * bx - hx, 0), min((xb + 1) * bx + hx, w)
                            m = len(tb)
                            fixed = {"yb": yb, "xb": xb}
                            keys = {"tb": pa.array(tb, pa.int64())}
                            keys.update({k: pa.array(np.full(m, v, np.int32)) for k, v in fixed.items()})
                            keys["t"] = pa.array(t[use], pa.int64())
                            keys.update({k: pa.array(np.full(m, v, np.int32)) for k, v in (("y0", y0), ("x0", x0))})
                            yield frame_batch(keys, stack[use, y0:y1, x0:x1])

    return frames.select("t", "h", "w", "px").mapInArrow(cut, TILES)


def block_array(table: pa.Table) -> tuple[np.ndarray, np.ndarray, dict]:
    """Sorted frame numbers, the ``(n, h, w)`` array and the position of one block's tiles."""
    t = table.column("t").to_numpy()
    order = np.argsort(t, kind="stable")
    place = {k: table.column(k)[0].as_py() for k in ("tb", "yb", "xb", "y0", "x0", "h", "w")}
    px = table.column("px").combine_chunks()
    if isinstance(px, pa.ChunkedArray):
        px = pa.concat_arrays(px.chunks)
    stack = px.flatten().to_numpy(zero_copy_only=False).reshape(len(t), place["h"], place["w"])
    return t[order], stack[order], place


def map_blocks(
    frames: DataFrame, fn: Callable[[np.ndarray], np.ndarray], block: BlockSize, halo: BlockSize = (0, 0, 0)
) -> DataFrame:
    """Apply ``fn: (n, h, w) -> (n, h, w)`` to every haloed block and cut the halo off again.

    The result holds pieces ``(t, y0, x0, h, w, px)`` that tile the stack without overlap;
    ``pieces_to_frames`` or ``pieces_to_pixels`` turns them back.
    """
    block, halo = resolve(frames, block), resolve(frames, halo)
    bt, by, bx = block
    empty = pa.schema([("t", pa.int64()), ("y0", pa.int32()), ("x0", pa.int32()), ("h", pa.int32()),
                       ("w", pa.int32()), ("px", pa.list_(pa.float64()))]).empty_table()

    def run(table: pa.Table) -> pa.Table:
        t, stack, at = block_array(table)
        core = t // bt == at["tb"]
        if not core.any():
            return empty
        out = np.asarray(fn(stack), dtype=np.float64)
        if out.shape != stack.shape:
            raise ValueError(f"block function changed the shape {stack.shape} to {out.shape}")
        top, left = at["yb"] * by - at["y0"], at["xb"] * bx - at["x0"]
        out = out[core, top:top + by, left:left + bx]
        n = int(core.sum())
        keys = {"t": pa.array(t[core], pa.int64()),
                "y0": pa.array(np.full(n, at["yb"] * by, np.int32)),
                "x0": pa.array(np.full(n, at["xb"] * bx, np.int32))}
        return pa.Table.from_batches([frame_batch(keys, out)])

    return cut_blocks(frames, block, halo).groupBy("tb", "yb", "xb").applyInArrow(run, PIECES)


#: What a block sees beyond the edge of the data, per axis: nothing, the mirrored samples with the edge repeated, the edge
#: sample, or a constant.
BORDERS = ("cut", "mirror", "edge", "constant")


def _bordered(stack: np.ndarray, missing: list[tuple[int, int]], border: Sequence[str], value: float) -> np.ndarray:
    """A block with what is missing of its halo at the edges of the data, axis by axis."""
    for axis, (pad, mode) in enumerate(zip(missing, border)):
        if mode == "cut" or pad == (0, 0):
            continue
        widths = [(0, 0)] * stack.ndim
        widths[axis] = pad
        if mode == "constant":
            stack = np.pad(stack, widths, constant_values=value)
        else:
            stack = np.pad(stack, widths, mode="symmetric" if mode == "mirror" else "edge")
    return stack


def map_stacks(
    stacks: Sequence[DataFrame], fn: Callable[..., np.ndarray], block: BlockSize, halo: BlockSize = (0, 0, 0),
    border: str | Sequence[str] = "cut", value: float = 0.0,
) -> DataFrame:
    """``map_blocks`` for functions of several stacks: ``fn`` gets one ``(n, h, w)`` array per stack, all of one block.

    The stacks have the same frames and shape. ``border`` says, for all axes or for each of ``(t, y, x)``, what blocks at the
    edge of the data see beyond it (``BORDERS``); with anything but ``cut`` every block has its whole halo. ``value`` is the
    constant. The tiles of all stacks are shuffled once; a group is one block of each. Frames count from 0 without gaps.
    """
    border = (border,) * 3 if isinstance(border, str) else tuple(border)
    if len(border) != 3 or any(b not in BORDERS for b in border):
        raise ValueError(f"borders are {BORDERS}, one or one per axis, not {border}")
    shapes = [stack_shape(s) for s in stacks]
    if len(set(shapes)) != 1:
        raise ValueError(f"stacks of different shapes: {shapes}")
    shape = shapes[0]
    block, halo = resolve(stacks[0], block), resolve(stacks[0], halo)
    parts = [cut_blocks(s, block, halo).withColumn("stack", F.lit(k)) for k, s in enumerate(stacks)]
    empty = pa.schema([("t", pa.int64()), ("y0", pa.int32()), ("x0", pa.int32()), ("h", pa.int32()),
                       ("w", pa.int32()), ("px", pa.list_(pa.float64()))]).empty_table()
    count = len(stacks)

    def run(table: pa.Table) -> pa.Table:
        which = table.column("stack").to_numpy()
        held = [block_array(table.filter(pa.array(which == k)).combine_chunks()) for k in range(count) if (which == k).any()]
        if len(held) != count or any(len(t) != len(held[0][0]) for t, _, _ in held):
            raise ValueError("a frame is missing in one of the stacks")
        t, first, at = held[0]
        corner, begin = (at["tb"], at["yb"], at["xb"]), (int(t[0]), at["y0"], at["x0"])
        if corner[0] * block[0] >= shape[0]:
            return empty
        # A halo ends early only at the edge of the data.
        missing = []
        for axis in range(3):
            start, size = corner[axis] * block[axis], first.shape[axis]
            wanted_end = min(start + block[axis], shape[axis]) + halo[axis]
            missing.append((halo[axis] - (start - begin[axis]), wanted_end - (begin[axis] + size)))
        arrays = [_bordered(a, missing, border, value) for _, a, _ in held]
        out = np.asarray(fn(*arrays), dtype=np.float64)
        if out.shape != arrays[0].shape:
            raise ValueError(f"block function changed the shape {arrays[0].shape} to {out.shape}")
        ahead = [halo[k] if border[k] != "cut" else corner[k] * block[k] - begin[k] for k in range(3)]
        out = out[tuple(slice(a, a + min(block[k], shape[k] - corner[k] * block[k])) for k, a in enumerate(ahead))]
        n, start = len(out), corner[0] * block[0]
        keys = {"t": pa.array(np.arange(start, start + n), pa.int64()), "y0": pa.array(np.full(n, corner[1] * block[1], np.int32)),
                "x0": pa.array(np.full(n, corner[2] * block[2], np.int32))}
        return pa.Table.from_batches([frame_batch(keys, np.ascontiguousarray(out))])

    inside = F.col("tb").between(0, max(shape[0] - 1, 0) // block[0])
    return reduce(DataFrame.unionByName, parts).where(inside).groupBy("tb", "yb", "xb").applyInArrow(run, PIECES)


#: Bytes of one block with its halo, as doubles.
BLOCK_BYTES = 64 << 20


def fitting_block(shape: Triple, halo: Triple, block_t: int = 64) -> Triple:
    """Whole frames if a block of them stays within ``BLOCK_BYTES``, else square tiles that do.

    Blocks are at least twice as long and as wide as their halo, or the copies would outweigh them.
    """
    ht, hy, hx = halo
    bt = max(block_t if ht else 1, 2 * ht)
    pixels = BLOCK_BYTES // (8 * (bt + 2 * ht))
    if shape[1] * shape[2] <= pixels:
        return bt, max(shape[1], 1), max(shape[2], 1)
    side = int(pixels**0.5)
    return bt, max(side - 2 * hy, 2 * hy, 16), max(side - 2 * hx, 2 * hx, 16)


def map_to_frames(
    frames: DataFrame, fn: Callable[[np.ndarray], np.ndarray], block: BlockSize | None = None, halo: BlockSize = (0, 0, 0)
) -> DataFrame:
    """``map_blocks`` back in frame form; blocks of whole frames need no second shuffle."""
    shape = stack_shape(frames)
    halo = tuple(halo(shape)) if callable(halo) else tuple(halo)
    block = fitting_block(shape, halo) if block is None else tuple(block(shape)) if callable(block) else tuple(block)
    pieces = map_blocks(frames, fn, block, halo)
    if block[1] >= shape[1] and block[2] >= shape[2]:
        return pieces.select("t", "h", "w", "px")
    return pieces_to_frames(pieces)


def blockwise(block: BlockSize, halo: BlockSize = (0, 0, 0)):
    """Turn a block function into a stack operator with the given block and halo."""
    def wrap(fn: Callable[[np.ndarray], np.ndarray]) -> Callable[[DataFrame], DataFrame]:
        return lambda frames: map_blocks(frames, fn, block, halo)
    return wrap


def pieces_to_pixels(pieces: DataFrame) -> DataFrame:
    """Pixel form of block results; global coordinates make reassembly a plain projection."""
    local = explode_frames(pieces, "y0", "x0")
    return local.select("t", (F.col("y") + F.col("y0")).alias("y"), (F.col("x") + F.col("x0")).alias("x"), "v")


def pieces_to_frames(pieces: DataFrame) -> DataFrame:
    """Frame form of block results; one group is the tiles of one frame."""
    def paste(table: pa.Table) -> pa.Table:
        y0, x0 = table.column("y0").to_numpy(), table.column("x0").to_numpy()
        h, w = table.column("h").to_numpy(), table.column("w").to_numpy()
        out = np.full(((y0 + h).max(), (x0 + w).max()), np.nan)
        for i, px in enumerate(table.column("px")):
            part = px.values.to_numpy(zero_copy_only=False).reshape(h[i], w[i])
            out[y0[i]:y0[i] + h[i], x0[i]:x0[i] + w[i]] = part
        return pa.Table.from_arrays(
            [table.column("t").slice(0, 1).combine_chunks(), pa.array([out.shape[0]], pa.int32()),
             pa.array([out.shape[1]], pa.int32()), list_array(out.reshape(1, -1))],
            names=["t", "h", "w", "px"],
        )

    return pieces.groupBy("t").applyInArrow(paste, "t long, h int, w int, px array<double>")


def assemble_blocks(blocks: DataFrame, block: Triple) -> DataFrame:
    """Join a grid of blocks ``(bt, by, bx, t, y, x, v)`` with local coordinates into one stack.

    With one block size for the whole grid the offset follows from the block number.
    """
    moved = [(F.col(b) * size + F.col(c)).alias(c) for b, c, size in zip(("bt", "by", "bx"), ("t", "y", "x"), block)]
    return blocks.select(*[m.cast(k).alias(c) for m, k, c in zip(moved, ("long", "int", "int"), ("t", "y", "x"))], "v")
