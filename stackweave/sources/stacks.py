"""Load, concatenate and select frames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stackweave.functions.arrays import let
from stackweave.model import FRAME_COLS, PIXEL_COLS, check_form, frame_batch, frame_total, frames_from, is_frames
from stackweave.session import Scratch
from stackweave.sources.stackfile import register_stack_format

Decoder = Callable[[bytes], Iterable[np.ndarray]]


def load_stack(
    spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet", *, t: str = "t", px: str = "px",
    shape: tuple[int, int] | None = None, decoder: Decoder | RangeDecoder | None = None, chunk_frames: int | None = None,
) -> DataFrame:
    """Read a stack; several paths are joined along time in the order given.

    ``parquet`` reads either table form, or one array column per frame when ``shape`` is
    given. ``binary`` reads files of any format with ``decoder(content) -> 2-D arrays``,
    one task per file, or with a ``RangeDecoder``, one task per range of pages. ``stack`` reads array files
    through the data source: every range of ``chunk_frames`` pages (100) is a partition, and filters on ``t`` leave out ranges.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "parquet":
        parts = [spark.read.parquet(p) for p in paths]
        parts = [frames_from(p, t, px, shape) if shape else check_form(p, FRAME_COLS if is_frames(p) else PIXEL_COLS) for p in parts]
    elif fmt == "stack":
        name = register_stack_format(spark, decoder, "stack" if decoder is None else f"stack_{type(decoder).__name__.lower()}")
        return spark.read.format(name).option("chunk", chunk_frames or 100).load(paths if len(paths) > 1 else paths[0])
    elif fmt == "binary":
        if decoder is None:
            raise ValueError("binary input needs a decoder")
        parts = [decode_files(spark, p, decoder) for p in paths]
    else:
        raise ValueError(f"unknown format {fmt!r}")
    stack = parts[0] if len(parts) == 1 else concat_stacks(parts)
    return chunk(stack, chunk_frames) if chunk_frames else stack


#: Pixels that one partition of a chunked stack holds, about: 128 MB of doubles.
PARTITION_PIXELS = 16_000_000


def chunk(stack: DataFrame, frames: int) -> DataFrame:
    """Lay frames out by time: whole chunks of ``frames`` frames share a partition.

    Written like this, files hold disjoint time ranges and a time filter prunes them. There are no
    more partitions than the pixels fill, so a long stack of small frames does not fall into crumbs.
    """
    pixels = F.sum(F.size("px").cast("long")) if is_frames(stack) else F.count(F.lit(1))
    seen = stack.agg(F.max("t").alias("last"), pixels.alias("pixels")).first()
    chunks = 1 if seen["last"] is None else seen["last"] // frames + 1
    count = max(1, min(chunks, (seen["pixels"] or 0) // PARTITION_PIXELS + 1))
    key = F.expr(f"cast(floor(t / {frames}) as long)")
    return stack.repartitionByRange(int(count), key).sortWithinPartitions("t")


def tasks_for(units: int) -> int:
    """Partitions for so many rows that each stand for much work: about one each, within what a driver schedules."""
    return max(1, units if units < 20_000 else max(20_000, units // 8))


class RangeDecoder(Protocol):
    """A decoder that reads parts of a file, so that large files are spread over tasks."""

    def pages(self, path: str) -> int: ...

    def read(self, path: str, first: int, last: int) -> Iterable[np.ndarray]: ...


PAGES = "path string, page long, h int, w int, px array<double>"


def _page_batch(path: str, page: int, frame: np.ndarray) -> pa.RecordBatch:
    return frame_batch({"path": pa.array([path]), "page": pa.array([page], pa.int64())}, np.asarray(frame, dtype=np.float64)[None])


def decode_files(spark: SparkSession, path: str, decoder: Decoder | RangeDecoder, range_pages: int = 100, scratch: Scratch | None = None) -> DataFrame:
    """Frames of one file or of all files matching a path, numbered by file name and page.

    A plain decoder gets a file's whole content. One with ``pages`` and ``read`` is asked for ranges of
    ``range_pages`` pages, each a row of its own that any task may take; neither a file nor its content is ever one
    row then. Every page is decoded once: the pages are written before they are numbered.
    """
    found = spark.read.format("binaryFile").load(path)
    if hasattr(decoder, "read"):
        def count(batches):
            for batch in batches:
                names = batch.column("path").to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([int(decoder.pages(n)) for n in names], pa.int64())], names=["path", "n"])

        def read(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    for k, frame in enumerate(decoder.read(row["path"], row["first"], row["last"])):
                        yield _page_batch(row["path"], row["first"] + k, frame)

        counted = found.select("path").mapInArrow(count, "path string, n long")
        first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(range_pages).cast("long"))).alias("first")
        ranges = counted.where("n > 0").select("path", "n", first)
        ranges = (scratch or Scratch(spark, "ranges")).write(ranges.select("path", "first", F.least(F.col("first") + range_pages, F.col("n")).alias("last")))
        # The rows are few and short, the work on each is not: a given number of partitions is not folded into one.
        pages = ranges.repartition(tasks_for(ranges.count()), "path", "first").mapInArrow(read, PAGES)
    else:
        def decode(batches):
            for batch in batches:
                for name, content in zip(batch.column("path"), batch.column("content")):
                    for page, frame in enumerate(decoder(content.as_py())):
                        yield _page_batch(name.as_py(), page, frame)

        pages = found.select("path", "content").mapInArrow(decode, PAGES)
    pages = (scratch or Scratch(spark, "decode")).write(pages)
    # One short row per input file, the same list the driver makes to plan the scan.
    sizes = pages.groupBy("path").agg((F.max("page") + 1).alias("n"))
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return pages.join(F.broadcast(starts), "path").select((F.col("start") + F.col("page")).alias("t"), "h", "w", "px")


def concat_stacks(stacks: Sequence[DataFrame]) -> DataFrame:
    """Join stacks along time: each starts where the one before it ends, empty ones take no time.

    The inputs are united with their number as a column. One aggregate gives the span of each, a running
    sum over those few rows the offsets, and a join on the number moves the frames: the plan grows with
    the inputs one by one.
    """
    columns = stacks[0].columns
    both = reduce(DataFrame.unionByName, [s.withColumn("_part", F.lit(k)) for k, s in enumerate(stacks)])
    spans = both.groupBy("_part").agg(F.min("t").alias("_lo"), (F.max("t") - F.min("t") + 1).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_lo")).alias("_move"))
    # One row per input that the caller has listed.
    moved = both.join(F.broadcast(offsets), "_part").withColumn("t", (F.col("t") + F.col("_move")).cast("long"))
    return moved.select(*columns)


Axis = int | slice | Sequence[int]


def select_frames(
    stack: DataFrame, key: int | slice | Sequence[int], rows: Axis | None = None, cols: Axis | None = None,
    dtype: str | None = None,
) -> DataFrame:
    """Lazy selection on the time axis and on space, by number, slice or list on each.

    A list may be unsorted and may repeat entries; the result has the asked order as its new
    coordinate. Slices and single numbers renumber from 0. Negative positions count from the end.
    A frame, row or column that does not exist is an error when the result is computed. Pixel tables
    have no known height and width, so spatial positions there must not be negative. ``dtype`` converts
    the values after selection.
    """
    if isinstance(key, slice):
        picked = _time_slice(stack, key)
    else:
        picked = _listed(stack, [key] if isinstance(key, (int, np.integer)) else key)
    if rows is not None or cols is not None:
        crop = _crop_frames if is_frames(stack) else _crop_pixels
        picked = crop(picked, slice(None) if rows is None else rows, slice(None) if cols is None else cols)
    if dtype:
        name = "px" if is_frames(picked) else "v"
        picked = picked.withColumn(name, F.col(name).cast(f"array<{dtype}>" if name == "px" else dtype))
    return picked


def _listed(stack: DataFrame, key: Sequence[int]) -> DataFrame:
    """The frames of a list in its order; the list comes from the caller's memory."""
    wanted = [(pos, int(t)) for pos, t in enumerate(key)]
    asked = stack.sparkSession.createDataFrame(wanted, "pos long, t long")
    if any(t < 0 for _, t in wanted):
        asked = asked.withColumn("t", F.when(F.col("t") < 0, F.col("t") + frame_total(stack)).otherwise(F.col("t")))
    # Reads the column t alone; compared when the first frame comes out, or the marker row if none does.
    found = stack.select("t").join(asked, "t").agg(F.count_distinct("pos").alias("n")).scalar()
    known = asked.where(F.when(found == len(wanted), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"frames that do not exist among {list(key)[:20]}; found "), found.cast("string"))).cast("boolean")))
    return stack.join(known, "t").drop("t").withColumnRenamed("pos", "t").select(*stack.columns)


def _from_end(stack: DataFrame, pos: int):
    return frame_total(stack) + pos if pos < 0 else F.lit(pos)


def _time_slice(stack: DataFrame, key: slice) -> DataFrame:
    step = 1 if key.step is None else key.step
    if step <= 0:
        raise ValueError("time slices need a positive step")
    if key.start is None or key.start >= 0:
        first = F.lit(key.start or 0)
    else:
        first = F.greatest(F.lit(0), _from_end(stack, key.start))
    kept = stack.where(F.col("t") >= first)
    if key.stop is not None:
        kept = kept.where(F.col("t") < _from_end(stack, key.stop))
    gap = F.col("t") - first
    if step > 1:
        kept = kept.where(gap % step == 0)
        return kept.withColumn("t", F.floor(gap / step).cast("long"))
    return kept.withColumn("t", gap.cast("long"))


def _positions(key: Axis, size: Column) -> Column:
    """Array of the positions that ``key`` names on an axis of ``size`` entries."""
    if isinstance(key, slice):
        step = key.step or 1
        if step <= 0:
            raise ValueError("spatial slices need a positive step")

        def bound(value: int | None, otherwise: Column) -> Column:
            if value is None:
                return otherwise
            return F.greatest(F.lit(0), size + value) if value < 0 else F.least(F.lit(value), size)

        start, stop = bound(key.start, F.lit(0)), bound(key.stop, size)
        return F.when(start < stop, F.sequence(start, F.greatest(start, stop - 1), F.lit(step))).otherwise(F.array().cast("array<int>"))
    wanted = [int(key)] if isinstance(key, (int, np.integer)) else [int(k) for k in key]
    listed = F.array(*[F.lit(k) for k in wanted]).cast("array<int>")
    inside = F.forall(listed, lambda k: (k < size) & (k >= -size))
    wrong = F.raise_error(F.concat(F.lit(f"positions {wanted[:20]} on an axis of "), size.cast("string"))).cast("array<int>")
    return F.when(inside, F.transform(listed, lambda k: F.when(k < 0, k + size).otherwise(k))).otherwise(wrong)


def _crop_pixels(pixels: DataFrame, rows: Axis, cols: Axis) -> DataFrame:
    for axis, key in (("y", rows), ("x", cols)):
        if isinstance(key, slice):
            start, step = key.start or 0, key.step or 1
            if start < 0 or (key.stop is not None and key.stop < 0) or step <= 0:
                raise ValueError("spatial slices of pixel tables need bounds from 0 and a positive step")
            kept = (F.col(axis) >= start) & ((F.col(axis) - start) % step == 0)
            if key.stop is not None:
                kept = kept & (F.col(axis) < key.stop)
            pixels = pixels.where(kept).withColumn(axis, F.floor((F.col(axis) - start) / step).cast("int"))
            continue
        wanted = [int(key)] if isinstance(key, (int, np.integer)) else [int(k) for k in key]
        if any(k < 0 for k in wanted):
            raise ValueError("positions of pixel tables count from 0")
        listed = F.array(*[F.lit(k) for k in wanted]).cast("array<int>")
        places = F.filter(F.transform(listed, lambda k, i: F.when(k == F.col(axis), i)), lambda i: i.isNotNull())
        pixels = pixels.withColumn(axis, F.explode(places))
    return pixels


def _crop_frames(frames: DataFrame, rows: Axis, cols: Axis) -> DataFrame:
    known = frames.withColumn("_r", _positions(rows, F.col("h"))).withColumn("_c", _positions(cols, F.col("w")))
    state = F.struct(F.col("px").alias("px"), F.col("w").alias("w"), F.col("_r").alias("r"), F.col("_c").alias("c"))
    kept = let(state, lambda s: F.flatten(F.transform(s["r"], lambda y: F.transform(s["c"], lambda x: F.get(s["px"], y * s["w"] + x)))))
    return known.withColumn("px", kept).withColumn("h", F.size("_r")).withColumn("w", F.size("_c")).drop("_r", "_c")
