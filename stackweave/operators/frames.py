"""Map numpy functions over whole frames, partition by partition."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

from stackweave.model import batch_stacks, frame_batch, list_array


def map_frames(frames: DataFrame, fn: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Replace the frames by ``fn: (n, h, w) -> (n, h2, w2)`` of every Arrow batch; never shuffles."""
    keep = [c for c in frames.columns if c not in ("h", "w", "px")]
    schema = _only(frames, keep).add("h", IntegerType()).add("w", IntegerType()).add("px", ArrayType(DoubleType()))

    def run(batches):
        for batch in batches:
            for rows, stack in batch_stacks(batch):
                part = batch if len(rows) == len(batch) else batch.take(pa.array(rows))
                yield frame_batch({c: part.column(c) for c in keep}, np.asarray(fn(stack), dtype=np.float64))

    return frames.mapInArrow(run, schema)


def add_images(
    frames: DataFrame, fn: Callable[..., Sequence[np.ndarray]], inputs: Sequence[str], outputs: Sequence[str]
) -> DataFrame:
    """Add images of the frame's own shape: ``fn`` of the input stacks returns one stack per output.

    Several images of one frame travel in one row, and one Python pass makes all of them.
    """
    keep = [c for c in frames.columns if c not in outputs]
    schema = _only(frames, keep)
    for name in outputs:
        schema = schema.add(name, ArrayType(DoubleType()))

    def run(batches):
        for batch in batches:
            groups = [list(batch_stacks(batch, c)) for c in inputs]
            for same_shape in zip(*groups):
                rows, first = same_shape[0]
                part = batch if len(rows) == len(batch) else batch.take(pa.array(rows))
                made = fn(*[stack for _, stack in same_shape])
                cols = [part.column(c) for c in keep] + [list_array(np.asarray(m).reshape(len(first), -1)) for m in made]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, *outputs])

    return frames.mapInArrow(run, schema)


def _only(df: DataFrame, names: Sequence[str]) -> StructType:
    fields = {f.name: f for f in df.schema.fields}
    return StructType([fields[c] for c in names])
