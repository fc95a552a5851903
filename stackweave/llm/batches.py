"""Arrow batches inside tasks: bounded slices of texts and added result columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Text bytes that a task works on at once; one longer text is worked on alone.
SLICE_BYTES = 1 << 20


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into runs of rows whose texts have ``limit`` bytes at most, one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(first, last - first)
        first = last


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def add_columns(
    df: DataFrame,
    fields: list[tuple[str, T.DataType]],
    work: Callable[[pa.RecordBatch], dict[str, object]],
    column: str = "text",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with the columns that ``work`` makes of each slice of rows.

    Columns of ``df`` that bear one of the new names give way to the new ones; names in ``drop``
    are left out. Nothing is shuffled.
    """
    fresh = {name for name, _ in fields}
    kept = [f for f in df.schema.fields if f.name not in fresh and f.name not in drop]
    schema = T.StructType(kept + [T.StructField(name, kind) for name, kind in fields])
    arrow = to_arrow_schema(schema)
    names = [f.name for f in kept]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, column):
                made = work(part)
                columns = [part.column(n).cast(arrow.field(n).type) for n in names]
                for name, _ in fields:
                    value, kind = made[name], arrow.field(name).type
                    columns.append(value.cast(kind) if isinstance(value, pa.Array) else pa.array(value, type=kind))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, schema)
