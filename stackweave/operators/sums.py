"""Sums of arrays over all tasks of a pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Numbers of one row of a partial sum.
PIECE = 65_536
PARTS = "kind int, part long, v array<double>"
SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("v", pa.list_(pa.float64()))])
#: Tasks whose partial sums meet in one group of the first level.
FAN_IN = 64


def pieces(kind: int, values: np.ndarray, first: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows of one partial sum: runs of ``PIECE`` numbers, numbered from ``first``."""
    flat = np.ascontiguousarray(values, dtype=np.float64).ravel()
    for k in range(0, max(len(flat), 1), PIECE):
        some = pa.array(flat[k : k + PIECE])
        column = pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some)
        yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([first + k // PIECE], pa.int64()), column], schema=SCHEMA)


def _add(table: pa.Table) -> pa.Table:
    values = table.column("v").combine_chunks()
    total = np.zeros(len(values[0]))
    for row in values:
        total += row.values.to_numpy(zero_copy_only=False)
    column = pa.ListArray.from_arrays(pa.array([0, len(total)], pa.int32()), pa.array(total))
    return pa.Table.from_arrays([table.column("kind").slice(0, 1), table.column("part").slice(0, 1), column], schema=SCHEMA)


def sum_pieces(parts: DataFrame) -> dict[int, np.ndarray]:
    """The flat sums of all ``pieces`` in ``parts``, by kind.

    Two levels: no group of the first holds the rows of more than about ``FAN_IN`` tasks, and the second
    gets one row per group of the first.
    """
    spread = F.expr(f"spark_partition_id() div {FAN_IN}")
    dealt = parts.withColumn("lane", spread)
    once = dealt.groupBy("kind", "part", "lane").applyInArrow(lambda t: _add(t.drop_columns("lane")), PARTS)
    table = once.groupBy("kind", "part").applyInArrow(_add, PARTS).toArrow().sort_by([("kind", "ascending"), ("part", "ascending")])
    out: dict[int, list[np.ndarray]] = {}
    for kind, v in zip(table.column("kind").to_pylist(), table.column("v").combine_chunks() if len(table) else []):
        out.setdefault(kind, []).append(v.values.to_numpy(zero_copy_only=False))
    return {kind: np.concatenate(runs) for kind, runs in out.items()}
