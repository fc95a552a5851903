"""Stacks of frames in array files as a data source of Spark: ``spark.read.format("stack")``.

A partition is a range of pages of one file, so files of any length are read by many tasks. Filters on ``t`` are
taken over by the source: only the ranges that hold such frames become partitions. The writer exports frames as
``.npy`` files, one run of consecutive frames each, and lists them in a file written last; a reader sees a whole
export or none of it. Other formats come in with a decoder (``register_stack_format``).
"""

from __future__ import annotations

import fnmatch
import json
import re
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual, WriterCommitMessage,
)

from stackweave.model import batch_stacks, frame_batch

SCHEMA = "t long, h int, w int, px array<double>"
#: The list of an export's files.
MANIFEST = "_stack.json"
#: An exported file tells its first frame and its length in its name, so planning opens none.
EXPORTED = re.compile(r"frames-(-?\d+)-(\d+)-[0-9a-f]{32}\.npy")
#: Bytes that a batch of decoded frames and an exported file hold, about.
BATCH_BYTES, FILE_BYTES = 8 << 20, 64 << 20


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI as Spark writes it (file, hdfs, s3, gs), and the path there."""
    local = re.fullmatch(r"(?:file:(?://)?)?(/.*)", path)
    return (pafs.LocalFileSystem(), local[1]) if local else pafs.FileSystem.from_uri(path)


class NpyPages:
    """Pages of ``.npy`` files of shape ``(n, h, w)``, or ``(h, w)`` as one page; only the asked range is read."""

    def _header(self, source) -> tuple[tuple[int, ...], np.dtype]:
        version = np.lib.format.read_magic(source)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        shape, by_column, dtype = read(source)
        if by_column or len(shape) not in (2, 3) or dtype.hasobject:
            raise ValueError(f"need numbers in rows and two or three axes, not {dtype} {shape}")
        return (1, *shape) if len(shape) == 2 else shape, dtype

    def pages(self, path: str) -> int:
        files, name = open_path(path)
        with files.open_input_file(name) as source:
            return self._header(source)[0][0]

    def read(self, path: str, first: int, last: int) -> Iterator[np.ndarray]:
        files, name = open_path(path)
        with files.open_input_file(name) as source:
            (_, h, w), dtype = self._header(source)
            size = h * w * dtype.itemsize
            source.seek(source.tell() + first * size)
            for _ in range(first, last):
                yield np.frombuffer(source.read(size), dtype).reshape(h, w)


@dataclass
class PageRange(InputPartition):
    """Pages ``first`` up to ``last`` of a file; page ``first`` is frame ``t``."""

    path: str
    first: int
    last: int
    t: int


@dataclass
class Wanted:
    """Frame numbers that the pushed filters leave: a closed range and, if given, a set."""

    low: int | None = None
    high: int | None = None
    among: set[int] | None = None

    def above(self, bound: int) -> None:
        self.low = bound if self.low is None else max(self.low, bound)

    def below(self, bound: int) -> None:
        self.high = bound if self.high is None else min(self.high, bound)

    def take(self, condition: Filter) -> bool:
        """Whether the condition is one on ``t`` that the source can keep by itself; it is noted then."""
        if getattr(condition, "attribute", None) != ("t",):
            return False
        kind, value = type(condition), getattr(condition, "value", None)
        if kind is In:
            given = {v for v in value if v is not None}
            self.among = given if self.among is None else self.among & given
        elif not isinstance(value, int):
            return False
        elif kind is EqualTo:
            self.above(value)
            self.below(value)
        elif kind in (GreaterThan, GreaterThanOrEqual):
            self.above(value + (kind is GreaterThan))
        elif kind in (LessThan, LessThanOrEqual):
            self.below(value - (kind is LessThan))
        else:
            return False
        return True

    def cut(self, part: PageRange) -> PageRange | None:
        """The part's range without the frames at its ends that are not wanted."""
        low = part.t if self.low is None else max(part.t, self.low)
        high = part.t + part.last - part.first - 1
        high = high if self.high is None else min(high, self.high)
        if self.among is not None:
            inside = [t for t in self.among if low <= t <= high]
            if not inside:
                return None
            low, high = min(inside), max(inside)
        return PageRange(part.path, part.first + low - part.t, part.first + high - part.t + 1, low) if low <= high else None


@dataclass
class StackReader(DataSourceReader):
    paths: list[str]
    chunk: int
    decoder: object
    wanted: Wanted = field(default_factory=Wanted)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        return [f for f in filters if not self.wanted.take(f)]

    def partitions(self) -> list[PageRange]:
        parts = []
        for path, start, count in numbered_files(self.paths, self.decoder):
            for first in range(0, count, self.chunk):
                part = self.wanted.cut(PageRange(path, first, min(first + self.chunk, count), start + first))
                if part is not None:
                    parts.append(part)
        return parts

    def read(self, partition: PageRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no range is left, or the export is empty
            return
        held, size, t = [], 0, partition.t
        among = self.wanted.among

        def batch(frames: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            times = pa.array([k for k, _ in frames], pa.int64())
            return frame_batch({"t": times}, np.stack([f for _, f in frames]).astype(np.float64))

        for k, frame in enumerate(self.decoder.read(partition.path, partition.first, partition.last)):
            if among is not None and t + k not in among:
                continue
            if held and (size >= BATCH_BYTES or held[-1][1].shape != frame.shape):
                yield batch(held)
                held, size = [], 0
            held.append((t + k, frame))
            size += 8 * frame.size
        if held:
            yield batch(held)


def listed_files(path: str) -> list[str]:
    """The files of a path: itself, those of a folder or of a pattern, by name; an export's as its list says."""
    root = path.rstrip("/")
    folder, _, pattern = root.rpartition("/")
    if re.search(r"[*?\[]", pattern):
        files, inner = open_path(folder)
        found = [i.base_name for i in files.get_file_info(pafs.FileSelector(inner)) if fnmatch.fnmatch(i.base_name, pattern)]
        return [f"{folder}/{n}" for n in sorted(found)]
    files, name = open_path(root)
    kind = files.get_file_info(name).type
    if kind == pafs.FileType.File:
        return [root]
    if kind == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if files.get_file_info(f"{name}/{MANIFEST}").type == pafs.FileType.File:
        with files.open_input_stream(f"{name}/{MANIFEST}") as source:
            return [f"{root}/{n}" for n in json.loads(source.read())]
    found = [i.base_name for i in files.get_file_info(pafs.FileSelector(name)) if i.type == pafs.FileType.File]
    return [f"{root}/{n}" for n in sorted(found) if n[0] not in "._"]


def numbered_files(paths: list[str], decoder) -> Iterator[tuple[str, int, int]]:
    """``(path, first frame, frames)`` of all files in order.

    Exported files bear both in their names. Others are opened for their page counts, many at a time, and follow
    one another in time.
    """
    files = [f for p in paths for f in listed_files(p)]
    named = {f: EXPORTED.fullmatch(f.rpartition("/")[2]) for f in files}
    asked = [f for f in files if not named[f]]
    with ThreadPoolExecutor(32) as pool:
        counts = dict(zip(asked, pool.map(decoder.pages, asked)))
    start = 0
    for path in files:
        if named[path]:
            yield path, int(named[path][1]), int(named[path][2])
        else:
            yield path, start, counts[path]
            start += counts[path]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


@dataclass
class StackWriter(DataSourceArrowWriter):
    """Frames as ``.npy`` files under new names; the list of a job's files is written when all its tasks are done."""

    folder: str
    dtype: str
    overwrite: bool

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = open_path(self.folder)
        files.create_dir(root, recursive=True)
        names, held, size = [], [], 0

        def close() -> None:
            first, stack = held[0][0], np.stack([f for _, f in held]).astype(self.dtype)
            name = f"frames-{first}-{len(stack)}-{uuid.uuid4().hex}.npy"
            with files.open_output_stream(f"{root}/{name}", compression=None) as out:
                np.lib.format.write_array_header_2_0(out, {"descr": np.lib.format.dtype_to_descr(stack.dtype), "fortran_order": False, "shape": stack.shape})
                out.write(np.ascontiguousarray(stack).data)
            names.append(name)
            held.clear()

        for batch in iterator:
            times = batch.column("t").to_pylist()
            frames: dict[int, np.ndarray] = {}
            for rows, stack in batch_stacks(batch):
                frames.update(zip(rows.tolist(), stack))
            for k, t in enumerate(times):
                if held and (size >= FILE_BYTES or t != held[-1][0] + 1 or frames[k].shape != held[-1][1].shape):
                    close()
                    size = 0
                held.append((t, frames[k]))
                size += frames[k].size * np.dtype(self.dtype).itemsize
        if held:
            close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = open_path(self.folder)
        files.create_dir(root, recursive=True)
        old = [f.rpartition("/")[2] for f in listed_files(self.folder)]
        fresh = [n for m in messages if m for n in m.names]
        kept = fresh if self.overwrite else [n for n in old if EXPORTED.fullmatch(n)] + fresh
        with files.open_output_stream(f"{root}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(sorted(kept, key=lambda n: (int(EXPORTED.fullmatch(n)[1]), n))).encode())
        for name in set(old) - set(kept) if self.overwrite else ():
            files.delete_file(f"{root}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        files, root = open_path(self.folder)
        for name in (n for m in messages if m for n in m.names):
            files.delete_file(f"{root}/{name}")


class StackSource(DataSource):
    """Options: ``path`` (or ``load([...])``), ``chunk`` pages per partition (100), ``dtype`` of exported numbers (``<f8``)."""

    decoder: object = NpyPages()

    @classmethod
    def name(cls) -> str:
        return "stack"

    def schema(self) -> str:
        return SCHEMA

    def _paths(self) -> list[str]:
        if "paths" in self.options:
            return json.loads(self.options["paths"])
        return [self.options["path"]]

    def reader(self, schema) -> StackReader:
        return StackReader(self._paths(), int(self.options.get("chunk", 100)), self.decoder)

    def writer(self, schema, overwrite: bool) -> StackWriter:
        if self.name() != "stack":
            raise ValueError("only .npy files can be written")
        return StackWriter(self.options["path"], self.options.get("dtype", "<f8"), overwrite)


def register_stack_format(spark: SparkSession, decoder: object | None = None, name: str = "stack") -> str:
    """Make ``spark.read.format(name)`` known and let Spark push filters into Python sources.

    ``decoder`` has ``pages(path)`` and ``read(path, first, last)``; without one the files are ``.npy``.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    source = StackSource
    if decoder is not None:
        if name == "stack":
            raise ValueError("a decoder of your own needs a format name of its own")
        source = type("DecodedStackSource", (StackSource,), {"decoder": decoder, "name": classmethod(lambda cls: name)})
    spark.dataSource.register(source)
    return name
