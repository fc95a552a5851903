"""Motion correction for frames of any size and rank: spectra by slabs and pencils, template and overlap in pieces.

The slab form is ``(t, first, shape, px)``: the entries ``first`` onwards of a frame's first axis, with all of the others.
A transform goes over the other axes inside each slab, then the slabs' spectra are dealt by runs of columns, and every
run is transformed along the first axis. The way back is the same in reverse. No task and no driver holds a frame: the
template is a table of runs, the overlap is searched slab by slab, and offsets come from a two-level maximum.
Frames may have any number of axes; shifts are arrays with one number per axis.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackweave.functions.arrays import let
from stackweave.model import batch_stacks, list_array
from stackweave.operators.sums import FAN_IN
from stackweave.session import Scratch

SLABS = "t long, first int, shape array<int>, px array<double>"
RUNS = "t long, band int, re array<double>, im array<double>"
PARTS = "t long, band int, first int, re array<double>, im array<double>"
#: Complex numbers of one run of columns, and pixels of one slab, about.
RUN_VALUES, SLAB_PIXELS = 2_000_000, 4_000_000
#: Numbers of the small frames that are worked on together, about.
TOGETHER_VALUES = 1 << 17


def cut_slabs(frames: DataFrame, rows: int | None = None) -> DataFrame:
    """Slabs of ``rows`` rows of frames ``(t, h, w, px)``; a narrow map."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times = batch.column("t").to_numpy()
            for held, stack in batch_stacks(batch):
                n, h, w = stack.shape
                size = rows or max(1, SLAB_PIXELS // w)
                for first in range(0, h, size):
                    part = stack[:, first:first + size]
                    shape = list_array(np.tile([h, w], (n, 1)), np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(times[held]), pa.array(np.full(n, first, np.int32)), shape, list_array(part.reshape(n, -1))],
                                                     names=["t", "first", "shape", "px"])

    return frames.select("t", "h", "w", "px").mapInArrow(cut, SLABS)


def volume_slabs(pixels: DataFrame, shape: Sequence[int], planes: int, space: Sequence[str] = ("z", "y", "x"), fill: float = 0.0) -> DataFrame:
    """Slabs of ``planes`` entries of the first axis from pixel rows ``(t, *space, v)``; absent pixels become ``fill``.

    Pixels are put in order, absent ones among them; looking each up in the map would take the square of a slab's size.
    """
    rest = math.prod(shape[1:])
    place = F.lit(0)
    for axis, size in zip(space[1:], shape[1:]):
        place = place * size + F.col(axis)
    first = F.expr(f"cast({space[0]} div {planes} * {planes} as int)")
    rows = pixels.select("t", first.alias("first"), ((F.col(space[0]) % planes) * rest + place).cast("int").alias("p"), F.col("v").cast("double").alias("v"))
    grouped = rows.groupBy("t", "first").agg(F.map_from_entries(F.collect_list(F.struct("p", "v"))).alias("m"))
    size = F.least(F.lit(planes), F.lit(shape[0]) - F.col("first")) * rest

    def ordered(last: Column) -> Column:
        absent = F.array_except(F.sequence(F.lit(0), last), F.map_keys("m"))
        cells = F.concat(F.map_entries("m"), F.transform(absent, lambda p: F.struct(p.alias("key"), F.lit(None).cast("double").alias("value"))))
        # A slab wholly outside of the shape counts downwards from 0.
        inside = F.filter(cells, lambda e: e["key"].between(F.least(F.lit(0), last), F.greatest(F.lit(0), last)))
        placed = F.sort_array(F.transform(inside, lambda e: F.struct(F.abs(e["key"]).alias("p"), e["value"].alias("v"))))
        return F.transform(placed, lambda e: F.coalesce(e["v"], F.lit(float(fill))))

    return grouped.select("t", "first", F.array(*[F.lit(int(s)) for s in shape]).alias("shape"), let(size - 1, ordered).alias("px"))


class Grid:
    """Sizes of a transform: the frame's shape, its half spectrum in columns, and the runs those are dealt in."""

    def __init__(self, shape: Sequence[int], columns: int | None = None):
        self.shape = tuple(int(s) for s in shape)
        self.rest = self.shape[1:]
        self.half = (*self.rest[:-1], self.rest[-1] // 2 + 1)
        self.width = math.prod(self.half)
        self.columns = columns or max(1, RUN_VALUES // self.shape[0])
        self.bands = -(-self.width // self.columns)

    def band(self, k: int) -> slice:
        return slice(k * self.columns, min((k + 1) * self.columns, self.width))

    def turns(self, k: int, shift: np.ndarray) -> np.ndarray:
        """Phase, in turns, that rolling by ``shift`` gives to each number of a run."""
        at = np.unravel_index(np.arange(self.width)[self.band(k)], self.half)
        along = np.zeros(len(at[0]))
        for axis, (place, size) in enumerate(zip(at, self.rest)):
            waves = np.fft.rfftfreq(size) if axis == len(self.rest) - 1 else np.fft.fftfreq(size)
            along += shift[axis + 1] * waves[place]
        return shift[0] * np.fft.fftfreq(self.shape[0])[:, None] + along[None, :]

    def inside(self, slab: np.ndarray) -> np.ndarray:
        return np.fft.rfftn(slab.reshape(-1, *self.rest), axes=tuple(range(1, len(self.shape)))).reshape(-1, self.width)

    def outside(self, spectrum: np.ndarray) -> np.ndarray:
        """Back over the other axes; the scale of the first axis is the caller's."""
        return np.fft.irfftn(spectrum.reshape(-1, *self.half), s=self.rest, axes=tuple(range(1, len(self.shape))))


def _complex(re, im, width: int) -> np.ndarray:
    both = [np.asarray(c.values.to_numpy(zero_copy_only=False)) for c in (re, im)]
    return (both[0] + 1j * both[1]).reshape(-1, width)


def _stacked(column: pa.ChunkedArray | pa.Array, rows: np.ndarray | None = None) -> np.ndarray:
    """Lists of one length as the rows of a matrix, in the order ``rows`` if given."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column if rows is None else column.take(pa.array(rows))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _parts(keys: dict, spectra: np.ndarray) -> pa.RecordBatch:
    """One row per spectrum of ``spectra``, with its keys."""
    flat = spectra.reshape(len(spectra), -1)
    return pa.RecordBatch.from_arrays([*keys.values(), list_array(flat.real), list_array(flat.imag)], names=[*keys, "re", "im"])


def _keys(n: int = 1, **values: int | np.ndarray) -> dict:
    return {name: pa.array(np.broadcast_to(value, n).astype(np.int64 if name == "t" else np.int32)) for name, value in values.items()}


def _runs_of(values: int, *columns: np.ndarray) -> Iterator[np.ndarray]:
    """Rows with the same values in all columns, as many at a time as hold ``TOGETHER_VALUES`` numbers of ``values`` a row."""
    most = max(1, TOGETHER_VALUES // max(1, int(values)))
    _, group = np.unique(np.stack(columns), axis=1, return_inverse=True)
    order = np.argsort(group.ravel(), kind="stable")
    for run in np.split(order, np.flatnonzero(np.diff(group.ravel()[order])) + 1):
        for k in range(0, len(run), most):
            yield run[k:k + most]


def _together(frames: DataFrame, count: int | None, rows: int, values: int) -> Column:
    """Frames that meet in one group: about as many as hold ``TOGETHER_VALUES`` numbers of what is grouped, whatever their ``t``.

    Large frames stay alone. Small ones are dealt by hash over as many groups as their ``count`` asks for, counted here if not given.
    """
    most = TOGETHER_VALUES // max(1, rows * values)
    if most <= 1:
        return F.col("t")
    count = frames.select("t").distinct().count() if count is None else count
    return F.pmod(F.xxhash64("t"), F.lit(max(1, -(-count // most))))


def spectra(slabs: DataFrame, low: float, grid: Grid, count: int | None = None) -> DataFrame:
    """``(t, band, re, im)``: half spectra of the inverted frames, a row per run of columns, all of the first axis each.

    Small frames are transformed many at a time; give their ``count`` if it is known.
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, first = (batch.column(c).to_numpy() for c in ("t", "first"))
            sizes = pc.list_value_length(batch.column("px")).to_numpy()
            for held in _runs_of(sizes.max(initial=1), first, sizes):
                px = _stacked(batch.column("px"), held)
                made = grid.inside(1.0 / (px - (low - 1.0))).reshape(len(held), -1, grid.width)
                for k in range(grid.bands):
                    yield _parts(_keys(len(held), t=t[held], band=k, first=first[held]), made[:, :, grid.band(k)])

    def columns(table: pa.Table) -> pa.Table:
        k = table.column("band")[0].as_py()
        width = grid.band(k).stop - grid.band(k).start
        t, first = (table.column(c).to_numpy() for c in ("t", "first"))
        order = np.lexsort((first, t))
        both = [table.column(c).combine_chunks().take(pa.array(order)).flatten().to_numpy(zero_copy_only=False) for c in ("re", "im")]
        whole = (both[0] + 1j * both[1]).reshape(-1, grid.shape[0], width)
        times = np.unique(t)
        return pa.Table.from_batches([_parts(_keys(len(times), t=times, band=k), np.fft.fft(whole, axis=1))])

    parts = slabs.mapInArrow(rows, PARTS)
    some = _together(slabs, count, grid.shape[0], grid.columns)
    return parts.groupBy(some.alias("_some"), "band").applyInArrow(lambda key, table: columns(table.select(["t", "band", "first", "re", "im"])), RUNS)


def mean_spectrum(found: DataFrame, shifts: DataFrame | None, count: int, grid: Grid) -> DataFrame:
    """``(band, re, im)``: the mean over frames of their spectra, rolled by ``shifts(t, shift)`` if given.

    Tasks add up what they have of each run; sums of tasks meet ``FAN_IN`` at a time, and those once more.
    """
    rows, rolled = (found, False) if shifts is None else (found.join(shifts, "t"), True)

    def some(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            band = batch.column("band").to_numpy()
            moves = _stacked(batch.column("shift")) if rolled else np.zeros((len(batch), 1))
            # Rows of one run and one shift are added up before they are turned.
            for held in _runs_of(grid.shape[0] * grid.columns, band, *moves.T):
                k = int(band[held[0]])
                both = [_stacked(batch.column(c), held).sum(axis=0) for c in ("re", "im")]
                run = (both[0] + 1j * both[1]).reshape(grid.shape[0], -1)
                if rolled:
                    run = run * np.exp(-2j * np.pi * grid.turns(k, moves[held[0]]))
                sums[k] = sums[k] + run if k in sums else run
        for k, total in sums.items():
            yield _parts(_keys(band=k), total[None] / count)

    def add(table: pa.Table) -> pa.Table:
        total = [list_array(sum(np.asarray(v.values.to_numpy(zero_copy_only=False)) for v in table.column(c))[None]) for c in ("re", "im")]
        return pa.Table.from_arrays([table.column("band").slice(0, 1), *total], names=["band", "re", "im"])

    kind = "band int, re array<double>, im array<double>"
    dealt = rows.mapInArrow(some, kind).withColumn("lane", F.expr(f"spark_partition_id() div {FAN_IN}"))
    once = dealt.groupBy("band", "lane").applyInArrow(lambda t: add(t.drop_columns("lane")), kind)
    return once.groupBy("band").applyInArrow(add, kind)


def offsets(found: DataFrame, template: DataFrame, grid: Grid, rows: int, as_written: bool = False, count: int | None = None) -> DataFrame:
    """``(t, shift)``: what each frame has to be rolled by to lie on the template. Give the ``count`` of frames if it is known.

    The overlap is made slab by slab; a slab tells its maximum and the place of it nearest to the origin, and a
    frame takes the largest maximum, of equals the nearest, of those the first in row-major order.
    """
    told = template.select(F.col("band").alias("_band"), F.col("re").alias("tre"), F.col("im").alias("tim"))
    half = tuple(s // 2 for s in grid.shape)

    def columns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, band = (batch.column(c).to_numpy() for c in ("t", "band"))
            for held in _runs_of(grid.shape[0] * grid.columns, band):
                k = int(band[held[0]])
                shape = (len(held), grid.shape[0], grid.band(k).stop - grid.band(k).start)
                own = (_stacked(batch.column("re"), held) + 1j * _stacked(batch.column("im"), held)).reshape(shape)
                other = _complex(batch.column("tre")[int(held[0])], batch.column("tim")[int(held[0])], shape[2])
                back = np.fft.ifft((own if as_written else np.conj(own)) * other, axis=1)
                for first in range(0, grid.shape[0], rows):
                    yield _parts(_keys(len(held), t=t[held], band=k, first=first), back[:, first:first + rows])

    def best(table: pa.Table) -> pa.Table:
        first = table.column("first")[0].as_py()
        t, band = (table.column(c).to_numpy() for c in ("t", "band"))
        times, runs = np.unique(t), []
        size = min(rows, grid.shape[0] - first)
        for k in range(grid.bands):
            held = np.flatnonzero(band == k)
            held = held[np.argsort(t[held])]
            width = grid.band(k).stop - grid.band(k).start
            runs.append((_stacked(table.column("re"), held) + 1j * _stacked(table.column("im"), held)).reshape(len(times), size, width))
        overlaps = grid.outside(np.concatenate(runs, axis=2)).reshape(len(times), size, *grid.rest)
        found: dict[str, list] = {"t": times.tolist(), "top": [], "near": [], "early": [], "shift": []}
        for overlap in overlaps:
            top = overlap.max()
            place = np.argwhere(overlap == top)
            place[:, 0] += first
            away = np.where(place > half, place - np.array(grid.shape), place)
            length = (away**2).sum(axis=1)
            near = int(np.lexsort((*place.T[::-1], length))[0])
            number = int(np.ravel_multi_index(place[near], grid.shape))
            for name, value in (("top", float(top)), ("near", -int(length[near])), ("early", -number), ("shift", away[near].tolist())):
                found[name].append(value)
        kinds = {"t": pa.int64(), "top": pa.float64(), "near": pa.int64(), "early": pa.int64(), "shift": pa.list_(pa.int32())}
        return pa.table({name: pa.array(found[name], kind) for name, kind in kinds.items()})

    joined = found.join(told, found["band"] == told["_band"]).drop("_band")
    parts = joined.mapInArrow(columns, PARTS)
    grouped = parts.groupBy(_together(found, count, rows, grid.width).alias("_some"), "first")
    slabs = grouped.applyInArrow(lambda key, table: best(table.select(["t", "band", "first", "re", "im"])), "t long, top double, near long, early long, shift array<int>")
    return slabs.groupBy("t").agg(F.max(F.struct("top", "near", "early", "shift")).alias("b")).select("t", F.col("b.shift").alias("shift"))


def estimate_shifts(
    slabs: DataFrame, scratch: Scratch, rounds: int = 5, history: float = 0.25, stop: float = 0.0, as_written: bool = False, columns: int | None = None,
) -> tuple[DataFrame, list[float]]:
    """Shifts ``(t, shift array<int>)`` of slabs ``(t, first, shape, px)`` and the mean relative move of each round.

    The same rounds as ``registration.find_template``: match all frames with the template, take off the rounded mean offset,
    and move the template by ``1 - history`` towards the mean of the shifted frames, until nothing moves. The spectra are
    made and written once; a round reads them twice. Give stored slabs. ``columns`` sets the width of a run.
    """
    slabs_ = slabs.select("t", "first", "shape", "px")
    about = slabs_.agg(F.min(F.array_min("px")).alias("low"), F.max("shape").alias("shape"), F.min("shape").alias("least"), F.count_distinct("t").alias("n"),
                       F.max(F.expr("size(px) div aggregate(slice(shape, 2, size(shape)), 1, (a, s) -> a * s)")).alias("rows")).first()
    if not about["n"]:
        return slabs_.select("t", F.slice("shape", 1, 0).alias("shift")), []
    if about["shape"] != about["least"]:
        raise ValueError(f"frames of {about['least']} and of {about['shape']} in one stack")
    grid = Grid(about["shape"], columns)
    found = scratch.write(spectra(slabs_, about["low"], grid, about["n"]))
    template, shifts, distances = scratch.write(mean_spectrum(found, None, about["n"], grid)), None, []
    for _ in range(rounds):
        if shifts is not None:
            fresh = mean_spectrum(found, shifts, about["n"], grid).select("band", F.col("re").alias("fre"), F.col("im").alias("fim"))
            mix = lambda a, b: F.zip_with(a, b, lambda old, new: old * F.lit(history) + new * F.lit(1 - history))
            template = scratch.write(template.join(fresh, "band").select("band", mix("re", "fre").alias("re"), mix("im", "fim").alias("im")))
        matched = scratch.write(offsets(found, template, grid, about["rows"], as_written, about["n"]))
        axes = range(len(grid.shape))
        drift = matched.agg(*[F.bround(F.avg(F.col("shift")[a])).cast("int").alias(f"d{a}") for a in axes]).first()
        now = scratch.write(matched.select("t", F.array(*[F.col("shift")[a] - F.lit(drift[a]) for a in axes]).alias("shift")))
        old = now.select("t", F.transform("shift", lambda s: F.lit(0)).alias("was")) if shifts is None else shifts.select("t", F.col("shift").alias("was"))
        move = [(F.col("shift")[a] - F.col("was")[a]) / F.lit(grid.shape[a] * math.sqrt(len(grid.shape))) for a in axes]
        distances.append(now.join(old, "t").agg(F.avg(F.sqrt(sum((m * m for m in move[1:]), move[0] * move[0])))).first()[0])
        shifts = now
        if distances[-1] <= stop:
            break
    return shifts, distances


def roll_slabs(slabs: DataFrame, shifts: DataFrame, rows: int) -> DataFrame:
    """Slabs rolled circularly by their frame's shift, in slabs of ``rows`` entries again.

    Inside a slab the other axes are rolled; its rows then move to the slab that their new place is in.
    """

    def move(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, first, shape, shift, px in zip(*(batch.column(c).to_pylist() for c in ("t", "first", "shape", "shift")), batch.column("px")):
                part = px.values.to_numpy(zero_copy_only=False).reshape(-1, *shape[1:])
                part = np.roll(part, shift[1:], axis=tuple(range(1, len(shape))))
                place = (first + np.arange(len(part)) + shift[0]) % shape[0]
                n = len(part)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, t)), pa.array(place.astype(np.int32)), list_array(np.tile(shape, (n, 1)), np.int32),
                                                  list_array(part.reshape(n, -1))], names=["t", "row", "shape", "px"])

    moved = slabs.select("t", "first", "shape", "px").join(shifts.select("t", "shift"), "t").mapInArrow(move, "t long, row int, shape array<int>, px array<double>")
    first = F.expr(f"cast(row div {rows} * {rows} as int)")
    grouped = moved.groupBy("t", first.alias("first")).agg(F.first("shape").alias("shape"), F.array_sort(F.collect_list(F.struct("row", "px"))).alias("r"))
    return grouped.select("t", "first", "shape", F.flatten(F.transform("r", lambda r: r["px"])).alias("px"))


def slab_pixels(slabs: DataFrame, space: Sequence[str] = ("y", "x")) -> DataFrame:
    """Rows ``(t, *space, v)`` of slabs, one column of ``space`` per axis."""
    flat = slabs.select("t", "first", "shape", F.posexplode("px").alias("_p", "v"))
    rest, columns = F.col("_p").cast("long"), []
    for axis in range(len(space) - 1, 0, -1):
        size = F.col("shape")[axis]
        columns.append((rest % size).cast("int").alias(space[axis]))
        rest = F.floor(rest / size)
    columns.append((F.col("first") + rest).cast("int").alias(space[0]))
    return flat.select("t", *columns[::-1], "v")
