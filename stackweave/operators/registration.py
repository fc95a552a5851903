"""Motion correction: integer shifts that align every frame with a common template.

One pass over the frames per round. Each task transforms its frames, finds their offsets
against the broadcast template, and adds the shifted spectra into one partial sum of arrays, so a
round shuffles one spectrum per task and never a frame. Offsets are a function of the frame
and the template alone: no state is kept between rounds, a lost task is simply run again,
and the final shifts are columns next to the frames, so frames and shifts are never joined.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from stackweave.functions.arrays import let
from stackweave.model import batch_stacks, is_frames
from stackweave.operators.sums import PARTS, SCHEMA, pieces, sum_pieces
from stackweave.session import Scratch

# Two offsets are packed into one number with this factor.
SIDE = 1 << 32


@dataclass
class Template:
    """Spectrum the frames are matched with, and the common drift of the matches.

    ``low`` is the smallest value of the stack, which all frames are inverted against.
    ``reach`` holds the lowest and the highest shift per axis.
    """

    spectrum: np.ndarray
    drift: np.ndarray
    low: float
    reach: np.ndarray = field(default_factory=lambda: np.zeros((2, 2), dtype=int))


def wave_numbers(h: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    return np.fft.fftfreq(h)[:, None], np.fft.rfftfreq(w)[None, :]


def shift_spectra(spectra: np.ndarray, shifts: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Half spectra of frames rolled by ``(dy, dx)`` each."""
    ky, kx = wave_numbers(*shape)
    turn = shifts[:, 0, None, None] * ky + shifts[:, 1, None, None] * kx
    return spectra * np.exp(-2j * np.pi * turn)


def nearest_matches(match: np.ndarray) -> np.ndarray:
    """Per image of booleans, the marked offset closest to 0; beyond half the size it is negative.

    Ties go to the first in row-major order, images without a mark get 0.
    """
    n, h, w = match.shape
    ys, xs = np.arange(h), np.arange(w)
    dy = np.where(ys > h // 2, ys - h, ys)
    dx = np.where(xs > w // 2, xs - w, xs)
    length = (dy[:, None] ** 2 + dx[None, :] ** 2).astype(np.float64)
    best = np.where(match, length, np.inf).reshape(n, -1).argmin(axis=1)
    found = np.stack([dy[best // w], dx[best % w]], axis=1)
    found[~match.reshape(n, -1).any(axis=1)] = 0
    return found


def match_offsets(spectra: np.ndarray, template: np.ndarray, shape: tuple[int, int], as_written: bool) -> np.ndarray:
    """Offset each frame has to be rolled by to lie on the template."""
    held = spectra if as_written else np.conj(spectra)
    overlap = np.fft.irfft2(held * template, s=shape)
    return nearest_matches(overlap == overlap.max(axis=(1, 2), keepdims=True))


def spectra_of(stack: np.ndarray, low: float) -> np.ndarray:
    return np.fft.rfft2(1.0 / (stack - (low - 1.0)))


def _round_sums(
    frames: DataFrame, shape: tuple[int, int], low: float, previous: Template | None, current: Template | None,
    as_written: bool, scratch: Scratch,
) -> dict:
    """Sum of the spectra shifted by the current offsets, and counts of offsets and of moves since the last ones.

    The two counts are kept apart: there are no more offsets than pixels and no more moves than four times that,
    however many frames there are.
    """
    spark = frames.sparkSession
    sent = spark.sparkContext.broadcast((previous, current))
    h, w = shape

    def cells(kind: int, counts: dict[tuple[int, int], int]) -> pa.RecordBatch:
        keys = np.array(list(counts), dtype=np.int64).reshape(-1, 2)
        value = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1), pa.int32()), pa.array(np.array(list(counts.values()), dtype=float)))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys[:, 0] * SIDE + keys[:, 1]), value], schema=SCHEMA)

    def partial(batches):
        old, new = sent.value
        total = np.zeros((h, w // 2 + 1), dtype=complex)
        counts: tuple[dict, dict] = ({}, {})
        for batch in batches:
            for rows, stack in batch_stacks(batch):
                if stack.shape[1:] != shape:
                    raise ValueError(f"frames of {stack.shape[1:]} in a stack of {shape}")
                spectra = spectra_of(stack, low)
                blank = np.zeros((len(stack), 2), dtype=int)
                got = blank if new is None else match_offsets(spectra, new.spectrum, shape, as_written)
                had = blank if old is None else match_offsets(spectra, old.spectrum, shape, as_written)
                total += shift_spectra(spectra, got, shape).sum(axis=0)
                for seen, values in zip(counts, (got, got - had)):
                    found, times = np.unique(values, axis=0, return_counts=True)
                    for key, n in zip(map(tuple, found.tolist()), times.tolist()):
                        seen[key] = seen.get(key, 0) + n
        if counts[0]:
            yield from pieces(0, np.stack([total.real, total.imag]))
            yield cells(1, counts[0])
            yield cells(2, counts[1])

    # Written once: the sums of arrays and the counts are two aggregates over the same few rows.
    parts = scratch.write(frames.select("h", "w", "px").mapInArrow(partial, PARTS))
    sent.unpersist()
    sums = sum_pieces(parts.where("kind = 0"))
    if not sums:
        return {"count": 0}
    table = parts.where("kind > 0").groupBy("kind", "part").agg(F.sum(F.col("v")[0]).alias("n")).toArrow().to_pandas()
    table["dy"] = np.floor_divide(table.part + SIDE // 2, SIDE)
    table["dx"] = table.part - table.dy * SIDE
    offsets, moves = table[table.kind == 1], table[table.kind == 2]
    count = float(offsets.n.sum())
    real, imaginary = sums[0].reshape(2, h, w // 2 + 1)
    return {
        "count": count,
        "spectrum": real + 1j * imaginary,
        "mean": (offsets[["dy", "dx"]].to_numpy() * offsets.n.to_numpy()[:, None]).sum(axis=0) / count,
        "moves": moves[["dy", "dx"]].to_numpy(),
        "weights": moves.n.to_numpy(),
        "ends": offsets[["dy", "dx"]].agg(["min", "max"]).to_numpy(),
    }


def find_template(
    frames: DataFrame, rounds: int = 5, history: float = 0.25, stop: float = 0.0, as_written: bool = False
) -> tuple[Template | None, list[float]]:
    """The last round's template and the mean relative move of each round."""
    size = frames.agg(F.max("h").alias("h"), F.max("w").alias("w"), F.min(F.array_min("px")).alias("low")).first()
    if size["h"] is None:
        return None, []
    low = size["low"]
    shape = (size["h"], size["w"])
    scratch = Scratch(frames.sparkSession, "register")
    scale = np.array(shape, dtype=float) * np.sqrt(2.0)
    distances: list[float] = []
    old, new = None, None
    sums = _round_sums(frames, shape, low, None, None, as_written, scratch)
    mean = sums["spectrum"] / sums["count"]
    for _ in range(rounds):
        # Shifts of the round before are its offsets less their common drift.
        drift = np.zeros(2) if new is None else new.drift
        shifted = shift_spectra((sums["spectrum"] / sums["count"])[None], -drift[None], shape)[0]
        mean = history * mean + (1 - history) * shifted
        old, new = new, Template(mean, np.zeros(2), low)
        sums = _round_sums(frames, shape, low, old, new, as_written, scratch)
        new.drift = np.round(sums["mean"])
        new.reach = sums["ends"] - new.drift.astype(int)
        moved = (sums["moves"] - (new.drift - drift)) / scale
        distances.append(float((np.sqrt((moved**2).sum(axis=1)) * sums["weights"]).sum() / sums["count"]))
        if distances[-1] <= stop:
            break
    scratch.clear()
    return new, distances


def with_offsets(frames: DataFrame, template: Template, as_written: bool = False) -> DataFrame:
    """Frames with the shift ``(dy, dx)`` that aligns each with the template."""
    sent = frames.sparkSession.sparkContext.broadcast(template)
    fields = {f.name: f for f in frames.schema.fields}
    schema = StructType([fields[c] for c in ("t", "h", "w", "px")]).add("dy", IntegerType()).add("dx", IntegerType())

    def match(batches):
        made = sent.value
        for batch in batches:
            out = np.zeros((len(batch), 2), dtype=np.int32)
            for rows, stack in batch_stacks(batch):
                found = match_offsets(spectra_of(stack, made.low), made.spectrum, stack.shape[1:], as_written)
                out[rows] = found - made.drift.astype(int)
            cols = [batch.column(c) for c in ("t", "h", "w", "px")]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(out[:, 0].copy()), pa.array(out[:, 1].copy())], names=["t", "h", "w", "px", "dy", "dx"]
            )

    return frames.select("t", "h", "w", "px").mapInArrow(match, schema)


def estimate_shifts(
    frames: DataFrame, rounds: int = 5, history: float = 0.25, stop: float = 0.0, as_written: bool = False
) -> DataFrame:
    """Frames with their registration shifts ``dy`` and ``dx``."""
    template, _ = find_template(frames, rounds, history, stop, as_written)
    if template is None:
        return frames.withColumn("dy", F.lit(0)).withColumn("dx", F.lit(0))
    return with_offsets(frames, template, as_written)


def roll_frames(stack: DataFrame) -> DataFrame:
    """Roll every frame circularly by its own columns ``dy`` and ``dx``; no shuffle in frame form.

    Pixel form needs columns ``h`` and ``w`` next to the shift.
    """
    if not is_frames(stack):
        y = F.pmod(F.col("y") + F.col("dy"), F.col("h")).cast("int")
        x = F.pmod(F.col("x") + F.col("dx"), F.col("w")).cast("int")
        return stack.withColumn("y", y).withColumn("x", x)
    place = F.struct(F.col("h").alias("h"), F.col("w").alias("w"), F.col("dy").alias("dy"), F.col("dx").alias("dx"), F.col("px").alias("px"))

    def rolled(s: Column) -> Column:
        # Rows move as whole slices, then each row is cut once and its two parts swapped.
        def row(y: Column) -> Column:
            begin = F.pmod(y - s["dy"], s["h"]) * s["w"] + 1
            cut = F.pmod(-s["dx"], s["w"])
            return F.concat(F.slice(s["px"], begin + cut, s["w"] - cut), F.slice(s["px"], begin, cut))

        return F.flatten(F.transform(F.sequence(F.lit(0), s["h"] - 1), row))

    return stack.withColumn("px", let(place, rolled))


def join_shifts(stack: DataFrame, shifts: DataFrame) -> DataFrame:
    """Attach a separate shift table ``(t, dy, dx)`` to a stack."""
    return stack.join(shifts.select("t", "dy", "dx"), "t")


def remove_drift(shifts: DataFrame) -> DataFrame:
    """Subtract the mean shift, rounded half to even, from all shifts."""
    out = shifts
    for axis in ("dy", "dx"):
        drift = shifts.agg(F.bround(F.avg(axis)).cast("int")).scalar()
        out = out.withColumn(axis, F.col(axis) - drift)
    return out


def shift_distance(old: DataFrame, new: DataFrame, shape: tuple[int, int]) -> DataFrame:
    """Mean relative length of the change between two shift tables, as one row."""
    both = new.join(old.select("t", F.col("dy").alias("oy"), F.col("dx").alias("ox")), "t")
    h, w = float(shape[0]), float(shape[1])
    root = F.sqrt(F.lit(2.0))
    part_y = (F.col("dy") - F.col("oy")) / F.lit(h) / root
    part_x = (F.col("dx") - F.col("ox")) / F.lit(w) / root
    return both.agg(F.avg(F.sqrt(part_y * part_y + part_x * part_x)).alias("distance"))


def best_match(candidates: DataFrame, shape: tuple[int, int]) -> DataFrame:
    """Of candidate pixels ``(t, y, x)`` the offset nearest to the origin: ``(t, dy, dx)``.

    The choice is a partial aggregate, so frames with many candidates do not pile up.
    """
    h, w = shape
    dy = F.when(F.col("y") > h // 2, F.col("y") - h).otherwise(F.col("y"))
    dx = F.when(F.col("x") > w // 2, F.col("x") - w).otherwise(F.col("x"))
    offsets = candidates.withColumn("dy", dy).withColumn("dx", dx)
    order = F.struct((F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")).alias("d2"), F.col("y"), F.col("x"))
    best = offsets.groupBy("t").agg(F.min_by(F.struct("dy", "dx"), order).alias("b"))
    return best.select("t", "b.dy", "b.dx")


def align(shifted: DataFrame, as_written: bool = False, reach: np.ndarray | None = None) -> DataFrame:
    """Roll frames by their shifts to one side and crop to the area all of them cover.

    By default shifts are lowered by their maximum per axis, so that every frame moves and
    the crop is ``max - min``. ``as_written`` clips positive shifts to 0 and crops by the
    largest absolute shift instead. ``reach`` gives the lowest and highest shifts where they
    are known; otherwise an aggregate finds them.
    """
    known = shifted
    if reach is None:
        ends = [f(c).alias(n) for c in ("dy", "dx") for f, n in ((F.max, f"hi_{c}"), (F.min, f"lo_{c}"))]
        known = known.withColumn("_s", shifted.agg(F.struct(*ends)).scalar())
    for axis, c in enumerate(("dy", "dx")):
        if reach is None:
            high, low = F.col("_s")[f"hi_{c}"], F.col("_s")[f"lo_{c}"]
        else:
            high, low = F.lit(int(reach[1][axis])), F.lit(int(reach[0][axis]))
        if as_written:
            known = known.withColumn(f"_cut_{c}", F.greatest(F.abs(high), F.abs(low))).withColumn(c, F.least(F.col(c), F.lit(0)))
        else:
            known = known.withColumn(f"_cut_{c}", high - low).withColumn(c, F.col(c) - high)
    rolled = roll_frames(known)
    new_h, new_w = F.col("h") - F.col("_cut_dy"), F.col("w") - F.col("_cut_dx")
    state = F.struct(F.col("w").alias("w"), new_h.alias("nh"), new_w.alias("nw"), F.col("px").alias("px"))
    cropped = let(state, lambda s: F.flatten(
        F.transform(F.slice(F.sequence(F.lit(0), F.greatest(s["nh"], F.lit(1)) - 1), F.lit(1), F.greatest(s["nh"], F.lit(0))),
                    lambda y: F.slice(s["px"], y * s["w"] + 1, F.greatest(s["nw"], F.lit(0))))
    ))
    return rolled.select(
        "t", F.greatest(new_h, F.lit(0)).cast("int").alias("h"), F.greatest(new_w, F.lit(0)).cast("int").alias("w"),
        cropped.alias("px"),
    )


def register(
    frames: DataFrame, rounds: int = 5, history: float = 0.25, stop: float = 0.0, as_written: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Registered frames and their shifts ``(t, dy, dx)``.

    The frames are read once per round: give a stored stack, not a long derivation.
    """
    template, _ = find_template(frames, rounds, history, stop, as_written)
    if template is None:
        still = frames.withColumn("dy", F.lit(0)).withColumn("dx", F.lit(0))
        return frames.select("t", "h", "w", "px"), still.select("t", "dy", "dx")
    shifted = with_offsets(frames, template, as_written)
    return align(shifted, as_written, template.reach), shifted.select("t", "dy", "dx")
