"""Dictionary learning and coding for frames of any size: frames and atoms are cut into tiles of pixels.

No task holds more than a tile of all atoms and a run of frames' tiles; the driver holds matrices of
``K x K`` numbers. Results equal those of the whole-frame operators.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave.functions.coding import lasso_codes
from stackweave.operators.sampling import sample_frames
from stackweave.operators.sums import FAN_IN, PARTS, pieces, sum_pieces
from stackweave.session import Scratch

#: Numbers of one tile of all atoms; frames' tiles are taken in runs of four times as many.
TILE_VALUES = 2_000_000


def tile_pixels(n_atoms: int) -> int:
    return max(1, TILE_VALUES // max(n_atoms, 1))


def run_frames(n_atoms: int) -> int:
    """Frames of one run: four for each atom, so partial sums are a quarter of what they sum up."""
    return 4 * max(n_atoms, 1)


def cut_tiles(images: DataFrame, key: str, size: int) -> DataFrame:
    """``(key, tile, v)``: runs of ``size`` pixels of each image."""
    last = F.floor((F.size("px") - 1) / F.lit(size)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(F.col("px").cast("array<double>"), c * size + 1, F.lit(size)))
    return images.where(F.size("px") > 0).select(F.col(key).cast("long").alias(key), F.posexplode(cut).alias("tile", "v"))


def _rows(column) -> np.ndarray:
    """The matrix of a column of equally long lists."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    flat = np.ascontiguousarray(matrix, dtype=np.float64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32()), pa.array(flat.ravel()))


def atom_tiles(atoms: DataFrame, n_atoms: int, size: int | None = None) -> DataFrame:
    """``(tile, d)``: one tile of all atoms, row by row in the order of their numbers; ``size`` pixels each."""
    cell = F.struct("atom", "v")
    tiles = cut_tiles(atoms, "atom", size or tile_pixels(n_atoms)).groupBy("tile").agg(F.array_sort(F.collect_list(cell)).alias("c"))
    return tiles.select("tile", F.flatten(F.transform("c", lambda c: c["v"])).alias("d"))


def frame_runs(frames: DataFrame, n_atoms: int, key: str = "t", size: int | None = None) -> DataFrame:
    """``(run, key, tile, v)``: the frames' tiles with the run each belongs to."""
    return cut_tiles(frames, key, size or tile_pixels(n_atoms)).withColumn("run", F.floor(F.col(key) / F.lit(run_frames(n_atoms))).cast("long"))


def covariances(frames: DataFrame, tiles: DataFrame, n_atoms: int, key: str = "t", size: int | None = None) -> DataFrame:
    """``(run, key, c)``: inner products of every frame with the atoms, and of the frame with itself at the end."""
    runs = frame_runs(frames, n_atoms, key, size)
    places = runs.select(F.col("run").alias("d_run"), F.col("tile").alias("d_tile")).distinct()
    held = places.join(tiles.withColumnRenamed("tile", "d_tile"), "d_tile")
    schema = f"run long, {key} long, c array<double>"

    def part(run: pa.Table, atoms: pa.Table) -> pa.Table:
        x = _rows(run.column("v"))
        d = _rows(atoms.column("d")).reshape(n_atoms, -1)
        made = np.column_stack([x @ d.T, (x * x).sum(axis=1)])
        return pa.table({"run": run.column("run"), key: run.column(key), "c": _lists(made)})

    def total(table: pa.Table) -> pa.Table:
        names, place = np.unique(table.column(key).to_numpy(), return_inverse=True)
        made = np.zeros((len(names), n_atoms + 1))
        np.add.at(made, place, _rows(table.column("c")))
        run = pa.array(np.full(len(names), table.column("run")[0].as_py()), pa.int64())
        return pa.table({"run": run, key: pa.array(names), "c": _lists(made)})

    parts = runs.groupBy("run", "tile").cogroup(held.groupBy("d_run", "d_tile")).applyInArrow(part, schema)
    return parts.groupBy("run").applyInArrow(total, schema)


def gram_matrix(tiles: DataFrame, n_rows: int) -> np.ndarray:
    """Inner products of the rows of ``(tile, d)``, summed over the tiles."""

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_rows, n_rows))
        for batch in batches:
            for row in batch.column("d"):
                d = row.values.to_numpy(zero_copy_only=False).reshape(n_rows, -1)
                total += d @ d.T
        yield from pieces(0, total)

    sums = sum_pieces(tiles.select("d").mapInArrow(part, PARTS))
    return sums[0].reshape(n_rows, n_rows) if sums else np.zeros((n_rows, n_rows))


def encode(frames: DataFrame, atoms: DataFrame, ids: list[int], coder: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Non-zero coefficients ``(atom, t, coef)`` by ``coder(gram, products, squares)``; ``ids`` are the atoms' numbers in order."""
    n = len(ids)
    tiles = atom_tiles(atoms, n)
    gram = gram_matrix(tiles, n)
    names = np.array(ids, dtype=np.int64)

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                t, cov = batch.column("t").to_numpy(), _rows(batch.column("c"))
                codes = coder(gram, cov[:, :-1], cov[:, -1])
                at, j = np.nonzero(codes)
                yield pa.RecordBatch.from_arrays([pa.array(names[j], pa.int64()), pa.array(t[at], pa.int64()), pa.array(codes[at, j])], names=["atom", "t", "coef"])

    return covariances(frames, tiles, n).mapInArrow(code, "atom long, t long, coef double")


def products(frames: DataFrame, atoms: DataFrame, ids: list[int], key: str, value: str) -> DataFrame:
    """Inner product of every frame with every atom: ``(atom, key, value)``."""
    found = covariances(frames, atom_tiles(atoms, len(ids)), len(ids), key)
    named = F.arrays_zip(F.array(*[F.lit(i).cast("long") for i in ids]).alias("atom"), F.slice("c", 1, len(ids)).alias(value))
    return found.select(key, F.inline(named)).select("atom", key, value)


def update_weights(gram: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The block-coordinate update of all atoms as a matrix ``(K, 2K)`` on atoms and statistics.

    ``gram`` has the inner products of the ``2K`` rows. Each new atom is a sum of old rows, so its norm, which
    the projection to the unit ball needs, follows from ``gram`` alone.
    """
    k = len(a)
    mix = np.hstack([np.eye(k), np.zeros((k, k))])
    for j in range(k):
        if a[j, j] <= 1e-12:
            continue
        new = mix[j] - (a[j] @ mix) / a[j, j]
        new[k + j] += 1 / a[j, j]
        mix[j] = new / max(1.0, float(np.sqrt(max(new @ gram @ new, 0.0))))
    return mix


def round_frames(frames: DataFrame, done: int, total: int | None, chunks: int = 1, batch: int | None = None) -> DataFrame:
    """The frames that round ``done`` (from 0) learns from: all of them, one chunk of the time axis, or one mini-batch.

    Mini-batches follow one another and begin again at the first frame; the last of a pass may be shorter.
    """
    t = F.col("t")
    if not total or (batch is None and chunks <= 1):
        return frames
    if batch is None:
        c = done % chunks
        return frames.where((t >= total * c // chunks) & (t < total * (c + 1) // chunks))
    first = done % -(-total // batch) * batch
    return frames.where((t >= first) & (t < first + batch))


def kept_share(rounds: int, batch: int | None = None) -> float:
    """The share of the statistics that stays when round ``rounds`` (from 1) comes in.

    Whole passes fade by ``1 - 1 / rounds``. Mini-batches fade as the public online algorithm says: by
    ``(theta + 1 - batch) / (theta + 1)`` with ``theta`` the frames seen, ``batch ** 2`` frames once a batch's
    number passes its size.
    """
    if batch is None:
        return 1.0 - 1.0 / rounds
    step = rounds - 1
    theta = float(step * batch if step < batch - 1 else batch * batch + step - batch)
    return max(0.0, (theta + 1 - batch) / (theta + 1))


@dataclass
class TileState:
    """A dictionary in tiles: ``tiles(tile, d, b)`` has the atoms' and the statistics' ``K`` rows of each tile of ``size`` pixels.

    The driver holds ``a``, ``K x K`` numbers, whatever the size of a frame. ``rounds`` counts on when a fit is resumed.
    """

    tiles: DataFrame
    a: np.ndarray
    shape: tuple[int, int]
    size: int
    rounds: int = 0


def start_state(init: DataFrame, scratch: Scratch, size: int | None = None) -> TileState | None:
    """The state before the first round, from atoms ``(atom, h, w, px)``; nothing without atoms."""
    found = init.agg(F.count(F.lit(1)).alias("k"), F.max("h").alias("h"), F.max("w").alias("w")).first()
    if not found["k"]:
        return None
    size = size or tile_pixels(found["k"])
    tiles = atom_tiles(init, found["k"], size).withColumn("b", F.transform("d", lambda v: F.lit(0.0)))
    return TileState(scratch.write(tiles), np.zeros((found["k"],) * 2), (found["h"], found["w"]), size)


def _positive_scales(both: DataFrame, a: np.ndarray) -> list[float]:
    """What each non-negative atom is divided by to come into the unit ball.

    An atom depends on those before it through a maximum, so no matrix holds the whole update: one small pass per
    atom gives its norm, and each task replays the atoms before it in its own tile.
    """
    scales: list[float] = []
    for _ in range(len(a)):
        def norm(batches: Iterable[pa.RecordBatch], known=tuple(scales)) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                for row in batch.column("d"):
                    d, b = np.split(row.values.to_numpy(zero_copy_only=False).reshape(2 * len(a), -1), 2)
                    total += float((positive_update(d, b, a, known)[len(known)] ** 2).sum())
            yield from pieces(0, np.array([total]))

        sums = sum_pieces(both.select("d").mapInArrow(norm, PARTS))
        scales.append(max(1.0, float(np.sqrt(sums[0][0]))))
    return scales


def positive_update(d: np.ndarray, b: np.ndarray, a: np.ndarray, scales: tuple[float, ...] | list[float]) -> np.ndarray:
    """Non-negative update of the first ``len(scales) + 1`` atoms of a tile; the last of them is not yet scaled."""
    out = d.copy()
    for j in range(min(len(scales) + 1, len(d))):
        if a[j, j] > 1e-12:
            out[j] = np.maximum(out[j] + (b[j] - a[j] @ out) / a[j, j], 0.0) / (scales[j] if j < len(scales) else 1.0)
    return out


def _replaced(tiles: DataFrame, dead: list[int], part: DataFrame, state: TileState, seed: int) -> DataFrame:
    """``tiles`` with the atoms ``dead`` replaced by random frames of ``part``, brought into the unit ball; fewer if it has fewer."""
    length = F.sqrt(F.aggregate(F.col("px").cast("array<double>"), F.lit(0.0), lambda s, v: s + v * v))
    number = F.array(*[F.lit(j) for j in dead])[F.col("pos").cast("int")]
    fresh = sample_frames(part, len(dead), seed).select(number.cast("long").alias("atom"), "h", "w", F.transform(
        F.col("px").cast("array<double>"), lambda v: v / F.greatest(F.lit(1.0), length)).alias("px"))
    rows = cut_tiles(fresh, "atom", state.size).groupBy("tile").agg(F.collect_list(F.struct("atom", "v")).alias("fresh"))
    n = len(state.a)
    width = F.floor(F.size("d") / F.lit(n)).cast("int")
    joined = tiles.join(rows, "tile", "left").withColumn("_n", width)
    names = F.transform("fresh", lambda r: r["atom"])

    def row(j):
        place = F.array_position(names, j.cast("long")).cast("int")
        own = F.slice("d", j * F.col("_n") + 1, F.col("_n"))
        return F.when(F.coalesce(place, F.lit(0)) > 0, F.get("fresh", F.greatest(place - 1, F.lit(0)))["v"]).otherwise(own)

    return joined.select("tile", F.flatten(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), row)).alias("d"), "b")


def learn(
    frames: DataFrame, state: TileState, alpha: float, rounds: int, scratch: Scratch, chunks: int = 1, batch: int | None = None,
    positive_code: bool = False, positive_dict: bool = False, revive: bool = False, seed: int = 0, report: list[float] | None = None,
) -> TileState:
    """``rounds`` more rounds from a state; the state after them. Options are those of ``dictionary.fit``.

    A round reads its frames twice: for their products with the atoms, which give the codes, and for the
    codes' products with the frames, which give the statistics of each tile.
    """
    n, tiles, a, done = len(state.a), state.tiles, state.a, state.rounds
    total = frames.agg(F.max("t") + 1).first()[0] if chunks > 1 or batch else None
    for _ in range(rounds):
        part = round_frames(frames, done, total, chunks, batch)
        done += 1
        atoms = tiles.select("tile", "d")
        gram = gram_matrix(atoms, n)

        def code(batches: Iterable[pa.RecordBatch], gram=gram) -> Iterator[pa.RecordBatch]:
            for batch_ in batches:
                if batch_.num_rows:
                    cov = _rows(batch_.column("c"))
                    codes = lasso_codes(gram, cov[:, :-1], alpha, positive=positive_code)
                    loss = 0.5 * (cov[:, -1] - 2 * (codes * cov[:, :-1]).sum(axis=1) + ((codes @ gram) * codes).sum(axis=1)) + alpha * np.abs(codes).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([batch_.column("run"), batch_.column("t"), _lists(codes), pa.array(loss)], names=["run", "t", "code", "loss"])

        codes = scratch.write(covariances(part, atoms, n, size=state.size).mapInArrow(code, "run long, t long, code array<double>, loss double"))

        def squares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            square, last = np.zeros((n, n)), np.zeros(2)
            for batch_ in batches:
                if batch_.num_rows:
                    c = _rows(batch_.column("code"))
                    square += c.T @ c
                    last += [batch_.column("loss").to_numpy().sum(), len(c)]
            yield from pieces(0, square)
            yield from pieces(1, last)

        sums = sum_pieces(codes.mapInArrow(squares, PARTS))
        if not sums or not sums[1][1]:
            continue
        keep = kept_share(done, batch)
        a = keep * a + sums[0].reshape(n, n)
        fresh = _statistics(part, codes, n, state.size).withColumnRenamed("b", "b_new")
        stats = tiles.join(fresh, "tile").select("tile", "d", F.zip_with("b_new", "b", lambda new, was: new + F.lit(keep) * was).alias("b"))
        both = scratch.write(stats.select("tile", F.concat("d", "b").alias("d")))
        mix = None if positive_dict else update_weights(gram_matrix(both, 2 * n), a)
        scales = _positive_scales(both, a) if positive_dict else []

        def update(batches: Iterable[pa.RecordBatch], mix=mix, a=a, scales=scales) -> Iterator[pa.RecordBatch]:
            for batch_ in batches:
                for tile, row in zip(batch_.column("tile").to_pylist(), batch_.column("d")):
                    held = row.values.to_numpy(zero_copy_only=False).reshape(2 * n, -1)
                    made = positive_update(held[:n], held[n:], a, scales) if mix is None else mix @ held
                    yield pa.RecordBatch.from_arrays([pa.array([tile], pa.int32()), _lists(made.reshape(1, -1)), _lists(held[n:].reshape(1, -1))], names=["tile", "d", "b"])

        tiles = both.mapInArrow(update, "tile int, d array<double>, b array<double>")
        dead = np.nonzero(np.diag(a) <= 1e-12)[0].tolist() if revive else []
        if dead:
            tiles = _replaced(tiles, dead, part, state, seed + done)
        tiles = scratch.write(tiles)
        if report is not None:
            report.append(float(sums[1][0] / sums[1][1]))
    return TileState(tiles, a, state.shape, state.size, done)


def _statistics(frames: DataFrame, codes: DataFrame, n: int, size: int) -> DataFrame:
    """``(tile, b)``: the codes' products with the frames, summed over the frames of each run and then over runs."""

    def part(run: pa.Table, coded: pa.Table) -> pa.Table:
        x, c = _rows(run.column("v")), _rows(coded.column("code"))
        place = {t: k for k, t in enumerate(coded.column("t").to_pylist())}
        made = c[[place[t] for t in run.column("t").to_pylist()]].T @ x
        return pa.table({"tile": run.column("tile").slice(0, 1), "run": run.column("run").slice(0, 1), "d": _lists(made.reshape(1, -1))})

    def add(table: pa.Table) -> pa.Table:
        total = _rows(table.column("d")).sum(axis=0, keepdims=True)
        return pa.table({"tile": table.column("tile").slice(0, 1), "run": table.column("run").slice(0, 1), "d": _lists(total)})

    runs = frame_runs(frames, n, size=size)
    spread = codes.select(F.col("run").alias("c_run"), F.col("t"), "code").join(runs.select(F.col("run").alias("c_run"), F.col("tile").alias("c_tile")).distinct(), "c_run")
    kind = "tile int, run long, d array<double>"
    parts = runs.groupBy("run", "tile").cogroup(spread.groupBy("c_run", "c_tile")).applyInArrow(part, kind)
    some = parts.withColumn("lane", F.pmod("run", F.lit(FAN_IN))).groupBy("tile", "lane").applyInArrow(lambda t: add(t.drop_columns("lane")), kind)
    return some.groupBy("tile").applyInArrow(add, kind).select("tile", F.col("d").alias("b"))


def fit_tiles(frames: DataFrame, init: DataFrame, alpha: float, rounds: int, scratch: Scratch, **options) -> DataFrame:
    """Learn from the atoms ``init(atom, h, w, px)``; the new atoms in the same form, numbered from 0."""
    state = start_state(init, scratch, options.pop("size", None))
    return init if state is None else atoms_of(learn(frames, state, alpha, rounds, scratch, **options))


def atoms_of(state: TileState) -> DataFrame:
    """The atoms ``(atom, h, w, px)`` of a state."""
    return untile(state.tiles.select("tile", "d"), len(state.a), state.shape)


def state_tables(state: TileState) -> dict[str, DataFrame]:
    """The state as tables: ``tiles(tile, d, b)``, ``square(i, j, v)`` and one row ``about``."""
    spark = state.tiles.sparkSession
    i, j = np.indices(state.a.shape)
    square = pa.table({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "v": state.a.ravel()})
    about = spark.createDataFrame([(len(state.a), *state.shape, state.size, state.rounds)], "k int, h int, w int, size long, rounds long")
    return {"tiles": state.tiles, "square": spark.createDataFrame(square), "about": about}


def state_from_tables(tables: dict[str, DataFrame]) -> TileState:
    about = tables["about"].first()
    a = np.zeros((about["k"],) * 2)
    rows = tables["square"].toArrow()
    a[rows.column("i").to_numpy(), rows.column("j").to_numpy()] = rows.column("v").to_numpy()
    return TileState(tables["tiles"], a, (about["h"], about["w"]), about["size"], about["rounds"])


def untile(tiles: DataFrame, n_atoms: int, shape: tuple[int, int]) -> DataFrame:
    """Atoms ``(atom, h, w, px)`` of their tiles: one atom is one row, as large as a frame."""
    size = F.floor(F.size("d") / F.lit(n_atoms)).cast("int")
    rows = tiles.withColumn("_n", size).select("tile", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(n_atoms - 1)), lambda k: F.slice("d", k * F.col("_n") + 1, F.col("_n")))).alias("atom", "v"))
    joined = rows.groupBy(F.col("atom").cast("long").alias("atom")).agg(F.array_sort(F.collect_list(F.struct("tile", "v"))).alias("c"))
    return joined.select("atom", F.lit(shape[0]).cast("int").alias("h"), F.lit(shape[1]).cast("int").alias("w"), F.flatten(F.transform("c", lambda c: c["v"])).alias("px"))
