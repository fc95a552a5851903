"""Dictionary learning and sparse coding as rounds of one pass over the frames.

The learned state is ``K`` atoms of one frame each and their statistics. Each task codes its own frames
against the broadcast atoms and adds them into partial statistics, so a round shuffles statistics only.
Atoms that do not fit one tile are learned and used tile by tile (``tiled``), with the same results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackweave.functions.coding import improve_atoms, lasso_codes, lasso_path, omp_codes
from stackweave.model import batch_stacks, explode_frames, frame_batch, frame_total
from stackweave.operators import tiled
from stackweave.operators.blocks import PIECES, block_array, cut_blocks, pieces_to_frames
from stackweave.operators.sampling import sample_frames
from stackweave.operators.sums import PARTS, pieces, sum_pieces
from stackweave.session import Scratch


@dataclass
class Learned:
    """Atoms ``(K, F)``, their statistics and the number of rounds done."""

    atoms: np.ndarray
    shape: tuple[int, int]
    a: np.ndarray = field(default=None)
    b: np.ndarray = field(default=None)
    rounds: int = 0

    def __post_init__(self):
        k, f = self.atoms.shape
        self.a = np.zeros((k, k)) if self.a is None else self.a
        self.b = np.zeros((k, f)) if self.b is None else self.b


#: Numbers of a dictionary that the driver and every worker may hold, at most.
HELD_VALUES = 1 << 25


def collect_atoms(atoms: DataFrame, key: str = "atom") -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """Atom numbers, the matrix ``(K, F)`` and the frame shape; an error if they are too large to hold.

    Larger dictionaries are learned and used tile by tile (``fit_atoms``, ``tiled``).
    """
    size = atoms.agg(F.max("h").alias("h"), F.max("w").alias("w"), F.sum(F.size("px").cast("long")).alias("n")).first()
    if (size["n"] or 0) > HELD_VALUES:
        raise ValueError(f"atoms of {size['n']} numbers do not fit one task; learn them with fit_atoms or tiled.learn")
    table = atoms.select(F.col(key).cast("long").alias("k"), "px").orderBy("k").toArrow()
    if len(table) == 0:
        return np.zeros(0, dtype=int), np.zeros((0, 0)), (0, 0)
    flat = table.column("px").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
    return table.column("k").to_numpy(), flat.reshape(len(table), -1), (size["h"], size["w"])


def one_tile(atoms: DataFrame) -> tuple[bool, list[int]]:
    """Whether all atoms fit one tile, and so every task's memory, and the atoms' numbers in order."""
    rows = atoms.select(F.col("atom").cast("long").alias("atom"), F.size("px").alias("n")).orderBy("atom").collect()
    pixels = max((r["n"] for r in rows), default=0)
    return pixels <= tiled.tile_pixels(len(rows)), [r["atom"] for r in rows]


def fit_atoms(
    frames: DataFrame, init: DataFrame, alpha: float = 1.0, rounds: int = 10, chunks: int = 1, report: list[float] | None = None,
    scratch: Scratch | None = None, batch: int | None = None, positive_code: bool = False, positive_dict: bool = False, revive: bool = False, seed: int = 0,
) -> DataFrame:
    """Learn from the atoms ``init`` and return the new ones ``(atom, h, w, px)``, for frames of any size.

    Atoms of one tile are learned by ``fit``, larger ones in tiles by ``tiled.learn``: the same rounds, options and results.
    """
    fits, _ = one_tile(init)
    options = {"chunks": chunks, "batch": batch, "positive_code": positive_code, "positive_dict": positive_dict, "revive": revive, "seed": seed, "report": report}
    if fits:
        return atoms_frame(frames.sparkSession, fit(frames, alpha=alpha, rounds=rounds, init=init, **options))
    return tiled.fit_tiles(frames, init, alpha, rounds, scratch or Scratch(frames.sparkSession, "tiles"), **options)


def initial_atoms(frames: DataFrame, n_atoms: int, seed: int = 0) -> DataFrame:
    """``n_atoms`` random frames as the first dictionary ``(atom, h, w, px)``."""
    return sample_frames(frames, n_atoms, seed).select(F.col("pos").cast("long").alias("atom"), "h", "w", "px")


def atoms_frame(spark: SparkSession, learned: Learned) -> DataFrame:
    """The learned atoms as a table ``(atom, h, w, px)``."""
    made = frame_batch({"atom": pa.array(np.arange(len(learned.atoms)), pa.int64())}, learned.atoms.reshape(-1, *learned.shape))
    return spark.createDataFrame(pa.Table.from_batches([made]))


def _matrix_rows(table: pa.Table, shape: tuple[int, int]) -> np.ndarray:
    out = np.zeros(shape)
    out[table.column("i").to_numpy(), table.column("j").to_numpy()] = table.column("v").to_numpy()
    return out


def _matrix_table(m: np.ndarray, names: tuple[str, str]) -> pa.Table:
    i, j = np.indices(m.shape)
    return pa.table({names[0]: i.ravel().astype(np.int32), names[1]: j.ravel().astype(np.int32), "v": m.ravel()})


def state_tables(spark: SparkSession, learned: Learned) -> dict[str, DataFrame]:
    """The state as tables: ``dict``, ``dict_A(i, j, v)``, ``dict_B(p, j, v)``, ``dict_rounds``."""
    return {
        "dict": atoms_frame(spark, learned),
        "dict_A": spark.createDataFrame(_matrix_table(learned.a, ("i", "j"))),
        "dict_B": spark.createDataFrame(_matrix_table(learned.b.T, ("p", "j"))),
        "dict_rounds": spark.createDataFrame([(learned.rounds,)], "rounds long"),
    }


def state_from_tables(tables: dict[str, DataFrame]) -> Learned:
    _, atoms, shape = collect_atoms(tables["dict"])
    k, f = atoms.shape
    a = _matrix_rows(tables["dict_A"].toArrow(), (k, k))
    b = _matrix_rows(tables["dict_B"].select(F.col("p").alias("i"), "j", "v").toArrow(), (f, k)).T
    return Learned(atoms, shape, a, b, tables["dict_rounds"].first()["rounds"])


def code_statistics(frames: DataFrame, learned: Learned, alpha: float, positive: bool = False) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Sums of ``code' code`` and ``code' x`` over all frames, the objective and the frame count."""
    spark = frames.sparkSession
    k, f = learned.atoms.shape
    sent = spark.sparkContext.broadcast(learned.atoms)

    def partial(batches):
        atoms = sent.value
        gram = atoms @ atoms.T
        a, b, loss, seen = np.zeros((k, k)), np.zeros((k, f)), 0.0, 0
        for batch in batches:
            for _, stack in batch_stacks(batch):
                x = stack.reshape(len(stack), -1)
                codes = lasso_codes(gram, x @ atoms.T, alpha, positive=positive)
                a += codes.T @ codes
                b += codes.T @ x
                loss += 0.5 * float(((x - codes @ atoms) ** 2).sum()) + alpha * float(np.abs(codes).sum())
                seen += len(x)
        if seen:
            for kind, m in enumerate((a, b, np.array([loss, float(seen)]))):
                yield from pieces(kind, m)

    sums = sum_pieces(frames.select("h", "w", "px").mapInArrow(partial, PARTS))
    sent.unpersist()
    if not sums:
        return np.zeros((k, k)), np.zeros((k, f)), 0.0, 0
    loss, seen = sums[2]
    return sums[0].reshape(k, k), sums[1].reshape(k, f), float(loss), int(seen)


def fit(
    frames: DataFrame, n_atoms: int | None = None, alpha: float = 1.0, rounds: int = 10, chunks: int = 1, seed: int = 0,
    init: DataFrame | None = None, state: Learned | None = None, positive_code: bool = False, positive_dict: bool = False,
    report: list[float] | None = None, revive: bool = False, batch: int | None = None,
) -> Learned:
    """Learn a dictionary in ``rounds`` passes, round r over chunk ``r % chunks`` of the time axis.

    Frames should be shuffled and stored first when ``chunks > 1``: a chunk is a range of
    ``t``, which the scan prunes. Old statistics fade with the number of rounds, so the atoms
    follow the better codes. ``state`` continues an earlier fit. ``report`` collects the mean
    objective of each round, measured before its update. ``batch`` learns online instead: every round takes
    the next so many frames, and old statistics fade with the frames seen (``tiled.kept_share``); give shuffled
    frames, numbered from 0. ``revive`` replaces atoms that no frame uses by
    random frames of the round's chunk, at most ``K`` of them.
    """
    if state is None:
        if init is None:
            if n_atoms is None:
                raise ValueError("give n_atoms, init or state")
            init = initial_atoms(frames, n_atoms, seed)
        _, atoms, shape = collect_atoms(init)
        state = Learned(atoms, shape)
    if state.atoms.size == 0:
        return state
    learned = Learned(state.atoms.copy(), state.shape, state.a.copy(), state.b.copy(), state.rounds)
    total = frames.agg(F.max("t") + 1).first()[0] if chunks > 1 or batch else None
    for _ in range(rounds):
        part = tiled.round_frames(frames, learned.rounds, total, chunks, batch)
        a, b, loss, seen = code_statistics(part, learned, alpha, positive_code)
        learned.rounds += 1
        if not seen:
            continue
        keep = tiled.kept_share(learned.rounds, batch)
        learned.a, learned.b = keep * learned.a + a, keep * learned.b + b
        learned.atoms = improve_atoms(learned.atoms, learned.a, learned.b, positive_dict)
        dead = np.nonzero(np.diag(learned.a) <= 1e-12)[0] if revive else []
        if len(dead):
            fresh = collect_atoms(initial_atoms(part, len(dead), seed + learned.rounds))[1]
            for j, frame in zip(dead, fresh):
                learned.atoms[j] = frame / max(1.0, float(np.linalg.norm(frame)))
        if report is not None:
            report.append(loss / seen)
    return learned


def correlate(frames: DataFrame, atoms: DataFrame, key: str = "t", value: str = "value") -> DataFrame:
    """Inner product of every frame with every atom: ``(atom, key, value)``.

    One matrix product per Arrow batch; with the atoms as frames it is the Gram matrix.
    """
    fits, numbers = one_tile(atoms)
    if not fits:
        return tiled.products(frames, atoms, numbers, key, value)
    ids, matrix, _ = collect_atoms(atoms)
    sent = frames.sparkSession.sparkContext.broadcast((ids, matrix))

    def product(batches):
        names, d = sent.value
        for batch in batches:
            keys = batch.column("k").to_numpy()
            for rows, stack in batch_stacks(batch):
                got = stack.reshape(len(stack), -1) @ d.T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(names, len(stack)), pa.int64()), pa.array(np.repeat(keys[rows], len(names)), pa.int64()),
                     pa.array(got.ravel())], names=["atom", key, value])

    keyed = frames.select(F.col(key).cast("long").alias("k"), "h", "w", "px")
    return keyed.mapInArrow(product, f"atom long, {key} long, {value} double")


def gram(atoms: DataFrame) -> DataFrame:
    """Inner products of all pairs of atoms: ``(i, j, value)``."""
    pairs = correlate(atoms.select(F.col("atom").alias("j"), "h", "w", "px"), atoms, "j")
    return pairs.withColumnRenamed("atom", "i")


METHODS = ("omp", "lasso", "lars")


def coder(method: str, limit: int, alpha: float, max_iter: int, positive: bool, tol: float | None) -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """The codes of frames as a function of the Gram matrix, the frames' products with the atoms and their squares."""
    if method == "omp":
        return lambda g, cov, squares: omp_codes(g, cov, limit, squares, tol)
    if method == "lasso":
        return lambda g, cov, squares: lasso_codes(g, cov, alpha, max_iter, positive)
    return lambda g, cov, squares: np.array([lasso_path(g, c, alpha, positive)[-1][1] for c in cov]).reshape(cov.shape)


def encode_path(frames: DataFrame, atoms: DataFrame, alpha: float = 0.0, positive: bool = False) -> DataFrame:
    """Every knot of each frame's lasso path down to ``alpha``: ``(t, knot, weight, atom, coef)``, non-zero codes only.

    The products come from ``correlate``, so atoms may be of any size; a task follows the paths of its frames.
    """
    _, numbers = one_tile(atoms)
    kind = "t long, knot int, weight double, atom long, coef double"
    if not numbers:
        return frames.sparkSession.createDataFrame([], kind)
    g = np.zeros((len(numbers),) * 2)
    place = {n: k for k, n in enumerate(numbers)}
    for row in gram(atoms).collect():  # K x K numbers
        g[place[row["i"]], place[row["j"]]] = row["value"]
    rows = correlate(frames, atoms).groupBy("t").agg(F.array_sort(F.collect_list(F.struct("atom", "value"))).alias("c"))

    def follow(batches):
        for batch in batches:
            t, knot, weight, atom, coef = [], [], [], [], []
            for frame, cells in zip(batch.column("t").to_pylist(), batch.column("c")):
                cov = cells.values.field("value").to_numpy(zero_copy_only=False)
                for k, (w, codes) in enumerate(lasso_path(g, cov, alpha, positive)):
                    for j in np.nonzero(codes)[0]:
                        t.append(frame), knot.append(k), weight.append(w), atom.append(numbers[j]), coef.append(codes[j])
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(knot, pa.int32()), pa.array(weight, pa.float64()), pa.array(atom, pa.int64()),
                                              pa.array(coef, pa.float64())], names=["t", "knot", "weight", "atom", "coef"])

    return rows.mapInArrow(follow, kind)


def sparse_encode(
    frames: DataFrame, atoms: DataFrame, method: str = "omp", k: int | None = None, alpha: float = 1.0, max_iter: int = 1000,
    positive: bool = False, tol: float | None = None,
) -> DataFrame:
    """Non-zero coefficients ``(atom, t, coef)`` of every frame.

    ``omp`` uses at most ``k`` atoms per frame; without ``k`` a tenth of the pixels, but not
    more than there are atoms (all of them with ``tol``), and stops once the square of the residual is ``tol``. ``lasso``
    and ``lars`` use ``alpha``: coordinate descent, or the exact solution by following its path.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    fits, numbers = one_tile(atoms)
    if not numbers:
        return frames.sparkSession.createDataFrame([], "atom long, t long, coef double")
    if not fits:
        pixels = atoms.agg(F.max(F.size("px"))).first()[0]
        most = k if k is not None else len(numbers) if tol is not None else min(max(pixels // 10, 1), len(numbers))
        return tiled.encode(frames, atoms, numbers, coder(method, most, alpha, max_iter, positive, tol))
    ids, matrix, _ = collect_atoms(atoms)
    limit = k if k is not None else len(ids) if tol is not None else min(max(matrix.shape[1] // 10, 1), len(ids))
    code = coder(method, limit, alpha, max_iter, positive, tol)
    sent = frames.sparkSession.sparkContext.broadcast((ids, matrix))

    def encode(batches):
        names, d = sent.value
        g = d @ d.T
        for batch in batches:
            t = batch.column("t").to_numpy()
            for rows, stack in batch_stacks(batch):
                x = stack.reshape(len(stack), -1)
                codes = code(g, x @ d.T, (x * x).sum(axis=1))
                at, j = np.nonzero(codes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[j], pa.int64()), pa.array(t[rows][at], pa.int64()), pa.array(codes[at, j])],
                    names=["atom", "t", "coef"])

    return frames.select("t", "h", "w", "px").mapInArrow(encode, "atom long, t long, coef double")


#: Numbers that are multiplied at a time, about.
PRODUCT_VALUES = 1 << 20


def reconstruct(code: DataFrame, atoms: DataFrame) -> DataFrame:
    """Pixel form of ``code x atoms``.

    The codes meet by frame, as small rows, and a task adds up the broadcast atoms of a run of frames at a time; pixels appear
    only as they leave it. Atoms of more than one tile, or of several shapes, are joined pixel by pixel and summed per pixel.
    """
    spark = code.sparkSession
    known = atoms.where("atom is not null and px is not null")
    fits, _ = one_tile(known)
    table = known.select(F.col("atom").cast("long").alias("atom"), "w", "px").orderBy("atom").toArrow() if fits else None
    if table is None or len(set(zip(table.column("w").to_pylist(), pc.list_value_length(table.column("px")).to_pylist()))) > 1:
        pixels = explode_frames(atoms.select(F.col("atom").alias("t"), "h", "w", "px"), value="d").withColumnRenamed("t", "atom")
        return code.join(pixels, "atom").groupBy("t", "y", "x").agg(F.sum(F.col("coef") * F.col("d")).alias("v"))
    flat = pc.list_flatten(table.column("px")).combine_chunks()
    matrix, absent = (a.reshape(len(table), -1) if len(table) else np.zeros((0, 0)) for a in
                      (flat.to_numpy(zero_copy_only=False).astype(float), flat.is_null().to_numpy(zero_copy_only=False)))
    width = table.column("w")[0].as_py() if len(table) else 0
    sent = spark.sparkContext.broadcast((table.column("atom").to_numpy(), matrix, absent if absent.any() else None))

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, d, gaps = sent.value
        for batch in batches:
            cells = batch.column("c")
            start = cells.offsets.to_numpy()
            entries = cells.values.slice(start[0], start[-1] - start[0])
            atom, coef = entries.field("atom").to_numpy(), entries.field("coef")
            value, given = coef.to_numpy(zero_copy_only=False), coef.is_valid().to_numpy(zero_copy_only=False)
            # As in a join, an unknown atom has no match, and a number that several atoms share has them all.
            first = np.searchsorted(names, atom, "left")
            matches = np.searchsorted(names, atom, "right") - first
            frame = np.repeat(np.repeat(np.arange(len(batch)), np.diff(start)), matches)
            entry = np.repeat(np.arange(len(atom)), matches)
            row = first[entry] + np.arange(len(entry)) - np.repeat(np.cumsum(matches) - matches, matches)
            held, begin = np.unique(frame, return_index=True)
            ends = np.append(begin, len(frame))
            at = 0
            while at < len(held):
                most = max(1, PRODUCT_VALUES // max(1, d.shape[1]))
                upto = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
                some = slice(ends[at], ends[upto])
                parts = value[entry[some]][:, None] * d[row[some]]
                void = None
                if gaps is not None or not given[entry[some]].all():
                    # A missing factor adds nothing; a sum of none is missing.
                    void = ~given[entry[some]][:, None] | (gaps[row[some]] if gaps is not None else np.zeros(parts.shape, bool))
                    parts[void] = 0.0
                    void = np.logical_and.reduceat(void, begin[at:upto] - ends[at], axis=0).ravel()
                v = pa.array(np.add.reduceat(parts, begin[at:upto] - ends[at], axis=0).ravel(), mask=void)
                offsets = pa.array(np.arange(upto - at + 1, dtype=np.int32) * d.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column("t").take(pa.array(held[at:upto])), pa.array(np.full(upto - at, width, np.int32)),
                                                  pa.ListArray.from_arrays(offsets, v)], names=["t", "w", "px"])
                at = upto

    # The rows are few bytes and become many pixels, so the number of tasks is not left to their size.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entry = F.struct(F.col("atom").cast("long").alias("atom"), F.col("coef").cast("double").alias("coef"))
    grouped = code.where("atom is not null").select(F.col("t").cast("long").alias("t"), entry.alias("e")).repartition(tasks, "t").groupBy("t").agg(F.collect_list("e").alias("c"))
    return explode_frames(grouped.mapInArrow(multiply, "t long, w int, px array<double>"))


def share_of(tb, total, block_t: int, n_atoms: int):
    """Atoms of time block ``tb`` and of all blocks before it, for numbers or columns alike.

    Largest remainder: all full blocks have the same remainder, so the spare atoms go to the
    first full blocks, after the shorter last block when its remainder is larger.
    """
    full, rest = total // block_t, total % block_t
    base, left = n_atoms * block_t // total, n_atoms * rest // total
    spare = n_atoms - full * base - left
    to_last = (n_atoms * rest % total > n_atoms * block_t % total) and spare > 0
    extra = spare - to_last
    count = base + (tb < extra) if tb < full else left + to_last
    return int(count), int(tb * base + min(tb, extra))


def allocate_atoms(stack: DataFrame, block_t: int, n_atoms: int) -> DataFrame:
    """Atoms per time block in proportion to its frames: ``(tb, frames, k, k_offset)``."""
    total = frame_total(stack)
    row = stack.sparkSession.range(1).select(total.alias("n")).where("n > 0")
    row = row.selectExpr(
        "n", f"n div {block_t} AS full", f"n % {block_t} AS rest", f"{n_atoms} * {block_t} div n AS base",
        f"{n_atoms} * {block_t} % n AS base_rem", f"{n_atoms} * (n % {block_t}) div n AS last",
        f"{n_atoms} * (n % {block_t}) % n AS last_rem",
    ).selectExpr("*", f"{n_atoms} - full * base - last AS spare")
    row = row.selectExpr("*", "cast(last_rem > base_rem AND spare > 0 AS long) AS to_last").selectExpr("*", "spare - to_last AS extra")
    blocks = row.selectExpr("*", "explode(sequence(0L, full + cast(rest > 0 AS long) - 1)) AS tb")
    return blocks.selectExpr(
        "tb",
        f"if(tb < full, {block_t}, rest) AS frames",
        "if(tb < full, base + cast(tb < extra AS long), last + to_last) AS k",
        "tb * base + least(tb, extra) AS k_offset",
    )


def learn_block(
    x: np.ndarray, atoms: np.ndarray, alpha: float, rounds: int, positive_code: bool = False, positive_dict: bool = False
) -> np.ndarray:
    """Dictionary of one block that is already in memory."""
    a, b = np.zeros((len(atoms),) * 2), np.zeros_like(atoms)
    for r in range(1, rounds + 1):
        codes = lasso_codes(atoms @ atoms.T, x @ atoms.T, alpha, positive=positive_code)
        keep = 1.0 - 1.0 / r
        a, b = keep * a + codes.T @ codes, keep * b + codes.T @ x
        atoms = improve_atoms(atoms, a, b, positive_dict)
    return atoms


def fit_blocks(
    frames: DataFrame, n_atoms: int, block: tuple[int, int, int], alpha: float = 1.0, rounds: int = 10, seed: int = 0,
    positive_code: bool = False, positive_dict: bool = False, learner: Callable[..., np.ndarray] = learn_block,
) -> DataFrame:
    """Learn a dictionary per block: ``(atom, h, w, px)``.

    The atoms are shared out over the time blocks; every tile of a time block starts from the
    same frames and learns its own part of the block's atoms. A group is one block. ``learner`` takes the
    block's frames ``(n, pixels)``, its first atoms ``(k, pixels)`` and the four settings, and returns the atoms.
    """
    total = frames.agg(F.max("t") + 1).first()[0]
    bt = block[0]
    empty = pa.schema([("t", pa.int64()), ("y0", pa.int32()), ("x0", pa.int32()), ("h", pa.int32()),
                       ("w", pa.int32()), ("px", pa.list_(pa.float64()))]).empty_table()
    if not total:
        return frames.select(F.col("t").alias("atom"), "h", "w", "px")

    def learn(table: pa.Table) -> pa.Table:
        t, stack, at = block_array(table)
        k, start = share_of(at["tb"], total, bt, n_atoms)
        order = sorted(range(len(t)), key=lambda i: hashlib.md5(f"{t[i]}:{seed}".encode()).hexdigest())
        first = stack.reshape(len(t), -1)
        if k == 0:
            return empty
        if k > len(t):
            raise ValueError(f"{k} atoms are asked for from a block of {len(t)} frames; ask for fewer atoms or longer blocks")
        atoms = first[order[:k]].copy()
        atoms = learner(first, atoms, alpha, rounds, positive_code, positive_dict)
        keys = {"t": pa.array(np.arange(start, start + k), pa.int64()),
                "y0": pa.array(np.full(k, at["y0"], np.int32)), "x0": pa.array(np.full(k, at["x0"], np.int32))}
        return pa.Table.from_batches([frame_batch(keys, atoms.reshape(k, at["h"], at["w"]))])

    pieces = cut_blocks(frames, block, (0, 0, 0)).groupBy("tb", "yb", "xb").applyInArrow(learn, PIECES)
    return pieces_to_frames(pieces).withColumnRenamed("t", "atom")
