"""Quality classifier: document statistics, random Fourier features, ridge by summed normal equations, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackweave.llm.batches import add_columns, text_slices
from stackweave.session import Scratch

STATISTICS = (
    "log_bytes", "log_words", "word_length", "long_words", "one_byte_words", "upper", "lower", "digits", "space", "newlines",
    "stops", "marks", "symbols", "bars", "beyond_ascii", "shouted_words", "symbol_ends", "letterless_words", "repeated_bytes",
    "repeated_words", "repeated_pairs", "line_length", "repeated_lines",
)
#: Random Fourier features, ridge penalty per row, and bins of raw scores for the isotonic fit.
FEATURES, PENALTY, BINS, SEED = 256, 1e-4, 2048, 2
#: A document is predicted to be good from this calibrated score on.
ACCEPT = 0.3

UPPER, LOWER, DIGIT, BLANK, NEWLINE, STOP, MARK, SYMBOL, BAR, BEYOND = range(10)


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, SYMBOL, dtype=np.uint8)
    kinds[128:] = BEYOND
    for kind, signs in ((STOP, ".,;:?'\"()-"), (MARK, "!"), (BAR, "|"), (BLANK, " \t\r\v\f"), (NEWLINE, "\n"), (DIGIT, "0123456789")):
        kinds[[ord(s) for s in signs]] = kind
    kinds[65:91], kinds[97:123] = UPPER, LOWER
    return kinds


CLASSES = _byte_classes()


def _run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, from its length, its sum and its sum weighted by place."""
    spread = data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    spread ^= spread >> np.uint64(29)
    plain = np.concatenate([[np.uint64(0)], np.cumsum(spread, dtype=np.uint64)])
    spread *= np.arange(len(data), dtype=np.uint64)
    placed = np.concatenate([[np.uint64(0)], np.cumsum(spread, dtype=np.uint64)])
    total = plain[ends] - plain[starts]
    weighted = placed[ends] - placed[starts] - starts.astype(np.uint64) * total
    return (total ^ (weighted * np.uint64(0xC2B2AE3D27D4EB4F))) + (ends - starts).astype(np.uint64)


def _repeats(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Share of each owner's hashes that it has seen before."""
    order = np.lexsort((hashes, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    seen = np.bincount(owner[order][1:][same], minlength=n)
    return seen / np.maximum(np.bincount(owner, minlength=n), 1)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of numbers per whole text; null and empty texts give zeros."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer("\n".join(texts.to_pylist()).encode(), dtype=np.uint8)  # one line end between two texts
    if n == 0 or not len(data):
        return np.zeros((n, len(STATISTICS)))
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    owner = np.repeat(np.arange(n), sizes + 1)[: len(data)]
    kinds = CLASSES[data]
    inside = np.ones(len(data), dtype=bool)
    inside[firsts[1:] - 1] = False
    counts = np.bincount((owner * 10 + kinds)[inside], minlength=10 * n).reshape(n, 10).astype(float)
    size = np.maximum(sizes, 1)

    solid = (kinds != BLANK) & (kinds != NEWLINE)
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    word_owner = owner[starts] if len(starts) else starts
    words = np.bincount(word_owner, minlength=n)
    per_word = np.maximum(words, 1)

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(word_owner, weights=mask, minlength=n) / per_word

    def inside_words(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[ends] - total[starts]

    length = ends - starts
    letters = inside_words((kinds == UPPER) | (kinds == LOWER) | (kinds == BEYOND))
    last = kinds[ends - 1] if len(ends) else kinds[:0]
    hashes = _run_hashes(data, starts, ends)
    pairs = hashes[:-1] * np.uint64(3) ^ hashes[1:]
    neighbours = word_owner[1:] == word_owner[:-1]
    breaks = np.flatnonzero(data == 10)
    line_starts, line_ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(data)]])
    full = line_ends > line_starts
    line_starts, line_ends = line_starts[full], line_ends[full]
    line_owner = owner[line_starts]
    lines = np.bincount(line_owner, minlength=n)
    equal = np.concatenate([[False], (data[1:] == data[:-1]) & inside[:-1]]) & inside
    columns = [
        np.log1p(sizes), np.log1p(words), np.bincount(word_owner, weights=length, minlength=n) / per_word,
        of_words(length > 14), of_words(length == 1),
        *[counts[:, k] / size for k in (UPPER, LOWER, DIGIT, BLANK, NEWLINE, STOP, MARK, SYMBOL, BAR, BEYOND)],
        of_words((inside_words(kinds == UPPER) == length) | ((last == MARK) & (inside_words(kinds == LOWER) == 0))),
        of_words((last == SYMBOL) | (last == MARK)), of_words(letters == 0),
        np.bincount(owner[equal], minlength=n) / size,
        _repeats(word_owner, hashes, n), _repeats(word_owner[1:][neighbours], pairs[neighbours], n),
        np.log1p(sizes / np.maximum(lines, 1)), _repeats(line_owner, _run_hashes(data, line_starts, line_ends), n),
    ]
    return np.column_stack(columns)


def document_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with ``stats``, its text left out: reads each text once, whole."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        found = statistics(batch.column("text"))
        return {"stats": pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))}

    return add_columns(docs, [("stats", T.ArrayType(T.DoubleType()))], work, drop=("text",))


@dataclass
class Model:
    """A fitted classifier: a few thousand numbers, sent to tasks inside their function."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    levels: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.mean, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.edges, self.levels), 0.0, 1.0)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics for a Gaussian kernel, and a constant.

    The kernel's width is the square root of the number of statistics: the usual distance of two
    standardised documents. Values beyond 8 deviations count as 8.
    """
    rng = np.random.default_rng(SEED)
    d = stats.shape[1]
    directions = rng.normal(size=(d, FEATURES)) / np.sqrt(d)
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((stats - mean) / scale, -8, 8)
    return np.column_stack([np.sqrt(2 / FEATURES) * np.cos(z @ directions + phases), np.ones(len(stats))])


def _matrix(batch: pa.RecordBatch, column: str = "stats") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(STATISTICS))


def _summed(rows: DataFrame, work, scratch_rows: int) -> np.ndarray:
    """The sum over all batches of the matrix that ``work`` makes of each, as one matrix on the driver.

    A task sends one sum; sums meet by matrix row, so the driver gets ``scratch_rows`` rows.
    """
    kind = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", T.ArrayType(T.DoubleType()))])
    schema = pa.schema([("i", pa.int32()), ("v", pa.list_(pa.float64()))])

    def out(total: np.ndarray) -> pa.RecordBatch:
        values = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), total.shape[1]).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), values], schema=schema)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = work(batch)
                total = one if total is None else total + one
        if total is not None:
            yield out(total)

    def add(table: pa.Table) -> pa.Table:
        values = table.column("v").combine_chunks()
        total = values.flatten().to_numpy().reshape(table.num_rows, -1).sum(axis=0, keepdims=True)
        return pa.Table.from_batches([out(total)]).set_column(0, "i", table.column("i").slice(0, 1))

    found = rows.mapInArrow(partial, kind).groupBy("i").applyInArrow(add, kind).toArrow().sort_by("i")
    if found.num_rows == 0:
        return np.zeros((scratch_rows, 0))
    return np.array(found.column("v").to_pylist())


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` under ``weights``: neighbours out of order are pooled."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, k = blocks.pop()
            blocks[-1] = [(blocks[-1][0] * blocks[-1][1] + v * w) / (blocks[-1][1] + w), blocks[-1][1] + w, blocks[-1][2] + k]
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


def fit(labelled: DataFrame, calibrating: Column) -> Model | None:
    """Fit on ``labelled(stats, y)``; rows where ``calibrating`` holds only fit the calibration.

    Every labelled row takes part. The first pass sums moments, the second the normal equations of
    the Fourier features, the third bins raw scores of the calibration rows; the driver gets matrices
    of fixed size. None without rows to fit. Without calibration rows the raw score is clipped.
    """
    train = labelled.where(~calibrating)
    d = len(STATISTICS)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch)
        return np.stack([x.sum(axis=0), (x * x).sum(axis=0), np.full(d, float(len(x)))])

    sums = _summed(train, moments, 3)
    if sums.shape[1] == 0:
        return None
    mean = sums[0] / sums[2]
    spread = np.sqrt(np.maximum(sums[1] / sums[2] - mean**2, 0))
    scale = np.where(spread > 1e-9, spread, 1.0)

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z = fourier(_matrix(batch), mean, scale)
        return np.column_stack([z.T @ z, z.T @ batch.column("y").to_numpy(zero_copy_only=False)])

    both = _summed(train, equations, FEATURES + 1)
    gram, right = both[:, :-1], both[:, -1]
    weights = np.linalg.solve(gram + PENALTY * sums[2][0] * np.eye(len(gram)), right)
    centres = np.linspace(-0.5, 1.5, BINS)

    def binned(batch: pa.RecordBatch) -> np.ndarray:
        raw = fourier(_matrix(batch), mean, scale) @ weights
        at = np.clip(np.round((raw + 0.5) / 2 * (BINS - 1)), 0, BINS - 1).astype(int)
        y = batch.column("y").to_numpy(zero_copy_only=False)
        return np.stack([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)]).astype(float)

    seen = _summed(labelled.where(calibrating), binned, 2)
    if seen.shape[1] == 0:
        return Model(mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    used = seen[0] > 0
    levels = isotonic(seen[1][used] / seen[0][used], seen[0][used])
    return Model(mean, scale, weights, centres[used], levels)


def scored(rows: DataFrame, model: Model | None) -> DataFrame:
    """``rows(stats)`` with ``score`` and ``predicted``; without a model all score 1."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        found = model.score(_matrix(batch)) if model else np.ones(batch.num_rows)
        return {"score": pa.array(found), "predicted": pa.array((found >= ACCEPT).astype(np.int32))}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch)
            keep = [n for n in batch.schema.names if n not in ("stats", "score", "predicted")]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], made["score"], made["predicted"]], names=[*keep, "score", "predicted"])

    kept = [f for f in rows.schema.fields if f.name not in ("stats", "score", "predicted")]
    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def fold(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string")) % 5


def train(stats: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on the labelled documents of ``stats(doc_id, stats)`` whose fold is not 0; fold 4 calibrates.

    Labels other than 0 and 1 are left out; several labels of one document count as their mean, and
    a document that comes more than once counts as often.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.avg("quality").alias("y"))
    labelled = stats.join(known, stats["doc_id"] == known["_id"]).where(fold() != 0)
    return fit(labelled.select("doc_id", "stats", "y"), fold() == 4)


def classify(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    Scores come from text alone. Empty and null texts are scored like others; rows without doc_id are
    scored too and belong to no fold (held_out false). Repeated rows are returned as often as they come.
    """
    stats = scratch.write(document_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")))
    found = scored(stats, train(stats, labels))
    return found.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns; trained like ``classify``."""
    model = train(scratch.write(document_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))), labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                if model:
                    part = part.filter(pa.array(model.score(statistics(part.column("text"))) >= ACCEPT))
                yield part

    return docs.mapInArrow(run, docs.schema)
