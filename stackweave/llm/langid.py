"""Language of a text: averaged hashed subword embeddings, linear softmax, SGD in numpy, calibrated rejection."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackweave.llm.batches import add_columns

UNKNOWN = "und"
#: Documents to learn from in all, and at least so many of each language if there are.
SAMPLE, LEAST_EACH = 6_000, 40
#: Buckets of hashed subwords, width of an embedding, passes over the sample, documents per step.
BUCKETS, WIDTH, EPOCHS, STEP, RATE, SEED = 1 << 16, 16, 8, 32, 0.5, 8
#: Of accepted calibration documents, at most so many may be wrong.
WRONG = 0.005
LETTER = regex.compile(r"\p{L}")
SIZES = (2, 3, 4)


def _letter_codes() -> np.ndarray:
    """Lower-case code of each letter of the basic plane, 32 for every other sign."""
    codes = np.full(1 << 16, 32, dtype=np.uint32)
    for c in range(1 << 16):
        sign = chr(c)
        if sign.isalpha():
            low = sign.lower()
            codes[c] = ord(low) if len(low) == 1 else c
    return codes


_codes: list[np.ndarray] = []


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of each subword: 2 to 4 signs of a word with a blank at either end."""
    if not _codes:
        _codes.append(_letter_codes())
    joined = " " + "  ".join(texts) + " "
    signs = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(signs < (1 << 16), _codes[0][signs & 0xFFFF], signs)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])[: len(codes)]
    blank = codes == 32
    buckets, owners = [], []
    hashed = codes.astype(np.uint64)
    inner = np.zeros(len(codes), dtype=bool)
    for size in range(2, max(SIZES) + 1):
        n = len(codes) - size + 1
        if n <= 0:
            break
        hashed = hashed[:n] * np.uint64(0x100000001B3) + codes[size - 1 :]
        if size > 2:  # a blank inside would join two words
            inner = inner[:n] | blank[size - 2 : size - 2 + n]
        good = ~inner[:n] & ~(blank[:n] & blank[size - 1 :]) if size <= 2 else ~inner[:n]
        if size not in SIZES:
            continue
        mixed = (hashed[good] ^ np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
        buckets.append((mixed >> np.uint64(48)).astype(np.int64))
        owners.append(owner[:n][good])
    return np.concatenate(buckets or [np.zeros(0, np.int64)]), np.concatenate(owners or [np.zeros(0, np.int64)])


@dataclass
class Model:
    """``table``: logits of a subword per language, embedding times softmax weights."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, texts: list[str]) -> np.ndarray:
        bucket, owner = subwords(texts)
        count = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        logits = np.column_stack([np.bincount(owner, weights=self.table[bucket, k], minlength=len(texts)) for k in range(len(self.langs))])
        return softmax((logits / count[:, None] + self.bias) / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sums_by(group: np.ndarray, rows: np.ndarray, groups: int) -> np.ndarray:
    """Sums of rows by group; ``group`` ascends."""
    out = np.zeros((groups, rows.shape[1]))
    if len(group):
        head = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        out[group[head]] = np.add.reduceat(rows, head)
    return out


def train(counts: list[tuple[np.ndarray, np.ndarray]], langs: list[str], names: list[str]) -> Model:
    """Fit on documents given as (buckets, shares); every tenth only calibrates."""
    rng = np.random.default_rng(SEED)
    target = np.array([names.index(x) for x in langs])
    embed = rng.normal(scale=1 / WIDTH, size=(BUCKETS, WIDTH))
    weight, bias = rng.normal(scale=0.1, size=(WIDTH, len(names))), np.zeros(len(names))
    order = rng.permutation(len(counts))
    held = order[::10] if len(counts) >= 20 else order[:0]
    fitted = np.setdiff1d(order, held) if len(held) else order
    steps = max(1, EPOCHS * math.ceil(len(fitted) / STEP))
    done = 0
    for _ in range(EPOCHS):
        fitted = rng.permutation(fitted)
        for k in range(0, len(fitted), STEP):
            some = fitted[k : k + STEP]
            rate = RATE * (1 - done / steps)
            bucket = np.concatenate([counts[i][0] for i in some])
            share = np.concatenate([counts[i][1] for i in some])
            owner = np.repeat(np.arange(len(some)), [len(counts[i][0]) for i in some])
            hidden = sums_by(owner, share[:, None] * embed[bucket], len(some))
            error = softmax(hidden @ weight + bias)
            error[np.arange(len(some)), target[some]] -= 1
            back = error @ weight.T
            weight -= rate * hidden.T @ error
            bias -= rate * error.mean(axis=0)
            # Every document moves its own subwords by their share in it; repeated subwords add up.
            where, place = np.unique(bucket, return_inverse=True)
            by_bucket = np.argsort(place, kind="stable")
            embed[where] -= rate * 20 * sums_by(place[by_bucket], share[by_bucket, None] * back[owner[by_bucket]], len(where))
            done += 1
    model = Model(names, embed @ weight, bias, 1.0, 0.0)
    if len(held):
        raw = np.stack([counts[i][1] @ model.table[counts[i][0]] + bias for i in held])
        losses = [(-np.log(softmax(raw / t)[np.arange(len(held)), target[held]] + 1e-12).mean(), t) for t in np.geomspace(0.05, 5, 40)]
        model.temperature = float(min(losses)[1])
        sure = softmax(raw / model.temperature)
        best, right = sure.max(axis=1), sure.argmax(axis=1) == target[held]
        order = np.argsort(-best)
        share_wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
        fine = np.flatnonzero(share_wrong <= WRONG)
        model.threshold = float(best[order][fine[-1]]) if len(fine) else 1.0
    return model


def fold(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string")) % 4


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from ``docs(doc_id, text, lang)`` whose fold is not 2 and whose lang is not null.

    The learner sees a bounded sample: of each language the documents first in the order of a hash of
    doc_id, ``sample`` in all or ``LEAST_EACH`` of each. The ids are chosen from the narrow columns; only
    the sample's subword counts come to the driver. None if there is nothing to learn from. Very long texts count
    whole; ties of hashes go to the smaller id; repeated rows of an id and language count once, with their first text.
    """
    known = docs.where("lang is not null and text is not null and doc_id is not null").where(fold() != 2)
    ids = known.select(F.col("doc_id").alias("_id"), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("_h"), "lang").distinct()
    # One row per language; repeated rows of an id count once.
    numbers = {r["lang"]: r["count"] for r in ids.groupBy("lang").count().collect()}
    names = sorted(numbers)
    if not names:
        return None
    share = max(LEAST_EACH, sample // len(names))
    # Only ids whose hash is low enough for about twice the share go on to be put in order; the lowest of each language always do.
    enough = F.create_map(*[F.lit(x) for k in names for x in (k, int(min(1.0, (2 * share + 50) / numbers[k]) * (1 << 40)))])
    lowest = ids.groupBy("lang").agg(F.min(F.struct("_h", "_id")).alias("s")).select("s._id", "s._h", "lang")
    low = ids.where(F.col("_h") < enough[F.col("lang")]).unionByName(lowest).distinct()
    each = W.partitionBy("lang").orderBy("_h", "_id")
    chosen = low.withColumn("_r", F.row_number().over(each)).where(F.col("_r") <= share).select("_id", F.col("lang").alias("_lang"))
    rows = known.join(F.broadcast(chosen), (known["doc_id"] == chosen["_id"]) & (known["lang"] == chosen["_lang"]), "left_semi")
    # Of rows that repeat an id and language the first text counts, so the sample is bounded by its ids.
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        buckets, shares = [], []
        texts = batch.column("text").to_pylist()
        bucket, owner = subwords(texts)
        order = np.argsort(owner, kind="stable")
        bucket, cuts = bucket[order], np.searchsorted(owner[order], np.arange(len(texts) + 1))
        for first, last in zip(cuts[:-1], cuts[1:]):
            found, times = np.unique(bucket[first:last], return_counts=True)
            buckets.append(found.astype(np.int32))
            shares.append((times / max(1, times.sum())).astype(np.float32))
        return {"buckets": buckets, "shares": shares}

    fields = [("buckets", T.ArrayType(T.IntegerType())), ("shares", T.ArrayType(T.FloatType()))]
    found = add_columns(rows.select("doc_id", "lang", "text"), fields, work, drop=("text",)).toArrow().sort_by("doc_id")
    columns = [found.column(n).combine_chunks() for n in ("buckets", "shares")]
    counts = [(columns[0][i].values.to_numpy().astype(np.int64), columns[1][i].values.to_numpy()) for i in range(len(found))]
    return train(counts, found.column("lang").to_pylist(), names)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected``.

    ``lang_pred`` is the likeliest learned language of the whole text; ``und`` with score 0 where the text
    is null or has no letter, or nothing was learned. ``score`` is its calibrated probability; ``rejected``
    says that it lies under the threshold at which the accepted rest is nearly always right.
    Rows without doc_id or lang are treated alike; columns of the same names are replaced.
    """
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        letters = np.array([bool(LETTER.search(t)) for t in texts], dtype=bool)
        if model is None:
            return {"lang_pred": [UNKNOWN] * len(texts), "score": np.zeros(len(texts)), "rejected": np.ones(len(texts), dtype=bool)}
        sure = model.probabilities(texts)
        best = sure.argmax(axis=1)
        score = np.where(letters, sure[np.arange(len(texts)), best], 0.0)
        pred = [model.langs[k] if known else UNKNOWN for k, known in zip(best.tolist(), letters)]
        return {"lang_pred": pred, "score": score, "rejected": (score < model.threshold) | ~letters}

    return add_columns(docs, fields, work)
