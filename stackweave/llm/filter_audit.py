"""Filter interaction audit: what each filter removes in every order, from sorted posting lists of failing ids."""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackweave.llm.batches import add_columns
from stackweave.session import Scratch

#: The filters by letter; filter k owns bit k of ``fails``.
FILTERS = "ABCDE"
#: Ids of one part whose posting lists are held and merged at once.
RANGE_ROWS = 1 << 16
#: Rows that one task of the merge gets, about.
TASK_ROWS = 200_000
#: Shares into which the ids of one text are dealt.
SALTS = 64
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
MARK = re.compile(rb"[#$%&*|]")
NOT_CAPITAL = bytes(set(range(256)) - set(range(65, 91)))


def text_failures(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Bits 0 to 3 of ``fails``: the filters that look at one text alone (null counts as empty)."""
    texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()
    points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
    fails = np.zeros(len(texts), np.int32)
    for k, (text, length) in enumerate(zip(texts, points)):
        words = text.split()  # bytes split at exactly \x20 and \x09-\x0D
        capitals = len(text.translate(None, NOT_CAPITAL))
        fails[k] = (
            (len(words) < 200)
            | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * capitals > 2 * length) << 2
            | (MARK.search(text) is not None) << 3
        )
    return {"fails": fails}


def failing_rows(docs: DataFrame, labels: DataFrame, scratch: Scratch, salts: int = SALTS) -> DataFrame:
    """The distinct ``(part, doc_id, same)`` of ``docs(doc_id, text, source)`` with ``fails, good, toxic, n``.

    ``same`` is the SHA-256 of the text and ``n`` the number of rows alike in all three. Texts leave the scan's
    task as digests only. The smallest id of a text is found by salted shares first, so a text that a third of
    all rows hold is no hot key. A null id is no smaller than any other and has no smaller one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("part"),
                       F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("same", F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)))
    rows = add_columns(rows, [("fails", T.IntegerType())], text_failures, drop=("text",))
    rows = scratch.write(rows.groupBy("part", "doc_id", "same", "fails").agg(F.count(F.lit(1)).alias("n")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "part"), F.lit(salts)).cast("int"))
    shares = salted.groupBy("same", "salt").agg(F.min("doc_id").alias("low"))
    lows = shares.groupBy("same").agg(F.min("low").alias("low"), F.expr("bit_or(shiftleft(1L, salt))").alias("shares"))
    present = F.expr(f"filter(sequence(0, {salts - 1}), s -> shiftright(shares, s) & 1L = 1L)")
    places = lows.select("same", "low", F.explode(present).alias("salt"))
    again = F.when(F.col("low") < F.col("doc_id"), 16).otherwise(0)
    marked = salted.join(places, ["same", "salt"]).select("part", "doc_id", "same", F.col("fails").bitwiseOR(again).alias("fails"), "n")
    judged = labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    known = marked.join(judged, marked["doc_id"] == judged["_id"], "left").drop("_id")
    return known.select("part", "doc_id", "same", "fails", "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def found_in(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Mask of the ``ids`` that the sorted list ``others`` holds. Both are sorted, so every search starts from the place of the one before."""
    at = np.searchsorted(others, ids)
    at[at == len(others)] = 0
    return others[at] == ids if len(others) else np.zeros(len(ids), bool)


def difference(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The ids that are not in ``others``; the shorter list gallops through the longer one."""
    if len(ids) <= len(others):
        return ids[~found_in(ids, others)]
    at = np.searchsorted(ids, others)
    at = at[(at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == others)]
    return np.delete(ids, at)


def union(lists: Sequence[np.ndarray]) -> np.ndarray:
    """All ids of several sorted lists, merged from the shortest to the longest."""
    merged = np.empty(0, np.int64)
    for ids in sorted(lists, key=len):
        longer, shorter = (ids, merged) if len(ids) > len(merged) else (merged, ids)
        fresh = difference(shorter, longer)
        merged = np.insert(longer, np.searchsorted(longer, fresh), fresh)
    return merged


def range_counts(postings: Sequence[np.ndarray], weight: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The counts of one id range: ``(filter, set of filters applied before, count)``, as in ``COUNTS``.

    Every order and step is one filter with the set of filters before it: 5 x 16 cases. All counts add up over
    ranges; ``shapley`` weighs a set by the number of orders in which just its filters come before.
    """
    k = len(postings)
    unions = [union([postings[f] for f in range(k) if before >> f & 1]) for before in range(1 << k)]
    sizes = [int(weight[u].sum()) for u in unions]
    everything, out = int(weight.sum()), np.zeros((k, 1 << k, len(COUNTS)), np.int64)
    for f, failing in enumerate(postings):
        own, size = 1 << f, int(weight[failing].sum())
        for before in (s for s in range(1 << k) if not s & own):
            left = difference(failing, unions[before])
            removed = int(weight[left].sum())
            held = weight[left]
            out[f, before, :3] = everything - sizes[before | own], removed, size - removed
            out[f, before, 4:6] = held[good[left]].sum(), held[toxic[left]].sum()
            orders = math.factorial(before.bit_count()) * math.factorial(k - 1 - before.bit_count())
            out[f, :, 6] += removed * orders
        out[f, :, 3] = out[f, (1 << k) - 1 - own, 1]
    return out


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of part and id to one sum per part, filter and set of filters before it."""
    sums: dict[str, np.ndarray] = {}
    held: list[pa.RecordBatch] = []

    def close() -> None:
        part, table = held[0].column("part")[0].as_py(), pa.Table.from_batches(held)
        weight, fails = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "fails"))
        good, toxic = (table.column(c).to_numpy() for c in ("good", "toxic"))
        counts = range_counts([np.flatnonzero(fails >> f & 1) for f in range(len(FILTERS))], weight, good, toxic)
        sums[part] = sums[part] + counts if part in sums else counts
        held.clear()

    for batch in batches:
        parts = batch.column("part")
        ends = np.flatnonzero(pc.not_equal(parts[1:], parts[:-1]).to_numpy(zero_copy_only=False)) + 1 if len(batch) > 1 else np.empty(0, int)
        for first, last in itertools.pairwise([0, *ends.tolist(), len(batch)]):
            while first < last:
                if held and (held[0].column("part")[0] != parts[first] or sum(map(len, held)) >= RANGE_ROWS):
                    close()
                taken = min(last - first, RANGE_ROWS - sum(map(len, held)))
                held.append(batch.slice(first, taken))
                first += taken
    if held:
        close()
    for part, counts in sums.items():
        f, before = np.nonzero([[not s >> k & 1 for s in range(counts.shape[1])] for k in range(counts.shape[0])])
        columns = [pa.array([part] * len(f), pa.string()), pa.array(f, pa.int32()), pa.array(before, pa.int32())]
        columns += [pa.array(counts[f, before, c], pa.int64()) for c in range(len(COUNTS))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "filter", "before", *COUNTS])


def audit(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per part of ``docs(doc_id, text, source)``, order of the five filters and step in it.

    Returns ``part, filter_order, step`` and the counts ``kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``. Rows are sorted by part and id and dealt over tasks by ranges, so a source with a third
    of all rows is many ranges. In a range every filter has one sorted list of the ids that fail it; unions and
    differences come from merging those lists, and their sizes are summed over ranges.

    Null texts are empty texts and a null source is the part ``''``; a null id fails E never and has no labels.
    Repeated rows count each, and none is a copy of another with the same id. ``labels(doc_id, quality, toxic)`` may
    repeat an id: one row with 1 is enough. An empty table gives no rows. Other columns are ignored. Very long texts are
    worked on alone.
    """
    rows = scratch.write(failing_rows(docs, labels, scratch))
    tasks = rows.count() // TASK_ROWS + 1
    dealt = rows.repartitionByRange(tasks, "part", "doc_id", "same").sortWithinPartitions("part", "doc_id", "same")
    schema = "part string, filter int, before int, " + ", ".join(f"{c} long" for c in COUNTS)
    ranges = dealt.select("part", "fails", "n", "good", "toxic").mapInArrow(_merge, schema)
    totals = ranges.groupBy("part", "filter", "before").agg(*[F.sum(c).alias(c) for c in COUNTS])
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order, 1):
            steps.append((name, step, f, before))
            before |= 1 << f
    # 600 rows, whatever the data.
    plan = F.broadcast(docs.sparkSession.createDataFrame(steps, "filter_order string, step int, filter int, before int"))
    return totals.join(plan, ["filter", "before"]).select("part", "filter_order", "step", *COUNTS)
