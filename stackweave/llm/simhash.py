"""Near duplicates by SimHash: 64-bit fingerprints, pigeonring candidate filter, linked groups."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackweave.llm.batches import add_columns, free_name
from stackweave.operators.graph import connected_groups
from stackweave.session import Scratch

BITS, SEED = 64, 42
#: Rows of one candidate key that a task holds; keys with more are split into pairs of blocks.
KEY_ROWS = 20_000


def fingerprint(text: str | None, words: int = 4) -> int:
    """Fingerprint of a whole text; 0 without words. Only A-Z are lower-cased."""
    own = (text or "").encode().lower().split()
    if not own:
        return 0
    data, digest = b" ".join(own), xxhash.xxh64_intdigest
    if len(own) <= words:
        hashes = [digest(data, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in own])
        starts = np.concatenate([[0], ends[:-words]]).tolist()
        hashes = [digest(data[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())]
    count = np.zeros(BITS, dtype=np.int64)
    values = np.array(hashes, dtype="<u8")
    for k in range(0, len(values), 1 << 16):
        some = values[k : k + (1 << 16)]
        count += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_ = (2 * count > len(values)).astype(np.uint8)
    return int(np.packbits(set_, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, column: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed long; null texts are empty."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        prints = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        return {column: pa.array(prints.view(np.int64))}

    return add_columns(docs, [(column, T.LongType())], work)


def segments(distance: int) -> list[tuple[int, int]]:
    """First bit and width of the ``distance + 1`` segments of a fingerprint, as even as possible."""
    m = distance + 1
    edges = [round(BITS * k / m) for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _part(prints: np.ndarray, segment: tuple[int, int]) -> np.ndarray:
    first, width = segment
    return (prints >> np.uint64(first)) & np.uint64((1 << width) - 1)


def ring_keys(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, fingerprints and probe marks under which linked fingerprints meet.

    By the pigeonring principle two fingerprints at most ``distance`` bits apart, cut into
    ``distance + 1`` segments on a ring, have a segment from which every chain of k segments differs
    in at most ``k * distance / (distance + 1)`` bits: none in the first, one in the first two, and
    so on. A fingerprint is filed under each (segment, next segment) and asked for under the values
    of the next segment with one more bit set, so pairs meet at both counts.
    """
    ring = segments(distance)
    keys, owners, probes = [], [], []
    for k, segment in enumerate(ring):
        after = ring[(k + 1) % len(ring)]
        following = _part(prints, after)
        base = (np.uint64(k) << np.uint64(56)) | (_part(prints, segment) << np.uint64(28))
        keys.append(base | following)
        owners.append(prints)
        probes.append(np.zeros(len(prints), dtype=bool))
        for bit in range(after[1] if len(ring) > 1 else 0):
            off = (following >> np.uint64(bit)) & np.uint64(1) == 0
            keys.append((base | following | np.uint64(1 << bit))[off])
            owners.append(prints[off])
            probes.append(np.ones(int(off.sum()), dtype=bool))
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(probes)


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def linked(keys: np.ndarray, prints: np.ndarray, probes: np.ndarray, groups: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each run of equal ``groups``; rows are in group order.

    Rows are compared at growing steps inside their run; pairs already connected are skipped, others
    pass the chain budgets from their key's segment on, then the whole distance.
    """
    ring = segments(distance)
    masks = [np.uint64(((1 << w) - 1) << a) for a, w in ring]
    root = np.arange(len(keys))
    start = (keys >> np.uint64(56)).astype(np.int64)
    # Masks of the chains of 3, 4, ... segments that begin at each segment.
    chains = []
    for length in range(3, len(ring) + 1):
        chains.append(np.array([np.bitwise_or.reduce([masks[(k + j) % len(ring)] for j in range(length)]) for k in range(len(ring))], dtype=np.uint64))
    left, right = [], []
    at, step = np.arange(len(keys) - 1), 1
    while len(at):
        at = at[at + step < len(keys)]
        at = at[groups[at] == groups[at + step]]
        a, b = at, at + step
        open_ = (root[a] != root[b]) & ~(probes[a] & probes[b]) & (prints[a] != prints[b])
        a, b = a[open_], b[open_]
        for extra, chain in enumerate(chains):
            near = _differing(prints[a] & chain[start[a]], prints[b] & chain[start[a]]) <= (extra + 3) * distance // len(ring)
            a, b = a[near], b[near]
        near = _differing(prints[a], prints[b]) <= distance
        for x, y in zip(a[near].tolist(), b[near].tolist()):
            rx, ry = x, y
            while root[rx] != rx:
                rx = root[rx]
            while root[ry] != ry:
                ry = root[ry]
            if rx != ry:
                root[max(rx, ry)] = min(rx, ry)
                left.append(x)
                right.append(y)
        if near.any():
            while (upper := root[root]).tobytes() != root.tobytes():
                root = upper
        step += 1
    return prints[np.array(left, dtype=np.int64)], prints[np.array(right, dtype=np.int64)]


FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b", "key")] + [T.StructField("probe", T.BooleanType())])


def _links(rows: DataFrame, distance: int, most: int | None) -> DataFrame:
    """Links ``(a, b)`` between fingerprints that share ``(key, share)`` in ``rows(key, share, fp, probe)``.

    Runs over ``most`` rows are not worked on but passed through, with a null ``b``.
    """
    placed = rows.repartition("key", "share").sortWithinPartitions("key", "share")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("probe", pa.bool_())])

    def batch(a, b, key, probe) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, key, probe], schema=schema)

    def found(key, share, fp, probe) -> Iterator[pa.RecordBatch]:
        run = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (share[1:] != share[:-1]))]) if len(key) else key
        if most is not None and len(key):
            large = np.bincount(run)[run] > most
            if large.any():
                n = int(large.sum())
                yield batch(fp[large], pa.nulls(n, pa.int64()), pa.array(key[large]), pa.array(probe[large]))
                key, fp, probe, run = key[~large], fp[~large], probe[~large], run[~large]
        a, b = linked(key.view(np.uint64), fp.view(np.uint64), probe, run, distance)
        yield batch(a.view(np.int64), pa.array(b.view(np.int64)), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.bool_()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        too_long = None  # a run that already has more rows than may be held
        for b in batches:
            columns = [b.column(n).to_numpy(zero_copy_only=False) for n in ("key", "share", "fp", "probe")]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            key, share, fp, probe = columns
            if not len(key):
                continue
            if too_long is not None:
                same = (key == too_long[0]) & (share == too_long[1])
                if same.any():
                    n = int(same.sum())
                    yield batch(fp[same], pa.nulls(n, pa.int64()), pa.array(key[same]), pa.array(probe[same]))
                    key, share, fp, probe = key[~same], share[~same], fp[~same], probe[~same]
                    if not len(key):
                        held = None
                        continue
                too_long = None
            last = np.flatnonzero((key == key[-1]) & (share == share[-1]))[0]
            yield from found(key[:last], share[:last], fp[:last], probe[:last])
            held = [c[last:] for c in (key, share, fp, probe)]
            if most is not None and len(held[0]) > most:
                too_long = (key[-1], share[-1])
                yield from found(*held)
                held = None
        if held is not None:
            yield from found(*held)

    return placed.mapInArrow(run, FOUND)


def links(prints: DataFrame, scratch: Scratch, distance: int = 4, most: int = KEY_ROWS) -> DataFrame:
    """Edges ``(a, b)`` that connect all fingerprints ``prints(fp)`` (distinct) within ``distance`` bits.

    Every two fingerprints so near are connected by a path of the edges; of a key's pairs only a
    spanning forest leaves a task. A key with more than ``most`` rows is cut into blocks, each pair of
    blocks is a task's work, and again only forests come out: no pair is left out.
    """
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("share", T.LongType()), T.StructField("fp", T.LongType()), T.StructField("probe", T.BooleanType())])
    arrow = pa.schema([("key", pa.int64()), ("share", pa.int64()), ("fp", pa.int64()), ("probe", pa.bool_())])

    def file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(values), 4096):
                key, own, probe = ring_keys(values[k : k + 4096], distance)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.zeros(len(key), np.int64)), pa.array(own.view(np.int64)), pa.array(probe)], schema=arrow)

    found = scratch.write(_links(prints.select("fp").mapInArrow(file, schema), distance, most))
    edges = found.where("b is not null").select("a", "b")
    over = found.where("b is null").select("key", F.col("a").alias("fp"), "probe")
    if over.isEmpty():
        return edges
    half = max(1, most // 2)
    blocks = over.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(half)).cast("long").alias("blocks"))
    dealt = over.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("fp", "probe"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    share = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other") + 1
    return edges.unionByName(_links(dealt.select("key", share.alias("share"), "fp", "probe"), distance, None).select("a", "b"))


def groups(docs: DataFrame, scratch: Scratch, words: int = 4, distance: int = 4) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, fp, component_id``.

    Documents link where their fingerprints differ in at most ``distance`` bits; ``component_id`` is
    the smallest doc_id that can be reached. Copies share a fingerprint and take part once, whatever
    their number. Null and wordless texts have fingerprint 0 and link like others; a null doc_id is
    never a component_id unless its group has no other. Repeated rows are returned as often as they
    come; an empty table gives an empty one.
    """
    marked = scratch.write(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), words).drop("text"))
    prints = scratch.write(marked.groupBy("fp").agg(F.min("doc_id").alias("low")))
    edges = scratch.write(links(prints, scratch, distance).distinct())
    members = connected_groups(edges, scratch).withColumnRenamed("id", "fp").join(prints, "fp")
    lows = members.groupBy("grp").agg(F.min("low").alias("component_id"))
    components = members.join(lows, "grp").select("fp", "component_id")
    # Written, so that the join below stands alone and a fingerprint with very many copies can be split.
    named = scratch.write(prints.join(components, "fp", "left").select("fp", F.coalesce("component_id", "low").alias("component_id")))
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, scratch: Scratch, words: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group: that with the smallest doc_id."""
    found = groups(docs, scratch, words, distance).where("doc_id <=> component_id")
    found = found.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_same")).distinct()
    name = free_name(docs, "_fp")
    marked = fingerprints(docs, words, name)
    same = marked["doc_id"].cast("long").eqNullSafe(found["_id"]) & (marked[name] == found["_same"])
    return marked.join(found, same, "left_semi").dropDuplicates(["doc_id", name]).drop(name)
