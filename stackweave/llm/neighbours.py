"""Approximate nearest neighbours on shifted space-filling curves: windows of several Hilbert orders, merged and reranked."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stackweave.session import Scratch

#: Curves, projected dimensions of each, and bits per dimension; dimensions times bits fit in a long.
CURVES, DIMENSIONS, CURVE_BITS, SEED = 4, 6, 10, 1
#: Queries whose exact neighbours set the width of the windows, and the share of neighbours to reach there.
CALIBRATION, REACH = 128, 0.96
#: Vectors that a task compares at once, and queries that it holds for them.
BLOCK, HELD = 8192, 4096


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates: the exact inverse of the curve's walk.

    Level by level from the top bit: each row's coordinates are reflected or exchanged according to the
    levels above, then the Gray code of the remaining bits is undone.
    """
    x = [cells[:, k].astype(np.int64).copy() for k in range(cells.shape[1])]
    top = 1 << (bits - 1)
    level = top
    while level > 1:
        low = level - 1
        for k in range(len(x)):
            set_ = (x[k] & level) != 0
            swap = np.where(set_, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[k] = x[k] ^ swap
        level >>= 1
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    flip = np.zeros_like(x[0])
    level = top
    while level > 1:
        flip = np.where((x[-1] & level) != 0, flip ^ (level - 1), flip)
        level >>= 1
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for k in range(len(x)):
            place = (place << 1) | (((x[k] ^ flip) >> bit) & 1)
    return place


def curve_keys(vectors: np.ndarray, curve: int) -> np.ndarray:
    """Hilbert places of the vectors' directions, seen in a random projection and shifted, one of each per curve."""
    d = vectors.shape[1]
    m = min(DIMENSIONS, d)
    rng = np.random.default_rng([SEED, curve, d])
    axes = np.linalg.qr(rng.normal(size=(d, m)))[0]
    shift = rng.uniform(0, 0.25, size=m)
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    # A coordinate of a random direction is about 1 / sqrt(d): four times that to either side is the cube.
    unit = (vectors / length) @ axes * math.sqrt(d) / 8 + 0.375 + shift
    cells = np.clip(unit * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1).astype(np.int64)
    return hilbert(cells, CURVE_BITS)


def _matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def usable(embeddings: DataFrame, scratch: Scratch) -> tuple[DataFrame, list[int]]:
    """``(vec_id, embedding)`` of the rows that take part, and the lengths of their vectors.

    Left out: null ids; null or empty vectors; vectors with null, NaN or infinite components; zero vectors.
    Rows that repeat an id are rows like others.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = scratch.write(rows.where(F.col("vec_id").isNotNull() & fine))
    return rows, sorted(r["d"] for r in rows.select(F.size("embedding").alias("d")).distinct().collect())


def _ordered(items: DataFrame, scratch: Scratch, d: int, curves: int) -> DataFrame:
    """``(curve, pos, item, vector)``: each item's place in each curve's order, from 0."""
    kind = "curve int, key long, item long, vector array<double>"
    schema = pa.schema([("curve", pa.int32()), ("key", pa.int64()), ("item", pa.int64()), ("vector", pa.list_(pa.float64()))])

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column("vector"), d)
                for curve in range(curves):
                    columns = [pa.array(np.full(batch.num_rows, curve, np.int32)), pa.array(curve_keys(vectors, curve)), batch.column("item"), batch.column("vector")]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = items.select("item", "vector").mapInArrow(keyed, kind)
    placed = rows.repartitionByRange("curve", "key", "item").sortWithinPartitions("curve", "key", "item")
    low = (1 << 33) - 1
    placed = scratch.write(placed.select("curve", "item", "vector", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit(low)).alias("row")))
    # One row per partition and curve tells where the partition begins.
    parts = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select("curve", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("start"))
    return scratch.write(placed.join(starts, ["curve", "part"]).select("curve", (F.col("start") + F.col("row")).alias("pos"), "item", "vector"))


def _best(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, allowed: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the query, row of the vector and inner product of each query's ``k`` best allowed vectors, ties to the smaller id.

    The matrix product only chooses candidates: all that reach the k-th best within its rounding. Their products are
    summed again pair by pair, so that equal vectors get equal numbers wherever they stand. Products beyond the range
    of doubles come first or last, undefined ones last.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        near = np.nan_to_num(queries @ vectors.T, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        if allowed is not None:
            near[~allowed] = -np.inf
        k = min(k, near.shape[1])
        least = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
        slack = 4e-16 * vectors.shape[1] * np.sqrt((queries * queries).sum(axis=1)) * np.sqrt((vectors * vectors).sum(axis=1).max(initial=0.0))
        enough = near >= np.where(np.isfinite(least), least - np.where(np.isfinite(slack), slack, np.inf), -np.inf)[:, None]
        row, column = np.nonzero(enough if allowed is None else enough & allowed)
        score = np.nan_to_num((queries[row] * vectors[column]).sum(axis=1), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
    order = np.lexsort((ids[column], -score, row))
    row, column, score = row[order], column[order], score[order]
    first = np.searchsorted(row, row)
    kept = np.arange(len(row)) - first < k
    return row[kept], column[kept], score[kept]


FOUND = "query long, item long, score double"
FOUND_SCHEMA = pa.schema([("query", pa.int64()), ("item", pa.int64()), ("score", pa.float64())])


def exact(items: DataFrame, asked: list[tuple[int, list[float]]], d: int, k: int) -> DataFrame:
    """The ``k`` best items of a bounded list of queries, against all items: ``(query, item, score)``."""
    ids, queries = np.array([a for a, _ in asked]), np.array([v for _, v in asked], dtype=np.float64).reshape(-1, d)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                item = batch.column("item").to_numpy()
                row, column, score = _best(queries, _matrix(batch.column("vector"), d), item, None, k)
                yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(item[column]), pa.array(score)], schema=FOUND_SCHEMA)

    best = W.partitionBy("query").orderBy(F.desc("score"), "item")
    found = items.select("item", "vector").mapInArrow(run, FOUND)
    return found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).drop("r")


def window_width(index: DataFrame, items: DataFrame, asked: DataFrame, d: int, k: int, reach: float) -> int:
    """How far from its own place a query must look so that ``reach`` of all true neighbours are met.

    ``CALIBRATION`` queries, the first in the order of a hash, are answered exactly by one pass over all
    items; the answer is the quantile of the neighbours' least distance in rank over the curves. On
    data with structure this is a small number whatever the size; on directions without any, no order helps
    and the windows come out wide.
    """
    some = asked.join(items, "item").orderBy(F.xxhash64("vector"), "item").limit(CALIBRATION).select("item", "vector").collect()
    true = exact(items, [(r["item"], r["vector"]) for r in some], d, k + 1).where("query <> item")
    pairs = true.toPandas()
    needed = sorted({*pairs["query"].tolist(), *pairs["item"].tolist()})
    if not needed:
        return k + 1
    wanted = items.sparkSession.createDataFrame([(x,) for x in needed], "item long")
    places = index.join(F.broadcast(wanted), "item").select("curve", "item", "pos").toPandas()
    at = places.pivot(index="item", columns="curve", values="pos")
    gaps = np.abs(at.loc[pairs["query"]].to_numpy() - at.loc[pairs["item"]].to_numpy()).min(axis=1)
    return max(k + 1, int(np.quantile(gaps, reach, method="higher")))


def search(
    embeddings: DataFrame, scratch: Scratch, asked: Column, k: int = 20, curves: int = CURVES, reach: float = REACH, block: int = BLOCK
) -> DataFrame:
    """The ``k`` nearest found of each row of ``embeddings(vec_id, embedding)`` that ``asked`` names.

    Nearness is the largest inner product, in double precision. Returns ``query_id, rank, vec_id, score``, nearest
    first, ties to the smaller vec_id; the query's own row is no candidate, another row with its id is. ``usable``
    says which rows take part; all candidates come back if there are fewer than ``k``. Vectors are compared with
    those of their own length; each length is a search of its own.

    Equal vectors are one item with their smallest ids, as many as any answer can hold, so copies cost
    nothing. Items get a place in each curve's order by range partitioning; a query compares itself with
    the items at most the window's width away on each curve. Windows count ranks, so dense regions
    do not widen them. Tasks work on blocks of an order: a fixed number of items and of queries.
    """
    rows, lengths = usable(embeddings, scratch)
    found = embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for d in lengths:
        some = rows if len(lengths) == 1 else scratch.write(rows.where(F.size("embedding") == d))
        found = _search(some, scratch, asked, k, curves, reach, block, d) if len(lengths) == 1 else found.unionByName(_search(some, scratch, asked, k, curves, reach, block, d))
    return found


def _search(rows: DataFrame, scratch: Scratch, asked: Column, k: int, curves: int, reach: float, block: int, d: int) -> DataFrame:
    """``search`` among vectors of one length."""
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # The limit per vector is applied before the shuffle as well.
    alike = W.partitionBy("embedding").orderBy("vec_id")
    first = rows.withColumn("r", F.row_number().over(alike)).where(F.col("r") <= k + 1)
    alike = first.groupBy(F.col("embedding").alias("vector")).agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    # Items are numbered in the order of their smallest ids, which ties follow.
    ordered = alike.withColumn("low", F.col("ids")[0]).repartitionByRange("low", "vector").sortWithinPartitions("low", "vector")
    items = scratch.write(ordered.select(F.monotonically_increasing_id().alias("item"), "vector", "ids"))
    queries = rows.where(asked).join(items.select("item", F.col("vector").alias("embedding")), "embedding").select(F.col("vec_id").alias("query_id"), "item")
    queries = scratch.write(queries.withColumn("row", F.monotonically_increasing_id()))
    searched = queries.select("item").distinct()
    index = _ordered(items, scratch, d, curves)
    n, q = items.count(), searched.count()
    if q == 0:
        return empty
    width = min(n, window_width(index, items, searched, d, k, reach))
    chunks = max(1, math.ceil(q * min(n, 2 * width + block) / n / HELD))
    blocks = index.withColumn("block", F.floor(F.col("pos") / block)).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    looking = index.join(searched, "item").withColumn(
        "block", F.explode(F.sequence(F.floor(F.greatest(F.lit(0), F.col("pos") - width) / block), F.floor(F.least(F.lit(n - 1), F.col("pos") + width) / block))))
    looking = looking.withColumn("chunk", F.pmod(F.xxhash64("item"), F.lit(chunks)).cast("int"))
    # Fresh names for the columns that both sides have from the index.
    looking = looking.select(F.col("curve").alias("own_curve"), "block", "chunk", F.col("pos").alias("at"), F.col("item").alias("query"), F.col("vector").alias("asking"))

    def compare(held: pa.Table, asking: pa.Table) -> pa.Table:
        out = []
        if held.num_rows and asking.num_rows:
            vectors, pos, item = _matrix(held.column("vector"), d), held.column("pos").to_numpy(), held.column("item").to_numpy()
            who, at, query = _matrix(asking.column("asking"), d), asking.column("at").to_numpy(), asking.column("query").to_numpy()
            for s in range(0, len(query), 256):
                part = slice(s, s + 256)
                row, column, score = _best(who[part], vectors, item, np.abs(at[part, None] - pos[None, :]) <= width, k + 1)
                out.append(pa.Table.from_arrays([pa.array(query[part][row]), pa.array(item[column]), pa.array(score)], schema=FOUND_SCHEMA))
        return pa.concat_tables(out) if out else FOUND_SCHEMA.empty_table()

    found = blocks.groupBy("curve", "block", "chunk").cogroup(looking.groupBy("own_curve", "block", "chunk")).applyInArrow(compare, FOUND)
    best = W.partitionBy("query").orderBy(F.desc("score"), "item")
    found = found.dropDuplicates(["query", "item"]).withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    nearest = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = found.join(items.select("item", "ids"), "item").select("query", F.col("item").alias("found"), "score", "ids", F.posexplode("ids").alias("place", "vec_id"))
    named = named.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k + 1)
    answers = queries.join(named.drop("r"), queries["item"] == named["query"])
    own = (F.col("found") == F.col("item")) & (F.col("place") == F.array_position("ids", F.col("query_id")) - 1)
    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = answers.where(~own).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
