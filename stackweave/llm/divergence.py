"""Source divergence audit: term frequencies by single-pass in-memory indexing, then how sources differ."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stackweave.llm.batches import text_slices
from stackweave.session import Scratch

#: Terms of lower-cased UTF-8: letters of ASCII and every byte of the signs beyond it.
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Postings of a block; the block is spilled as a run when it holds so many.
BLOCK_POSTINGS = 1 << 20
#: Documents of its language that a kept term is in, at least.
LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Pairs of postings of one term that are worked on at once.
PAIR_ROWS = 1 << 20
POSTINGS = ("source", "n", "docs")
RUN_SQL = "term string, lang string, source array<string>, n array<long>, docs array<long>"
FLAT = pa.schema([("term", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
FREQUENCIES = "lang string, term string, source string, n long, in_lang long"


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8; only A-Z are lower-cased, as ``bytes.lower`` does."""
    return TERM.findall(text.lower())


def spill_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index texts block by block. A full block leaves as one run: a row per term and language, in that order, with its postings."""
    counts: dict[tuple[bytes, bytes], Counter] = {}
    docs: dict[tuple[bytes, bytes], Counter] = {}

    def run() -> Iterator[pa.RecordBatch]:
        columns = [[], [], [], [], []]
        for (lang, source), block in counts.items():
            k = len(block)
            made = ([lang] * k, [source] * k, list(block))
            columns[1].append(pa.array(made[0], pa.binary())), columns[2].append(pa.array(made[1], pa.binary())), columns[0].append(pa.array(made[2], pa.binary()))
            columns[3].append(pa.array(np.fromiter(block.values(), np.int64, k)))
            columns[4].append(pa.array(np.fromiter(map(docs[lang, source].__getitem__, block), np.int64, k)))
        counts.clear(), docs.clear()
        if columns[0]:
            flat = pa.Table.from_arrays([pa.chunked_array(c) for c in columns], names=FLAT.names)
            yield from _listed(flat.sort_by([(c, "ascending") for c in ("term", "lang", "source")])).to_batches(max_chunksize=1 << 16)

    held = 0
    for batch in batches:
        for part in text_slices(batch):
            for lang, source, text in zip(*(part.column(c).cast(pa.binary()).to_pylist() for c in ("lang", "source", "text"))):
                words = terms(text)
                if words:
                    block = counts.setdefault((lang, source), Counter())
                    held -= len(block)
                    block.update(words)
                    held += len(block)
                    docs.setdefault((lang, source), Counter()).update(set(words))
            if held >= BLOCK_POSTINGS:
                yield from run()
                held = 0
    yield from run()


def _heads(rows: pa.Table) -> np.ndarray:
    """Where a term or language begins in rows sorted by both."""
    term, lang = (rows.column(c).combine_chunks() for c in ("term", "lang"))
    if not len(rows):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], pc.or_(pc.not_equal(term[1:], term[:-1]), pc.not_equal(lang[1:], lang[:-1])).to_numpy(zero_copy_only=False))))


def _listed(flat: pa.Table) -> pa.Table:
    """Sorted postings as a row per term and language."""
    head = _heads(flat)
    ends = pa.array(np.append(head, len(flat)).astype(np.int32))
    keys = [flat.column(c).combine_chunks().take(pa.array(head)).cast(pa.string()) for c in ("term", "lang")]
    values = [flat.column(c).combine_chunks().cast(FLAT.field(c).type) for c in POSTINGS]
    return pa.Table.from_arrays(keys + [pa.ListArray.from_arrays(ends, v) for v in values], names=FLAT.names)


def _flat(batch: pa.RecordBatch) -> pa.Table:
    parents = pc.list_parent_indices(batch.column("n"))
    columns = [batch.column(c).take(parents) for c in ("term", "lang")] + [pc.list_flatten(batch.column(c)) for c in POSTINGS]
    return pa.Table.from_arrays(columns, schema=FLAT)


def merge_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one shard, merged into the order of term and language, to the frequencies of the kept terms."""
    held = FLAT.empty_table()
    for batch in batches:
        if len(batch):
            table = pa.concat_tables([held, _flat(batch)])
            # The rows of the last term stay, as more may follow; its partial sums take their place.
            start = last_term(table)
            yield from kept_terms(table.slice(0, start))
            held = _summed(table.slice(start))
    yield from kept_terms(held)


def last_term(rows: pa.Table) -> int:
    """Where the last term of sorted rows begins."""
    lang, term = (rows.column(c)[-1] for c in ("lang", "term"))
    return pc.index(pc.and_(pc.equal(rows.column("term"), term), pc.equal(rows.column("lang"), lang)), True).as_py()


def _summed(rows: pa.Table) -> pa.Table:
    sums = rows.group_by(["term", "lang", "source"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.select(["term", "lang", "source", "n_sum", "docs_sum"]).rename_columns(FLAT.names).cast(FLAT)


def kept_terms(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Frequencies of the terms in documents enough; rows of one term and language stand together."""
    if not len(rows):
        return
    head = _heads(rows)
    size = np.diff(np.append(head, len(rows)))
    enough = np.add.reduceat(rows.column("docs").to_numpy(), head) >= LEAST_DOCS
    sums = _summed(rows.filter(pa.array(np.repeat(enough, size))))
    if len(sums):
        totals = sums.group_by(["term", "lang"], use_threads=False).aggregate([("n", "sum")])
        found = sums.join(totals, ["term", "lang"], join_type="inner", use_threads=False)
        yield from found.select(["lang", "term", "source", "n", "n_sum"]).rename_columns(["lang", "term", "source", "n", "in_lang"]).combine_chunks().to_batches()


def frequencies(docs: DataFrame) -> DataFrame:
    """``lang, term, source, n, in_lang`` of the terms in ten documents of their language or more.

    Tasks index their texts in blocks of bounded memory; what is shuffled are the blocks' sorted runs, a row of
    postings per term, language and block. The shuffle brings the runs of a hash shard of terms together, Spark's
    external sort merges them through its heap, and equal terms are summed as they stream by.
    """
    runs = docs.mapInArrow(spill_runs, RUN_SQL)
    shards = runs.repartition("term", "lang").sortWithinPartitions("term", "lang")
    return shards.mapInArrow(merge_runs, FREQUENCIES)


def probability(count: str, total: str, terms_kept: str) -> Column:
    """``1 + floor(1e9 * (count + 2) / (total + 2 * terms))`` in exact decimals; null where no term is kept."""
    wide = "decimal(20,0)"
    return F.expr(f"1L + (cast({SCALE} as decimal(10,0)) * cast({count} + 2 as {wide})) div nullif(cast({total} + 2 * {terms_kept} as {wide}), cast(0 as {wide}))")


def distance(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q}))")


def pair_corrections(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the terms that two sources share add to the sum of their separate parts, summed per pair as terms stream by.

    Rows ``(lang, term, place, p, p0)`` in order of term; ``place`` numbers the sources of a language. For a term
    with values p and q in both, this is ``f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)``.
    """
    sums: dict[tuple[str, int, int], int] = {}

    def f(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a - b) * (a - b) // (a + b)

    def add(lang: str, place: np.ndarray, p: np.ndarray, p0: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        # Posting j of a term meets the later postings of the term only: pairs in one direction.
        later = np.repeat(start + size, size) - np.arange(len(place)) - 1
        ends = np.cumsum(later)
        first = 0
        while first < len(place):
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + PAIR_ROWS, side="right")))
            n = later[first:last]
            a = np.repeat(np.arange(first, last), n)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            value = f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b]) + f(p0[a], p0[b])
            low, high = np.minimum(place[a], place[b]), np.maximum(place[a], place[b])
            order = np.lexsort((high, low))
            if len(order):
                low, high, value = low[order], high[order], value[order]
                head = np.flatnonzero(np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1]))))
                for s, t, v in zip(low[head].tolist(), high[head].tolist(), np.add.reduceat(value, head).tolist()):
                    sums[lang, s, t] = sums.get((lang, s, t), 0) + v
            first = last

    def work(rows: pa.Table) -> None:
        if not len(rows):
            return
        langs, start = rows.column("lang").combine_chunks(), _heads(rows)
        size = np.diff(np.append(start, len(rows)))
        place, p, p0 = (rows.column(c).to_numpy() for c in ("place", "p", "p0"))
        of_lang = langs.take(pa.array(start)).to_pylist()
        for lang in sorted(set(of_lang)):
            mine = np.array([k for k, other in enumerate(of_lang) if other == lang])
            taken = np.repeat(start[mine] - np.concatenate(([0], np.cumsum(size[mine])[:-1])), size[mine]) + np.arange(size[mine].sum())
            begin = np.concatenate(([0], np.cumsum(size[mine])[:-1]))
            add(lang, place[taken], p[taken], p0[taken], begin, size[mine])

    def emit() -> pa.RecordBatch:
        keys = list(sums)
        columns = [pa.array([k[c] for k in keys], kind) for c, kind in enumerate((pa.string(), pa.int32(), pa.int32()))]
        batch = pa.RecordBatch.from_arrays([*columns, pa.array(list(sums.values()), pa.int64())], names=["lang", "s", "t", "v"])
        sums.clear()
        return batch

    held = None
    for batch in batches:
        table = pa.concat_tables(([] if held is None else [held]) + [pa.Table.from_batches([batch])])
        start = last_term(table)
        work(table.slice(0, start))
        held = table.slice(start)
        if len(sums) >= PAIR_ROWS:
            yield emit()
    if held is not None:
        work(held)
    yield emit()


def audit(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """How every (lang, source) group of ``docs(text, lang, source)`` differs from its language and from the other sources.

    Returns ``lang, source, part, item, value, rank``: part ``pair`` has a row per other source of the language, part
    ``term`` the ten terms that the group has most above its language. Values are exact whole numbers.

    The sum of a pair over all kept terms is made of what it would be if no term were in either source, what each
    source's own terms change (by the distinct counts, few), and what the terms in both change; only the last looks at
    pairs of postings, term by term, and leaves a task summed up per pair. Work follows the postings, not the
    vocabulary times the pairs.

    Null text, lang and source count as ''. Texts may be empty or very long (one alone is held whole). Repeated rows count
    each. Ties rank by the item's UTF-8 bytes. Groups without kept terms have pairs of value 0 or of their empty counts.
    An empty table gives no rows. Other columns are ignored.
    """
    blank = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("lang", "source", "text")])
    found = scratch.write(frequencies(rows))
    named = rows.select("lang", "source").distinct()
    sizes = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = found.groupBy("lang", "term").agg(F.max("in_lang").alias("in_lang")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("in_lang").alias("lang_total"))
    groups = named.join(sizes, ["lang", "source"], "left").join(kept, "lang", "left").select(
        "lang", "source", F.row_number().over(W.partitionBy("lang").orderBy("source")).alias("place"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "terms", "lang_total")])
    groups = scratch.write(groups.withColumn("p0", probability("0L", "total", "terms")))
    postings = found.join(groups, ["lang", "source"]).withColumn("p", probability("n", "total", "terms"))
    ranked = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    own = postings.withColumn("q", probability("in_lang", "lang_total", "terms")).where("p > q")
    own = own.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance("p", "q").alias("value"))
    own = own.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= TOP_TERMS)
    return own.unionByName(_pairs(postings, groups).withColumn("rank", F.row_number().over(ranked)))


def _pairs(postings: DataFrame, groups: DataFrame) -> DataFrame:
    shared = postings.select("lang", "term", "place", "p", "p0").repartition("term", "lang").sortWithinPartitions("term", "lang")
    shared = shared.mapInArrow(pair_corrections, "lang string, s int, t int, v long")
    both = shared.select("lang", "s", "t", "v").unionByName(shared.select("lang", F.col("t").alias("s"), F.col("s").alias("t"), "v"))
    # Counts that repeat within a source are one row with their number.
    counts = postings.groupBy("lang", "place", "p", "p0").agg(F.count(F.lit(1)).alias("times"))
    other = groups.select("lang", F.col("place").alias("t"), F.col("p0").alias("q0"))
    alone = counts.join(other, "lang").where("place <> t")
    alone = alone.select("lang", F.col("place").alias("s"), "t", (F.col("times") * (distance("p", "q0") - distance("p0", "q0"))).alias("v"))
    alone = alone.groupBy("lang", "s", "t").agg(F.sum("v").alias("v"))
    mirrored = alone.select("lang", F.col("t").alias("s"), F.col("s").alias("t"), "v")
    empty = groups.select("lang", F.col("place").alias("s"), "p0", "terms").join(other, "lang").where("s <> t")
    empty = empty.select("lang", "s", "t", F.coalesce(F.col("terms") * distance("p0", "q0"), F.lit(0)).cast("long").alias("v"))
    summed = both.unionByName(alone).unionByName(mirrored).unionByName(empty).groupBy("lang", "s", "t").agg(F.sum("v").alias("value"))
    names = groups.select("lang", F.col("place").alias("s"), "source")
    items = groups.select("lang", F.col("place").alias("t"), F.col("source").alias("item"))
    return summed.join(names, ["lang", "s"]).join(items, ["lang", "t"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
