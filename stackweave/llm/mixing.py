"""Mixing sources to target weights: whole epochs first, then Efraimidis-Spirakis selection to the budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stackweave.llm.batches import free_name
from stackweave.session import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: A source is taken at most so many times over.
MOST_EPOCHS = 3
#: Rows of one source that are put in order together, on average.
BIN_ROWS = 2048


def word_count(text: Column) -> Column:
    """Words of a text; null has none. One more than the inner gaps of the trimmed text."""
    spaced = F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    gaps = F.regexp_count(spaced, F.lit(" +"))
    return F.coalesce(F.when(spaced == "", 0).otherwise(gaps + 1), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """Quality weight of a document, 0.25 to 1: the share of ASCII letters and blanks in its characters."""
    other = F.length(F.regexp_replace(text, "[A-Za-z ]+", ""))
    return F.coalesce(F.lit(1.0) - F.lit(0.75) * F.try_divide(other, F.length(text)), F.lit(0.25))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``sources(source, source_size)`` with the ``target`` of each.

    Sources in code point order, null last, get the weights in turn. Every target is
    ``least(most * source_size, level * weight)``: with sources sorted by how soon they are full,
    the level after the first k are full follows from two running sums, and the first k whose next
    source is not overfull holds. The windows are over one row per source.
    """
    first = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(first) - 1) % len(weights) + 1)
    fullness = W.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fullness.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(0))
    return (
        sources.withColumn("weight", turn)
        .withColumn("full", F.col("source_size") * F.lit(float(most)))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("place", F.row_number().over(fullness))
        .withColumn("holds", F.when(F.col("left") * F.col("weight") <= F.col("full") * F.col("rest"), F.struct("place", F.col("left") / F.col("rest"))))
        .withColumn("level", F.min("holds").over(everything)["col2"])
        .withColumn("target", F.coalesce(F.least("full", F.col("level") * F.col("weight")), F.col("full")))
        .select("source", "source_size", "target")
    )


def sampling_key(seed: int, *ident: str) -> Column:
    """An exponential draw fixed by the row's identity: -ln(u), u from md5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ident])
    u = (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return -F.log(u)


def mix(docs: DataFrame, scratch: Scratch, weight: Column | None = None, seed: int = 9) -> DataFrame:
    """What the mix takes of every row of ``docs(doc_id, text, source)``.

    Returns ``doc_id, source, size, source_size, target, epochs, part``: ``epochs`` whole copies of
    the document and, of one more copy, ``part`` words. A source gives ``target`` words, at most three
    times its size: its whole epochs, then documents in order of exponential key over quality weight
    until the rest of the target is full. The document at the edge gives its first ``part`` words, so
    each source's words differ from its target by less than one.

    Rows of a source are binned by key; the bins' sizes are summed up first, so only the bin in
    which the budget runs out is put in order. The number of bins follows from the number of rows of
    the source. Null texts and ids are rows like others, of size 0 and with the key of an empty id;
    equal keys are ordered by doc_id and size, and rows equal in those are interchangeable.
    Keys depend on seed, doc_id and source alone, so reruns and lost tasks draw the same.
    """
    quality = letter_share(F.col("text")) if weight is None else weight
    key = sampling_key(seed, "doc_id", "source") / F.greatest(quality, F.lit(1e-6))
    rows = scratch.write(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), key.alias("key")))
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    bins = F.greatest(F.lit(1), F.ceil(F.col("rows") / F.lit(BIN_ROWS))).cast("long").alias("bins")
    goals = targets(by_source.select("source", "source_size")).withColumnRenamed("source", "s").join(
        by_source.select(F.col("source").alias("s2"), bins), F.col("s").eqNullSafe(F.col("s2"))).drop("s2")
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    goals = goals.withColumn("epochs", epochs)
    goals = goals.withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    goals = scratch.write(goals)
    # 1 - exp(-key) spreads the keys over 0..1 in their order.
    spread = F.least(F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * F.col("bins")), F.col("bins") - 1)
    binned = rows.join(goals, F.col("source").eqNullSafe(F.col("s"))).withColumn("bin", spread).drop("s")
    sums = binned.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    running = W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("bin").alias("b"), "bin_size", F.coalesce(F.sum("bin_size").over(running), F.lit(0)).alias("start"))
    placed = binned.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))).drop("s", "b")
    edge = (F.col("start") < F.col("rest")) & (F.col("start") + F.col("bin_size") > F.col("rest"))
    inside = W.partitionBy("source", "bin").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    whole = placed.where(~edge).withColumn("part", F.when(F.col("start") < F.col("rest"), F.col("size")).otherwise(F.lit(0)))
    room = F.col("rest") - F.col("start") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    cut = placed.where(edge).withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), room)))
    return whole.unionByName(cut).select("doc_id", "source", "size", "source_size", "target", "epochs", F.col("part").cast("long").alias("part"))


def mixed(docs: DataFrame, scratch: Scratch, seed: int = 9) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns.

    Documents stay whole: of the one at a source's edge, a further copy comes if half of it or more was
    taken. Rows that repeat a doc_id and source share what the mix takes of them by their size and key.
    """
    taken = mix(docs, scratch, seed=seed)
    copies = F.col("epochs") + F.when((F.col("part") > 0) & (2 * F.col("part") >= F.col("size")), 1).otherwise(0)
    # Rows alike in id, source and size get the same number of copies each, as near to the mix as whole numbers go.
    per_row = taken.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size")).agg(
        F.round(F.sum(copies) / F.count(F.lit(1))).cast("int").alias("_copies"))
    wanted = per_row.where("_copies > 0")
    words = free_name(docs, "_words")
    sized = docs.withColumn(words, word_count(F.col("text")))
    same = sized["doc_id"].cast("long").eqNullSafe(wanted["_id"]) & sized["source"].eqNullSafe(wanted["_source"]) & (sized[words] == wanted["_size"])
    found = sized.join(wanted, same).select(*[sized[c] for c in docs.columns], wanted["_copies"])
    repeated = F.explode(F.sequence(F.lit(1), found["_copies"])).alias(free_name(docs, "_copy"))
    return found.select(*[found[c] for c in docs.columns], repeated).select(*docs.columns)
