"""Exact duplicates: combine locally, then by salted digest, then globally, always on full content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackweave.llm.batches import free_name
from stackweave.session import Scratch

#: Shares into which the rows of one digest are dealt, whatever their number.
SALTS = 64


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256_text(text: Column) -> Column:
    return F.sha2(text, 256)


def dedup(docs: DataFrame, scratch: Scratch, salts: int = SALTS, digest=sha256_text) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: the class of its normalised text and who stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``. ``keep_id`` is the smallest doc_id
    of the class. Texts are grouped by digest *and* content in each of three stages: partial
    aggregation inside the scan's task, merging of the shares of a digest, and combining of the
    shares' winners. A class of any size sends one row per task and at most ``salts`` rows further,
    and the way back goes over (digest, share), so no task gets a whole large class.

    Null texts equal empty ones. Null doc_ids never win against a number; a class of nulls alone
    has a null keep_id and its rows are all kept. Repeated rows count each and are all kept if
    their id wins. Other columns are ignored. ``digest`` may be weak: texts with one digest and
    different content are told apart by content (see tests).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"))
    rows = rows.withColumn("digest", digest(F.col("norm"))).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    shares = rows.groupBy("digest", "salt", "norm").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))
    # Equal digests meet in one task. The shares that a class has are bits of one number: at most 64.
    classes = (
        shares.repartition("digest")
        .groupBy("digest", "norm")
        .agg(F.min("low").alias("keep_id"), F.sum("n").alias("group_size"), F.expr("bit_or(shiftleft(1L, salt))").alias("shares"))
        .withColumn("text_sha256", sha256_text(F.col("norm")))
    )
    winners = scratch.write(classes.drop("norm"))
    clashes = winners.groupBy("digest").count().where("count > 1")
    if clashes.isEmpty():
        found = rows.drop("norm").join(_places(winners, salts), ["digest", "salt"])
    else:
        # Different contents under one digest: then the way back compares the content as well.
        found = rows.join(_places(classes, salts), ["digest", "salt", "norm"])
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def _places(classes: DataFrame, salts: int) -> DataFrame:
    """One row per class and share of it."""
    present = F.expr(f"filter(sequence(0, {salts - 1}), s -> shiftright(shares, s) & 1L = 1L)")
    return classes.withColumn("salt", F.explode(present)).drop("shares")


def keep_first(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` that stay, one per class of equal texts, with all their columns.

    Of rows that repeat the id that stays, one stays. Rows without doc_id stay only for texts that no row
    with an id has, one per text.
    """
    decided = dedup(docs, scratch).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_same")).distinct()
    sha = free_name(docs, "_sha")
    marked = docs.withColumn(sha, sha256_text(normalised(F.col("text"))))
    same = marked["doc_id"].cast("long").eqNullSafe(decided["_id"]) & (marked[sha] == decided["_same"])
    return marked.join(decided, same, "left_semi").dropDuplicates(["doc_id", sha]).drop(sha)
