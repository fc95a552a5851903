"""Seeded, repeatable shuffling and sampling of frames.

Frames are ordered by the md5 of their number and the seed. Positions come from per-bucket
row numbers plus bucket offsets, so no task sorts the whole time axis, and no frame is sorted at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Frames of one bucket of the random order, about.
BUCKET_FRAMES = 65_536


def random_key(seed: int, t: str = "t") -> Column:
    return F.md5(F.concat_ws(":", F.col(t).cast("string"), F.lit(str(seed))))


def random_positions(stack: DataFrame, seed: int = 0) -> DataFrame:
    """Place of every frame in random order: ``(t, pos)``, from the numbers alone.

    Frames fall into buckets by the first digits of their key, as many digits as the number of frames asks
    for. Bucket counts, a running sum over them and row numbers inside the buckets make the place.
    """
    numbers = stack.select("t").withColumn("_key", random_key(seed))
    # Each hexadecimal digit splits 16 ways.
    total = stack.agg(F.count(F.lit(1)).alias("n")).scalar()
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.greatest(total, F.lit(1)) / F.lit(BUCKET_FRAMES)))).cast("int")
    placed = numbers.withColumn("_d", digits).withColumn("_b", F.expr("substring(_key, 1, _d)"))
    counts = placed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_key", "t"))
    return placed.withColumn("_rank", rank).join(offsets, "_b").select("t", (F.col("_off") + F.col("_rank") - 1).cast("long").alias("pos"))


def shuffle_frames(stack: DataFrame, seed: int = 0) -> DataFrame:
    """The same frames in random order: ``t`` becomes the new position, ``t_from`` the old one.

    Only frame numbers are sorted; frames meet their place in one join on the number.
    """
    moved = stack.join(random_positions(stack, seed), "t").withColumnRenamed("t", "t_from").withColumnRenamed("pos", "t")
    return moved.select("t", "t_from", *[c for c in stack.columns if c != "t"])


def sample_positions(stack: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """``k`` distinct frame numbers at random as ``(pos, t)``; all of them when fewer exist."""
    chosen = stack.select("t", random_key(seed).alias("_key")).orderBy("_key", "t").limit(k)
    # k is the sample size asked for, so this window holds k rows and no more.
    return chosen.select((F.row_number().over(Window.orderBy("_key", "t")) - 1).alias("pos"), "t")


def sample_frames(frames: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """``k`` random frames without replacement: ``(pos, t, h, w, px)``."""
    return frames.join(sample_positions(frames, k, seed), "t")


def sample_per_block(stack: DataFrame, block_t: int, k: int, seed: int = 0) -> DataFrame:
    """Up to ``k`` random frames of every time block: ``(tb, pos, t)``.

    The choice depends on the time block only, so all tiles of a block use the same frames.
    A window holds one block of frame numbers.
    """
    keyed = stack.select("t", F.expr(f"cast(floor(t / {block_t}) as long)").alias("tb"), random_key(seed).alias("_key"))
    rank = F.row_number().over(Window.partitionBy("tb").orderBy("_key", "t"))
    return keyed.withColumn("pos", rank - 1).where(F.col("pos") < k).select("tb", "pos", "t")
