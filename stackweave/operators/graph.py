"""Connected groups of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave.session import Scratch


def connected_groups(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """The lowest id of every vertex's group: ``(id, grp)`` for all vertices of ``edges(a, b)``.

    Rounds of contraction: every vertex moves to its lowest neighbour, and on to that one's,
    and edges inside a contracted vertex vanish. Only vertices without a lower neighbour remain, and no
    two of them are neighbours; a star with its highest vertex in the centre takes one round to turn over and one
    to vanish. Each round is written out, and the labels with every second one.
    """
    # Both directions of an edge come from one row, so the edges are computed once.
    ends = F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    live = scratch.write(edges.select(F.inline(ends)).distinct())
    labels = live.select(F.col("a").alias("id"), F.col("a").alias("grp")).distinct()
    rounds = 0
    while not live.isEmpty():
        # A partial minimum comes before the shuffle: many neighbours of one vertex are cheap.
        up = live.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up"))
        top = up.select(F.col("a").alias("up"), F.col("up").alias("to"))
        moves = scratch.write(up.join(top, "up").select(F.col("a").alias("from"), "to"))
        # Labels follow the written moves once at the end; the rounds only need the edges.
        relabelled = labels.join(moves, labels["grp"] == moves["from"], "left")
        labels = relabelled.select("id", F.coalesce("to", "grp").alias("grp"))
        moved_a = live.join(moves, live["a"] == moves["from"]).select(F.col("to").alias("a"), "b")
        moved_b = moved_a.join(moves, moved_a["b"] == moves["from"]).select("a", F.col("to").alias("b"))
        live = scratch.write(moved_b.where("a <> b").distinct())
        rounds += 1
        if rounds % 2 == 0:
            labels = scratch.write(labels)
    return scratch.write(labels)
