"""Array expressions that stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it inside ``body``.

    A column used only inside a lambda is inlined there by the optimiser and would be
    computed again for every element; binding it as a lambda variable prevents that.
    """
    return F.transform(F.array(value), body)[0]


def total(px: Column) -> Column:
    return F.aggregate(px, F.lit(0.0), lambda acc, v: acc + v)


def mean(px: Column) -> Column:
    return total(px) / F.size(px)


def spread(px: Column) -> Column:
    """Population standard deviation of an array, by two passes over it."""
    return let(
        mean(px),
        lambda m: F.sqrt(F.aggregate(px, F.lit(0.0), lambda acc, v: acc + (v - m) * (v - m)) / F.size(px)),
    )


def norm(px: Column, order: float | str = 2) -> Column:
    """Vector norm of an array: 0, 1, 2, ``inf``, ``-inf`` or any positive p."""
    order = float(order)
    if order == 0:
        return F.aggregate(px, F.lit(0.0), lambda acc, v: acc + F.when(v != 0, 1.0).otherwise(0.0))
    if order == 1:
        return F.aggregate(px, F.lit(0.0), lambda acc, v: acc + F.abs(v))
    if order == 2:
        return F.sqrt(F.aggregate(px, F.lit(0.0), lambda acc, v: acc + v * v))
    if order == float("inf"):
        return F.array_max(F.transform(px, F.abs))
    if order == float("-inf"):
        return F.array_min(F.transform(px, F.abs))
    return F.pow(F.aggregate(px, F.lit(0.0), lambda acc, v: acc + F.pow(F.abs(v), F.lit(order))), F.lit(1.0 / order))
