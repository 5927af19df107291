"""Statistics over the tail of a bounded history array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_end(hist: Column, k: int) -> Column:
    return F.element_at(hist, -k)


def tail_mean(hist: Column, width: int) -> Column:
    total = F.aggregate(F.slice(hist, -width, width), F.lit(0.0), lambda acc, x: acc + x)
    return total / F.lit(float(width))


def tail_std(hist: Column, width: int) -> Column:
    """Sample standard deviation of the last ``width`` values, in one pass.

    Deviations are taken from the last value, which keeps the sums small enough for
    the subtraction of squares to be exact to rounding.
    """
    anchor = from_end(hist, 1)
    sums = F.aggregate(
        F.slice(hist, -width, width),
        F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("dd")),
        lambda acc, x: F.struct(
            (acc["d"] + (x - anchor)).alias("d"),
            (acc["dd"] + (x - anchor) * (x - anchor)).alias("dd"),
        ),
        lambda acc: (acc["dd"] - acc["d"] * acc["d"] / F.lit(float(width)))
        / F.lit(float(width - 1)),
    )
    return F.sqrt(F.greatest(sums, F.lit(0.0)))


def push(hist: Column, value: Column, width: int) -> Column:
    """Append a value to a full history and keep the last ``width``."""
    return F.concat(F.slice(hist, -(width - 1), width - 1), F.array(value))


def dot(values: Column, weights: list[float]) -> Column:
    """Inner product of an array column with fixed weights."""
    fixed = F.array(*[F.lit(float(w)) for w in weights])
    products = F.zip_with(values, fixed, lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
