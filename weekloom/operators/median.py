"""Exact medians of groups that may each hold a third of the table.

The built-in ``median`` keeps every value of a group in one task. Here a mergeable
sketch first brackets the middle of each group; values outside the bracket collapse
to one counted row per side before the shuffle, and only the bracket (well under one
percent of a large group) is ordered. The result is exact: if a bracket ever missed
the middle rank the job would fail rather than answer wrongly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 20000
MARGIN = 0.002


def exact_medians(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """``by`` plus ``median_<column>`` for every column; NULL and NaN are skipped.

    The sketch has one row per combination of ``by`` and column and carries no hint: a
    small one is broadcast by its measured size. ``df`` is read twice, so give it a
    stored table when it is expensive. Infinite values are values like any other.
    """
    long = df.unpivot(by, [F.col(c).cast("double").alias(c) for c in columns], "_column", "_value")
    long = long.filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
    group = [*by, "_column"]

    sketch = long.groupBy(*group).agg(
        F.percentile_approx(
            "_value", F.array(F.lit(0.5 - MARGIN), F.lit(0.5 + MARGIN)), F.lit(SKETCH_ACCURACY)
        ).alias("_bracket")
    )
    value, lo, hi = F.col("_value"), F.col("_bracket")[0], F.col("_bracket")[1]
    side = F.when(value < lo, -1).when(value > hi, 1).otherwise(0)
    counted = (
        long.join(sketch, group)
        .withColumn("_side", side)
        .groupBy(*group, "_side", F.when(F.col("_side") == 0, value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ordered = Window.partitionBy(*group).orderBy("_side", "_value")
    upto = F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("_n").over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    ranked = counted.withColumns({"_upto": upto, "_total": total})

    def at(rank) -> Column:
        holds = (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)
        return F.max(F.when(holds & (F.col("_side") == 0), F.col("_value")))

    lower = at(F.floor((F.col("_total") + 1) / 2))
    upper = at(F.floor(F.col("_total") / 2) + 1)
    middle = F.when(lower == upper, lower).otherwise((lower + upper) / 2)
    outside = lower.isNull() | upper.isNull()
    safe = F.when(outside, F.raise_error(F.lit("median bracket missed")).cast("double")).otherwise(
        middle
    )
    medians = ranked.groupBy(*group).agg(safe.alias("_median"))
    return medians.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("_column") == c, F.col("_median"))).alias(f"median_{c}")
            for c in columns
        ]
    )
