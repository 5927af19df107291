"""Connected components by alternating star contractions, every round in shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.sources.staging import stage


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): every node of ``edges(a, b)`` with the smallest node it reaches.

    Each round links a node's larger neighbours, then its smaller ones, to the smallest
    node in its neighbourhood; the number of rounds grows with the logarithm of a
    component's length. Neighbourhood minima are partial aggregates joined back, so a
    node with very many links never has them in one group.
    """
    now = stage(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct(), "links")
    seen = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = large.filter("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        after = joined.select("a", F.col("m").alias("b")).unionByName(
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        now = stage(after.filter("a <> b").distinct(), "links")
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    ends = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(ends)
