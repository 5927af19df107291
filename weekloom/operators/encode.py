"""Dense integer codes for series keys, in key order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.sources.staging import stage


def encode_keys(
    df: DataFrame, keys: Sequence[str] = ("state",), into: str = "state_encoded"
) -> DataFrame:
    """(keys, code): codes 0..n-1 by sorted key, learnt without a driver-side label list.

    The distinct keys are range-sorted and stored with their (partition, position);
    a code is the position plus the sizes of the partitions before it. The only
    ordered window is over those sizes: one row per sort partition, which is also all
    that is broadcast.
    """
    keys = list(keys)
    ordered = (
        df.select(*keys)
        .dropna(subset=keys)
        .distinct()
        .orderBy(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    placed = stage(ordered, "keys").select(
        *keys,
        F.shiftright("_id", 33).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    coded = placed.join(F.broadcast(offsets), "_part")
    return coded.select(*keys, (F.col("_offset") + F.col("_pos")).cast("int").alias(into))
