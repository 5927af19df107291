"""Sliding windows of feature rows, each with the next row's target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.operators.features import SEQUENCE_FEATURES, complete_cases
from weekloom.operators.scale import scale_features, scale_target
from weekloom.spec import DEFAULT, SEQUENCE_LENGTH, PanelSpec


def sequence_windows(
    df: DataFrame,
    target_stats: DataFrame,
    feature_stats: DataFrame,
    columns: list[str] | None = None,
    length: int = SEQUENCE_LENGTH,
    spec: PanelSpec = DEFAULT,
    within: tuple[str, ...] = (),
) -> DataFrame:
    """(keys, time, target_scaled, seq): the ``length`` complete rows before each row.

    Only full windows are kept. ``within`` names further columns (such as the split)
    that a window may not cross. The rows are picked by offset, which costs one
    reference each, instead of being collected anew for every frame.
    """
    columns = list(SEQUENCE_FEATURES if columns is None else columns)
    usable = scale_target(complete_cases(df, columns), target_stats, spec)
    usable = scale_features(usable, feature_stats, columns)
    inner = spec
    for name in within:
        inner = inner.with_key(name)
    vector = F.array(*[F.col(c).cast("float") for c in columns])
    before = [F.lag("_vector", k).over(inner.series()) for k in range(length, 0, -1)]
    return (
        usable.withColumn("_vector", vector)
        .withColumns({"_full": before[0].isNotNull(), "seq": F.array(*before)})
        .filter("_full")
        .select(
            *inner.keys,
            spec.time,
            spec.target,
            F.col("target_scaled").cast("float").alias("target_scaled"),
            "seq",
        )
    )
