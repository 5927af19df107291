"""Min-max scaling learnt on the training rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.operators.features import complete_cases
from weekloom.spec import DEFAULT, PanelSpec


def fit_target(train: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Per-series target minimum and maximum."""
    return train.groupBy(*spec.keys).agg(
        F.min(spec.target).alias("lo"), F.max(spec.target).alias("hi")
    )


def fit_features(train: DataFrame, columns: list[str]) -> DataFrame:
    """Global minimum and maximum of every feature over complete rows: one row."""
    stats = []
    for c in columns:
        value = F.col(c).cast("double")
        stats.append(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias(c))
    return complete_cases(train, columns).agg(*stats)


def feature_ranges(fitted: DataFrame) -> DataFrame:
    """The fitted feature ranges as rows (feature, lo, hi)."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"{c}.lo").alias("lo"), F.col(f"{c}.hi").alias("hi"))
            for c in fitted.columns
        ]
    )
    return fitted.select(F.inline(pairs))


def scaled(value: Column, lo: Column, hi: Column) -> Column:
    return F.when(hi == lo, value * 0.0).otherwise((value - lo) / F.nullif(hi - lo, F.lit(0.0)))


def unscaled(value: Column, lo: Column, hi: Column) -> Column:
    return value * (hi - lo) + lo


def scale_target(
    df: DataFrame, stats: DataFrame, spec: PanelSpec = DEFAULT, into: str = "target_scaled"
) -> DataFrame:
    """Scale by the series' own range; a constant series scales to 0.

    The statistics have one row per series and grow with the data, so this is a plain
    equi-join on the key and Spark broadcasts them only when they measure small.
    """
    joined = df.join(stats, list(spec.keys))
    value = scaled(F.col(spec.target), F.col("lo"), F.col("hi"))
    return joined.select(*df.columns, value.alias(into))


def unscale_target(
    df: DataFrame, stats: DataFrame, column: str, into: str, spec: PanelSpec = DEFAULT
) -> DataFrame:
    joined = df.join(stats, list(spec.keys))
    value = unscaled(F.col(column), F.col("lo"), F.col("hi"))
    return joined.select(*df.columns, value.alias(into))


def scale_features(df: DataFrame, fitted: DataFrame, columns: list[str]) -> DataFrame:
    """Scale features by the global ranges; a constant feature scales to 0.

    The single row of ranges enters as a scalar subquery.
    """
    ranges = fitted.select(F.struct(*columns).alias("ranges")).scalar()
    out = df.withColumn("_ranges", ranges)
    values = {}
    for c in columns:
        lo, hi = F.col(f"_ranges.{c}.lo"), F.col(f"_ranges.{c}.hi")
        width = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
        values[c] = (F.col(c) - lo) / width
    return out.withColumns(values).drop("_ranges")
