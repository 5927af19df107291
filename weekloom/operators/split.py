"""Splits by date: never shuffled, the same boundaries for every series."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.spec import DEFAULT, PanelSpec

SPLITS = ("train", "val", "test")


def _day(value: str | date) -> Column:
    return F.lit(str(value)).cast("date")


def with_split(
    df: DataFrame, val_start: str, test_start: str, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """Label each row train, val or test; rows without a date are in no split."""
    day = F.col(spec.time)
    label = (
        F.when(day < _day(val_start), "train")
        .when((day >= _day(val_start)) & (day < _day(test_start)), "val")
        .when(day >= _day(test_start), "test")
    )
    return df.withColumn("split", label).filter(F.col("split").isNotNull())


def temporal_split(
    df: DataFrame, val_start: str, test_start: str, spec: PanelSpec = DEFAULT
) -> dict[str, DataFrame]:
    """The three splits as plain date filters, which reach a Parquet scan."""
    day = F.col(spec.time)
    return {
        "train": df.filter(day < _day(val_start)),
        "val": df.filter((day >= _day(val_start)) & (day < _day(test_start))),
        "test": df.filter(day >= _day(test_start)),
    }


def saturdays_between(first: str, end: str) -> int:
    """Week-ending Saturdays in [first, end): the horizon of a validation range."""
    a, b = date.fromisoformat(first), date.fromisoformat(end)

    def index(d: date) -> int:
        saturday = d + timedelta(days=(5 - d.weekday()) % 7)
        return saturday.toordinal() // 7

    return index(b) - index(a)


def split_summary(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Rows, series, weeks and range per split, from a table with a ``split`` column.

    Distinct counts are taken in two steps (per series, per week) so that no task ever
    holds all rows of a split.
    """
    per_key = df.groupBy("split", *spec.keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min(spec.time).alias("_lo"),
        F.max(spec.time).alias("_hi"),
    )
    sizes = per_key.groupBy("split").agg(
        F.sum("_rows").alias("total_rows"),
        F.count(F.lit(1)).alias("series"),
        F.min("_lo").alias("first_date"),
        F.max("_hi").alias("last_date"),
    )
    weeks = df.groupBy("split", spec.time).agg(F.lit(1).alias("_one"))
    weeks = weeks.groupBy("split").agg(F.count("_one").alias("weeks"))
    return sizes.join(weeks, "split").select(
        "split", "total_rows", "series", "weeks", "first_date", "last_date"
    )


def missing_series(train: DataFrame, val: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Series seen in train but not in val; both sides are reduced to keys first."""
    keys = list(spec.keys)
    present = val.select(*keys).distinct()
    return train.select(*keys).distinct().join(present, keys, "left_anti")


def one_series(df: DataFrame, spec: PanelSpec = DEFAULT, **key: str) -> DataFrame:
    """The (date, target) rows of one series in date order; the key filter is pushed down."""
    picked = df
    for name, value in key.items():
        picked = picked.filter(F.col(name) == value)
    return picked.select(spec.time, spec.target).orderBy(spec.time)


def as_ds_y(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    return df.select(F.col(spec.time).alias("ds"), F.col(spec.target).alias("y"))


def history_tail(df: DataFrame, rows: int = 52, spec: PanelSpec = DEFAULT) -> DataFrame:
    """The last ``rows`` rows of every series.

    ``lead`` finds them in the order the other features already sort by.
    """
    beyond = F.lead(spec.time, rows).over(spec.series())
    return df.withColumn("_beyond", beyond).filter("_beyond is null").drop("_beyond")
