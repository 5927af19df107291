"""Input guards: each is one aggregate, available as a row and as a check that raises."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from weekloom.operators.panel import gap_check
from weekloom.operators.split import missing_series
from weekloom.spec import DEFAULT, PanelSpec

log = logging.getLogger(__name__)


class ValidationError(Exception):
    """The data break an assumption the rest of the work depends on."""


def require_columns(df: DataFrame, spec: PanelSpec = DEFAULT) -> None:
    missing = sorted(set(spec.columns) - set(df.columns))
    if missing:
        raise ValidationError(f"Missing required columns: {missing} (given: {df.columns})")


def _hold(row, *broken: tuple[bool, str]):
    """The row, unless one of its conditions is broken: then all complaints in one error."""
    said = [text for bad, text in broken if bad]
    if said:
        raise ValidationError("; ".join(said))
    return row


def raw_report(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Rows, known targets and series of raw records: one row."""
    require_columns(df, spec)
    per_key = df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(spec.target).alias("_known")
    )
    known_key = F.lit(True)
    for key in spec.keys:
        known_key = known_key & F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("_known"), F.lit(0)).alias("known_sales"),
        F.count_if(known_key).alias("series"),
    )


def check_raw(found: dict) -> dict:
    """The counts of records that can be worked with; others raise."""
    total, series = found.get("total_rows") or 0, found.get("series") or 0
    return _hold(
        found,
        (total == 0, "the table of records is empty"),
        (total > 0 and not found["known_sales"], "sales are entirely null"),
        (total > 0 and series < 2, f"a panel takes multiple series, {series} given"),
    )


def validate_raw(df: DataFrame, spec: PanelSpec = DEFAULT) -> Row:
    """The report row of records that can be worked with."""
    row = raw_report(df, spec).first()
    check_raw(row.asDict())
    return row


def observe_raw(df: DataFrame, seen: Observation, spec: PanelSpec = DEFAULT) -> DataFrame:
    """``df``, whose next write tells ``seen`` what ``check_raw`` asks for.

    Two different keys are enough to know of several series: 2 stands for two or more.
    """
    known = F.lit(True)
    for key in spec.keys:
        known = known & F.col(key).isNotNull()
    key = F.when(known, F.struct(*spec.keys))
    lo, hi = F.min(key), F.max(key)
    return df.observe(
        seen,
        F.count(F.lit(1)).alias("total_rows"),
        F.count(spec.target).alias("known_sales"),
        F.when(lo.isNull(), 0).when(lo == hi, 1).otherwise(2).alias("series"),
    )


def panel_report(panel: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Nulls, negatives and series with non-weekly gaps: one row, all series checked."""
    broken = gap_check(panel, spec).agg(F.count(F.lit(1))).scalar()
    target = F.col(spec.target)
    counts = panel.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(target.isNull()).alias("null_sales"),
        F.count_if(target < 0).alias("negative_sales"),
    )
    return counts.withColumn("gap_series", broken)


def check_panel(found: dict) -> dict:
    """The counts of a complete weekly panel; negative values are only logged."""
    nulls, gaps = found.get("null_sales") or 0, found.get("gap_series") or 0
    if found.get("negative_sales"):
        log.warning("panel holds %d values below zero", found["negative_sales"])
    return _hold(
        found,
        (nulls > 0, f"{nulls} null values are left in the panel"),
        (gaps > 0, f"{gaps} series have non-weekly gaps"),
    )


def validate_panel(panel: DataFrame, spec: PanelSpec = DEFAULT) -> Row:
    """The report row of a complete weekly panel."""
    row = panel_report(panel, spec).first()
    check_panel(row.asDict())
    return row


def observe_panel(panel: DataFrame, seen: Observation, spec: PanelSpec = DEFAULT) -> DataFrame:
    """``panel``, whose next write tells ``seen`` what ``check_panel`` asks for.

    A step that is no week is counted once, so ``gap_series`` may exceed the number of
    series; zero means the same. The window is the imputation's own: no exchange is added.
    """
    step = F.date_diff(spec.time, F.lag(spec.time).over(spec.series()))
    target = F.col(spec.target)
    return (
        panel.withColumn("_step", step)
        .observe(
            seen,
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(target.isNull()).alias("null_sales"),
            F.count_if(target < 0).alias("negative_sales"),
            F.count_if(F.col("_step") != 7).alias("gap_series"),
        )
        .select(*panel.columns)
    )


def split_report(
    train: DataFrame, val: DataFrame, test: DataFrame | None = None, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """Sizes, boundary dates and series of train absent from val: one row."""
    lost = missing_series(train, val, spec).agg(F.count(F.lit(1))).scalar()
    labelled = train.select(spec.time, F.lit("train").alias("split")).unionByName(
        val.select(spec.time, F.lit("val").alias("split"))
    )
    if test is not None:
        labelled = labelled.unionByName(test.select(spec.time, F.lit("test").alias("split")))
    day = F.col(spec.time)
    counts = labelled.agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "val").alias("val_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
        F.max(F.when(F.col("split") == "train", day)).alias("train_last"),
        F.min(F.when(F.col("split") == "val", day)).alias("val_first"),
    )
    return counts.withColumn("missing_series", lost)


def validate_splits(
    train: DataFrame, val: DataFrame, test: DataFrame | None = None, spec: PanelSpec = DEFAULT
) -> Row:
    """The report row of splits in order; series that val lacks are only logged."""
    row = split_report(train, val, test, spec).first()
    if row.missing_series:
        log.warning("val lacks %d series of train", row.missing_series)
    both = row.train_rows > 0 and row.val_rows > 0
    return _hold(
        row,
        (row.train_rows == 0, "the train split is empty"),
        (row.val_rows == 0, "the val split is empty"),
        (
            both and row.train_last >= row.val_first,
            f"splits overlap: train reaches {row.train_last}, val begins {row.val_first}",
        ),
    )


def absent(failure: AnalysisException) -> bool:
    """Does the failure say that there is no such path (rather than a damaged table)?"""
    return "PATH_NOT_FOUND" in str(failure.getCondition())


def missing_tables(df_paths: dict[str, str], spark: SparkSession) -> list[str]:
    """Names of stored tables that are absent; a damaged one raises."""
    missing = []
    for name, path in df_paths.items():
        try:
            spark.read.parquet(path)
        except AnalysisException as failure:
            if not absent(failure):
                raise
            missing.append(name)
    return sorted(missing)


def require_tables(df_paths: dict[str, str], spark: SparkSession) -> None:
    """Raise with the full list when stored tables that lookups need are absent."""
    missing = missing_tables(df_paths, spark)
    if missing:
        raise ValidationError(f"Missing tables: {missing}")
