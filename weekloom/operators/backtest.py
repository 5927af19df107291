"""Walk-forward evaluation over folds that step back from the end of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.operators.median import exact_medians
from weekloom.spec import BACKTEST_FOLDS, BACKTEST_WEEKS, DEFAULT, SEASON, PanelSpec


def backtest_folds(
    panel: DataFrame,
    folds: int = BACKTEST_FOLDS,
    weeks: int = BACKTEST_WEEKS,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """(fold, train_end, val_start, val_end), numbered in time order.

    Folds stop where less than a season of weeks precedes them: ``train_end`` must lie
    after the 53rd distinct week. Works on the distinct weeks, never on whole series.
    """
    weeks_seen = panel.select(spec.time).distinct()
    last = weeks_seen.agg(F.max(spec.time)).scalar()
    early = weeks_seen.orderBy(spec.time).limit(SEASON + 1)
    warm = early.agg(F.when(F.count(F.lit(1)) > SEASON, F.max(spec.time))).scalar()

    i = F.col("_back")
    val_end = F.date_sub(F.col("_last"), (i * weeks * 7).cast("int"))
    val_start = F.date_sub(F.col("_last"), ((i + 1) * weeks * 7).cast("int"))
    rows = panel.sparkSession.range(folds).select(
        F.col("id").alias("_back"), last.alias("_last"), warm.alias("_warm")
    )
    kept = rows.select(
        "_back", val_start.alias("val_start"), val_end.alias("val_end"), "_warm"
    ).filter(F.col("val_start") > F.col("_warm"))
    # Folds step back from the end, so the kept ones are 0..n-1: number them from the oldest.
    n = kept.agg(F.max("_back")).scalar()
    return kept.select(
        (n - F.col("_back") + 1).cast("int").alias("fold"),
        F.col("val_start").alias("train_end"),
        "val_start",
        "val_end",
    )


def fold_array(folds: DataFrame) -> Column:
    """The few fold rows as one array value, usable in any row expression."""
    row = F.struct("fold", "train_end", "val_start", "val_end")
    return folds.agg(F.array_sort(F.collect_list(row)).alias("folds")).scalar()


def fold_rows(panel: DataFrame, folds: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Every row once per fold it belongs to, labelled train or val.

    The fold list is a scalar, so this is a projection: no range join.
    """
    day = F.col(spec.time)
    mine = F.filter(F.col("_folds"), lambda f: day < f["val_end"])
    return (
        panel.withColumn("_folds", fold_array(folds))
        .withColumn("_fold", F.explode(mine))
        .select(
            F.col("_fold.fold").alias("fold"),
            *panel.columns,
            F.when(day < F.col("_fold.train_end"), "train").otherwise("val").alias("split"),
        )
    )


def backtest_by_fold(metrics: DataFrame) -> DataFrame:
    return exact_medians(metrics, ["model", "fold"], ["smape"])


def backtest_summary(metrics: DataFrame) -> DataFrame:
    """Median, mean and deviation of sMAPE per model over all folds."""
    spread = metrics.groupBy("model").agg(
        F.avg("smape").alias("mean_smape"), F.stddev_samp("smape").alias("std_smape")
    )
    return exact_medians(metrics, ["model"], ["smape"]).join(spread, "model")
