"""Forecast accuracy per series and model, and the tables summarising it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.functions import errors
from weekloom.operators.median import exact_medians
from weekloom.spec import DEFAULT, SEASON, PanelSpec


def mase_scale(train: DataFrame, spec: PanelSpec = DEFAULT, season: int = SEASON) -> DataFrame:
    """Mean absolute seasonal step of the training rows; step 1 for a short series."""
    steps = train.select(
        *spec.keys,
        F.abs(F.col(spec.target) - F.lag(spec.target, season).over(spec.series())).alias("_long"),
        F.abs(F.col(spec.target) - F.lag(spec.target, 1).over(spec.series())).alias("_short"),
    )
    count = F.count(F.lit(1))
    return steps.groupBy(*spec.keys).agg(
        F.when(count > season, F.avg("_long")).otherwise(F.avg("_short")).alias("mase_scale"),
        count.alias("n_train"),
    )


def align(predictions: DataFrame, actuals: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Predictions next to actuals on (keys, time)."""
    right = actuals.select(*spec.cell, F.col(spec.target).alias("actual"))
    return predictions.join(right, spec.cell)


def align_by_position(
    predictions: DataFrame,
    actuals: DataFrame,
    by: tuple[str, ...] = ("model",),
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """The n-th prediction next to the n-th actual, trimmed to the shorter side.

    For irregular data; on the weekly grid ``align`` gives the same rows.
    """
    inner = spec
    for name in by:
        inner = inner.with_key(name)
    left = predictions.withColumn("_pos", F.row_number().over(inner.series()))
    right = actuals.select(
        *spec.keys,
        F.col(spec.target).alias("actual"),
        F.row_number().over(spec.series()).alias("_pos"),
    )
    return left.join(right, [*spec.keys, "_pos"]).drop("_pos")


def score(
    aligned: DataFrame, by: tuple[str, ...] = ("model",), spec: PanelSpec = DEFAULT
) -> DataFrame:
    """MAE, RMSE, MAPE and sMAPE of aligned rows per (keys, by) in one aggregate."""
    a, p = F.col("actual"), F.col("forecast")
    return aligned.groupBy(*spec.keys, *by).agg(
        errors.mae(a, p).alias("mae"),
        errors.rmse(a, p).alias("rmse"),
        errors.mape(a, p).alias("mape"),
        errors.smape(a, p).alias("smape"),
        F.count(F.lit(1)).alias("n_val"),
    )


def forecast_metrics(
    predictions: DataFrame,
    actuals: DataFrame,
    train: DataFrame | None = None,
    by: tuple[str, ...] = ("model",),
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Every metric for every series and model; MASE only when training rows are given."""
    scores = score(align(predictions, actuals, spec), by, spec)
    if train is None:
        return scores
    scores = scores.join(mase_scale(train, spec), list(spec.keys), "left")
    mase = F.col("mae") / F.nullif(F.col("mase_scale"), F.lit(0.0))
    return scores.select(
        *spec.keys, *by, "mae", "rmse", "mape", "smape", mase.alias("mase"), "n_val", "n_train"
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Per model: median and mean sMAPE, median MAE, RMSE, MASE, series count; best first."""
    medians = exact_medians(metrics, ["model"], ["smape", "mae", "rmse", "mase"])
    means = metrics.groupBy("model").agg(
        F.avg("smape").alias("mean_smape"), F.count(F.lit(1)).alias("states_count")
    )
    board = medians.join(means, "model").orderBy(F.col("median_smape").asc_nulls_last(), "model")
    return board.select(
        "model",
        *[
            F.round(c, 2).alias(c)
            for c in ("median_smape", "mean_smape", "median_mae", "median_rmse", "median_mase")
        ],
        "states_count",
    )


def model_comparison(metrics: DataFrame) -> DataFrame:
    """Per model: mean and median of MAE, RMSE, sMAPE and MASE."""
    columns = ["mae", "rmse", "smape", "mase"]
    means = metrics.groupBy("model").agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])
    return means.join(exact_medians(metrics, ["model"], columns), "model")


def baseline_summary(metrics: DataFrame) -> DataFrame:
    return exact_medians(metrics, ["model"], ["smape", "mae"])


def improvement(board: DataFrame, baselines: DataFrame, over: str = "seasonal_naive") -> DataFrame:
    """How much better each model's median sMAPE is than a baseline's, in percent.

    The baseline is one number and enters as a scalar subquery.
    """
    base = baselines.filter(F.col("model") == over).agg(F.max("median_smape")).scalar()
    better = (F.lit(1.0) - F.try_divide(F.col("median_smape"), F.col("_base"))) * 100
    return (
        board.withColumn("_base", base)
        .withColumn("improvement_pct", F.when(F.col("_base") > 0, better))
        .select("model", "median_smape", "improvement_pct")
    )
