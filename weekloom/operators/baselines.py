"""Naive forecasts any model must beat."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom.operators.horizon import future_dates
from weekloom.operators.metrics import forecast_metrics
from weekloom.spec import DEFAULT, FORECAST_WEEKS, SEASON, PanelSpec


def last_observed(history: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """The last date and value of every series."""
    return history.groupBy(*spec.keys).agg(
        F.max_by(spec.target, spec.time).alias("forecast"), F.max(spec.time).alias(spec.time)
    )


def naive_forecast(
    history: DataFrame, horizon: int = FORECAST_WEEKS, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """The last value repeated over the horizon."""
    future = future_dates(last_observed(history, spec), horizon, spec.time)
    return future.select(*spec.cell, F.lit("naive").alias("model"), "forecast")


def seasonal_naive_forecast(
    history: DataFrame,
    horizon: int = FORECAST_WEEKS,
    spec: PanelSpec = DEFAULT,
    season: int = SEASON,
) -> DataFrame:
    """The value one season earlier; a horizon beyond the season repeats the last one."""
    beyond = F.lead(spec.time, season).over(spec.series())
    tail = history.withColumn("_in_tail", beyond.isNull())
    last = tail.groupBy(*spec.keys).agg(
        F.max(spec.time).alias(spec.time),
        F.count(F.lit(1)).alias("_n"),
        F.array_sort(
            F.collect_list(F.when(F.col("_in_tail"), F.struct(spec.time, spec.target)))
        ).alias("_tail"),
    )
    future = future_dates(last.filter(F.col("_n") >= season), horizon, spec.time)
    place = F.pmod(F.col("step") - 1, F.lit(season)) + 1
    value = F.element_at("_tail", place.cast("int")).getField(spec.target)
    return future.select(
        *spec.cell, F.lit("seasonal_naive").alias("model"), value.alias("forecast")
    )


def baseline_forecasts(
    labelled: DataFrame, spec: PanelSpec = DEFAULT, season: int = SEASON
) -> DataFrame:
    """Both baselines on the validation rows of a panel with a ``split`` column.

    Naive carries the last training value; seasonal naive looks ``season`` rows back
    through train and validation and needs a season of training rows. One window pass
    gives both.
    """
    rows = labelled.filter(F.col("split").isin("train", "val"))
    trained = F.when(F.col("split") == "train", F.col(spec.target))
    upto = spec.series().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n_train = F.count(F.when(F.col("split") == "train", F.lit(1))).over(spec.whole_series())
    seasonal = F.lag(spec.target, season).over(spec.series())
    wide = rows.withColumns(
        {
            "naive": F.last(trained, ignorenulls=True).over(upto),
            "_n_train": n_train,
            "_seasonal": seasonal,
        }
    ).filter((F.col("split") == "val") & (F.col("_n_train") > 0))
    seasonal_naive = F.when(F.col("_n_train") >= season, F.col("_seasonal"))
    pairs = F.array(
        F.struct(F.lit("naive").alias("model"), F.col("naive").alias("forecast")),
        F.struct(F.lit("seasonal_naive").alias("model"), seasonal_naive.alias("forecast")),
    )
    return wide.select(*spec.cell, F.inline(pairs)).filter(F.col("forecast").isNotNull())


def baseline_metrics(labelled: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    train = labelled.filter(F.col("split") == "train")
    val = labelled.filter(F.col("split") == "val")
    return forecast_metrics(baseline_forecasts(labelled, spec), val, train, spec=spec)
