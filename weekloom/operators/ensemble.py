"""Blending the two best models of a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions import errors
from weekloom.operators.metrics import align
from weekloom.operators.selection import ensemble_weights
from weekloom.spec import DEFAULT, PanelSpec


def _two_decimals(weight: Column) -> Column:
    return F.format_string("%.2f", F.round(weight, 2))


def blend(
    candidates: DataFrame,
    selection: DataFrame,
    use_ensemble: bool = True,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Best and blended forecast of every series and date.

    ``candidates`` is the long table (keys, date, model, forecast). One join brings
    the selection to it, one aggregate puts best and second side by side. Without any
    second forecast a series falls back to its best model, without any best forecast to
    its second; with a shorter second one the blend ends where the second ends.
    """
    keys = list(spec.keys)
    w1, w2 = ensemble_weights(F.col("best_smape"), F.col("second_smape"))
    wanted = F.col("ensemble_eligible") & F.col("second_model").isNotNull() & F.lit(use_ensemble)
    choice = selection.select(
        *keys,
        "best_model",
        "second_model",
        wanted.alias("_wanted"),
        w1.alias("w_best"),
        w2.alias("w_second"),
    )
    is_best = F.col("model") == F.col("best_model")
    is_second = F.col("model") == F.col("second_model")
    paired = (
        candidates.join(choice, keys)
        .filter(is_best | is_second)
        .groupBy(*spec.cell, "best_model", "second_model", "_wanted", "w_best", "w_second")
        .agg(
            F.max(F.when(is_best, F.col("forecast"))).alias("best_forecast"),
            F.max(F.when(is_second, F.col("forecast"))).alias("_second"),
        )
    )
    series = Window.partitionBy(*keys)
    blended = F.col("_wanted") & (F.col("_n_second") > 0) & (F.col("_n_best") > 0)
    mixed = F.col("best_forecast") * F.col("w_best") + F.col("second_forecast") * F.col("w_second")
    alone = F.when(F.col("_n_best") > 0, F.col("best_forecast")).otherwise(F.col("second_forecast"))
    used = F.when(F.col("_wanted") | (F.col("_n_best") == 0), F.col("_second"))
    return (
        paired.withColumn("_n_second", F.count("_second").over(series))
        .withColumn("_n_best", F.count("best_forecast").over(series))
        .withColumn("second_forecast", used)
        .withColumn("blended", blended)
        .withColumn("forecast", F.when(F.col("blended"), mixed).otherwise(alone))
        .filter(F.col("forecast").isNotNull())
        .drop("_wanted", "_n_second", "_n_best", "_second")
    )


def not_forecast(
    candidates: DataFrame, selection: DataFrame, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """(keys, best_model, second_model, reason): selected series that get no forecast."""
    keys = list(spec.keys)
    made = candidates.filter(F.col("forecast").isNotNull()).select(*keys, "model").distinct()
    chosen = selection.select(*keys, "best_model", "second_model")
    usable = made.join(chosen, keys).filter(
        (F.col("model") == F.col("best_model")) | (F.col("model") == F.col("second_model"))
    )
    lost = chosen.join(usable.select(*keys), keys, "left_anti")
    any_model = made.select(*keys).distinct().withColumn("_some", F.lit(True))
    reason = F.when(F.col("_some"), "neither selected model has a forecast").otherwise(
        "no model has a forecast"
    )
    return lost.join(any_model, keys, "left").withColumn("reason", reason).drop("_some")


def final_forecast(
    candidates: DataFrame,
    selection: DataFrame,
    use_ensemble: bool = True,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """(keys, date, forecast, model_used) with the blend spelled out in the label."""
    rows = blend(candidates, selection, use_ensemble, spec)
    label = F.concat(
        F.lit("ensemble("),
        F.col("best_model"),
        F.lit(":"),
        _two_decimals(F.col("w_best")),
        F.lit("+"),
        F.col("second_model"),
        F.lit(":"),
        _two_decimals(F.col("w_second")),
        F.lit(")"),
    )
    single = F.when(F.col("best_forecast").isNull(), F.col("second_model")).otherwise(
        F.col("best_model")
    )
    used = F.when(F.col("blended"), label).otherwise(single)
    return rows.select(*spec.cell, "forecast", used.alias("model_used"))


def ensemble_validation(
    candidates: DataFrame, selection: DataFrame, actuals: DataFrame, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """Per eligible series: sMAPE of the best model against the blend.

    ``improved`` compares before rounding.
    """
    eligible = selection.filter("ensemble_eligible and second_model is not null")
    rows = align(blend(candidates, eligible, True, spec), actuals, spec).filter("blended")
    a = F.col("actual")
    scored = rows.groupBy(*spec.keys, "best_model", "second_model", "w_best", "w_second").agg(
        errors.smape(a, F.col("best_forecast")).alias("_best"),
        errors.smape(a, F.col("forecast")).alias("_blend"),
    )
    return scored.select(
        *spec.keys,
        "best_model",
        "second_model",
        F.round("w_best", 3).alias("w_best"),
        F.round("w_second", 3).alias("w_second"),
        F.round("_best", 2).alias("best_single_smape"),
        F.round("_blend", 2).alias("ensemble_smape"),
        (F.col("_blend") < F.col("_best")).alias("improved"),
    )


def ensemble_summary(validation: DataFrame) -> DataFrame:
    return validation.agg(
        F.count_if("improved").alias("improved_states"),
        F.count(F.lit(1)).alias("total_states"),
        F.avg(F.col("best_single_smape") - F.col("ensemble_smape")).alias("mean_delta"),
    )
