"""Best model per series, winners, and the tables about where models disagree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.spec import DEFAULT, ENSEMBLE_RATIO, SMAPE_FLOOR, PanelSpec


def _known(c: str) -> Column:
    """NaN and NULL both rank last."""
    return F.when(~F.isnan(c), F.col(c))


def _order_in(models: Sequence[str]) -> Column:
    """Position of a model in the list of families, which is the load order."""
    position = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    return F.when(position > 0, position).otherwise(F.lit(len(models) + 1))


def _rank_struct(models: Sequence[str], *keys: str) -> list[Column]:
    """Sort key with NULLs last in every position, then load order."""
    parts = []
    for k in keys:
        parts += [_known(k).isNull().alias(f"_{k}_missing"), _known(k).alias(f"_{k}")]
    return [*parts, _order_in(models).alias("_position"), F.col("model")]


def ensemble_weights(best: Column, second: Column) -> tuple[Column, Column]:
    """Shares of both models: the smaller the error of one, the larger its share.

    With two models the inverse-error share of the best is the second's part of the
    summed errors. Errors are floored, so that a perfect fit stays finite.
    """
    floored = [F.greatest(e, F.lit(SMAPE_FLOOR)) for e in (best, second)]
    share = floored[1] / (floored[0] + floored[1])
    return share, 1 - share


def select_best(
    metrics: DataFrame, models: Sequence[str], spec: PanelSpec = DEFAULT
) -> DataFrame:
    """Best and second model per series by sMAPE, then MASE, then load order.

    A series has one row per model family, so its two smallest rows come out of a
    plain aggregate: no sort, no window, no pivot.
    """
    entry = F.struct(*_rank_struct(models, "smape", "mase"), "smape", "mase", "mae")
    ranked = metrics.groupBy(*spec.keys).agg(F.array_sort(F.collect_list(entry)).alias("_ranked"))
    best, second = F.get("_ranked", F.lit(0)), F.get("_ranked", F.lit(1))
    chosen = ranked.select(
        *spec.keys,
        best["model"].alias("best_model"),
        best["smape"].alias("best_smape"),
        best["mase"].alias("best_mase"),
        best["mae"].alias("best_mae"),
        second["model"].alias("second_model"),
        second["smape"].alias("second_smape"),
    )
    ratio = F.col("second_smape") / F.nullif(F.col("best_smape"), F.lit(0.0))
    close = (F.col("best_smape") > 0) & (ratio <= ENSEMBLE_RATIO)
    return chosen.withColumn("ensemble_eligible", F.coalesce(close, F.lit(False)))


def winner_counts(selection: DataFrame) -> DataFrame:
    return selection.groupBy("best_model").agg(F.count(F.lit(1)).alias("states_won"))


def model_usage(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("model_used").agg(F.count(F.lit(1)).alias("total_rows"))


def state_comparison(
    metrics: DataFrame, models: Sequence[str], spec: PanelSpec = DEFAULT
) -> DataFrame:
    """Series by model sMAPE with the winner; ties go to the alphabetically first model."""
    ordered = sorted(models)
    wide = metrics.groupBy(*spec.keys).agg(
        *[F.avg(F.when(F.col("model") == m, _known("smape"))).alias(m) for m in ordered]
    )
    cells = F.array_compact(
        F.array(
            *[
                F.when(F.col(m).isNotNull(), F.struct(F.col(m).alias("v"), F.lit(m).alias("m")))
                for m in ordered
            ]
        )
    )
    best = F.array_min(cells)
    return (
        wide.withColumns({"best_model": best["m"], "best_smape": best["v"]})
        .filter(F.col("best_model").isNotNull())
        .orderBy("best_smape", *spec.keys)
        .select(
            *spec.keys,
            *[F.round(m, 2).alias(m) for m in ordered],
            "best_model",
            F.round("best_smape", 2).alias("best_smape"),
        )
    )


def worst_states(
    metrics: DataFrame, models: Sequence[str], n: int = 5, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """The ``n`` series whose best model (by sMAPE alone) is worst: a top-k report."""
    entry = F.struct(*_rank_struct(models, "smape"), "smape", "mae", "mase")
    usable = metrics.filter(_known("smape").isNotNull())
    best = usable.groupBy(*spec.keys).agg(F.min(entry).alias("_best"))
    return (
        best.select(*spec.keys, "_best.model", "_best.smape", "_best.mae", "_best.mase")
        .orderBy(F.col("smape").desc(), *spec.keys)
        .limit(n)
        .select(
            *spec.keys,
            "model",
            *[F.round(c, 2).alias(c) for c in ("smape", "mae", "mase")],
        )
    )


def spread(metrics: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    return metrics.groupBy(*spec.keys).agg(
        (F.max("smape") - F.min("smape")).alias("smape_range")
    )


def spread_states(metrics: DataFrame, n: int = 15, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Metric rows of the ``n`` series where models disagree most."""
    top = spread(metrics, spec).orderBy(F.col("smape_range").desc(), *spec.keys).limit(n)
    return metrics.join(top.select(*spec.keys), list(spec.keys), "left_semi")
