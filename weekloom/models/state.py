"""The per-series state recursive forecasting carries from step to step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.arrays import from_end, tail_mean, tail_std
from weekloom.functions.calendar import (
    calendar_columns,
    cyclical_columns,
    holiday_week,
    weeks_between,
)
from weekloom.operators.horizon import weeks_after
from weekloom.spec import DEFAULT, LAGS, ROLLING_WINDOWS, SEASON, PanelSpec

HISTORY = max(*LAGS, *ROLLING_WINDOWS, SEASON)


def history_state(
    panel: DataFrame, spec: PanelSpec = DEFAULT, origin: Column | None = None
) -> DataFrame:
    """One row per series: last ``HISTORY`` values plus (sum, count) of all of them.

    The expanding mean needs only the sum and count, so the array stays at a fixed
    length however long the series is. Series too short for every lag are left out.
    """
    beyond = F.lead(spec.time, HISTORY).over(spec.series())
    tail = F.array_sort(F.collect_list(F.when(F.col("_in_tail"), F.struct(spec.time, spec.target))))
    state = (
        panel.withColumn("_in_tail", beyond.isNull())
        .groupBy(*spec.keys)
        .agg(
            F.max(spec.time).alias("last_date"),
            F.transform(tail, lambda x: x[spec.target]).alias("hist"),
            F.sum(spec.target).alias("hist_sum"),
            F.count(F.lit(1)).alias("hist_count"),
        )
        .filter(F.col("hist_count") > HISTORY)
    )
    origin = panel.agg(F.min(spec.time)).scalar() if origin is None else origin
    return state.withColumn("origin", origin)


def next_features(
    hist: Column, total: Column, count: Column, day: Column, origin: Column
) -> dict[str, Column]:
    """The 23 features of the row dated ``day``, from the values before it only."""
    out = {
        **calendar_columns(day),
        **cyclical_columns(day),
        "is_holiday_week": holiday_week(day),
        "week_index": weeks_between(day, origin),
    }
    for k in LAGS:
        out[f"lag_{k}"] = from_end(hist, k)
    for w in ROLLING_WINDOWS:
        out[f"roll_mean_{w}"] = tail_mean(hist, w)
        out[f"roll_std_{w}"] = tail_std(hist, w)
    last, before_last = from_end(hist, 1), from_end(hist, 2)
    out["pct_change_1"] = F.try_divide(last - before_last, before_last)
    out["state_expanding_mean"] = total / count
    return out


def from_row(day: Column) -> dict[str, Column]:
    """``next_features`` over the state's own columns."""
    return next_features(
        F.col("hist"), F.col("hist_sum"), F.col("hist_count"), day, F.col("origin")
    )


def recursive_features(
    panel: DataFrame, spec: PanelSpec = DEFAULT, origin: Column | None = None
) -> DataFrame:
    """Features of the first week after every series, built from the state arrays."""
    day = weeks_after(F.col("last_date"), 1)
    named = [c.alias(name) for name, c in from_row(day).items()]
    return history_state(panel, spec, origin).select(*spec.keys, day.alias(spec.time), *named)


def unroll(state: DataFrame, model: str, spec: PanelSpec = DEFAULT) -> DataFrame:
    """The predicted path as rows (keys, time, model, forecast).

    The path is never empty. The outer form keeps the optimizer from deriving a size
    filter on it, which it would push through every step of the recursion, inlining
    each prediction into the next.
    """
    points = F.posexplode_outer("path").alias("_step", "forecast")
    steps = state.select(*spec.keys, "last_date", points)
    return steps.select(
        *spec.keys,
        weeks_after(F.col("last_date"), F.col("_step") + 1).alias(spec.time),
        F.lit(model).alias("model"),
        "forecast",
    )
