"""Leak-free features of a weekly panel.

All per-series features share one window partitioning and ordering, so the plan has
one exchange and one sort however many of them are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions.calendar import (
    calendar_columns,
    cyclical_columns,
    holiday_week,
    week_ending,
    weeks_between,
)
from weekloom.spec import DEFAULT, LAGS, ROLLING_WINDOWS, PanelSpec

# The names of the features in the order in which models read them.
CALENDAR_FEATURES = [
    "month",
    "week_of_year",
    "year",
    "quarter",
    "day_of_week",
    "month_sin",
    "month_cos",
    "week_of_year_sin",
    "week_of_year_cos",
    "is_holiday_week",
    "week_index",
]
LAG_FEATURES = [f"lag_{k}" for k in LAGS]
ROLLING_FEATURES = [f"roll_{stat}_{w}" for w in ROLLING_WINDOWS for stat in ("mean", "std")]
DERIVED_FEATURES = ["pct_change_1", "state_expanding_mean"]
ALL_FEATURES = CALENDAR_FEATURES + LAG_FEATURES + ROLLING_FEATURES + DERIVED_FEATURES

RAW_CALENDAR = ("month", "week_of_year", "day_of_week", "quarter", "year")
SEQUENCE_FEATURES = [f for f in ALL_FEATURES if f not in RAW_CALENDAR]
TREE_FEATURES = [*ALL_FEATURES, "state_encoded"]


def lag_columns(spec: PanelSpec = DEFAULT) -> dict[str, Column]:
    return {f"lag_{k}": F.lag(spec.target, k).over(spec.series()) for k in LAGS}


def rolling_columns(spec: PanelSpec = DEFAULT) -> dict[str, Column]:
    """Mean and sample deviation over the ``w`` rows before the current one."""
    out = {}
    for w in ROLLING_WINDOWS:
        before = spec.series().rowsBetween(-w, -1)
        out[f"roll_mean_{w}"] = F.avg(spec.target).over(before)
        out[f"roll_std_{w}"] = F.stddev_samp(spec.target).over(before)
    return out


def derived_columns(spec: PanelSpec = DEFAULT) -> dict[str, Column]:
    last, before_last = (F.lag(spec.target, k).over(spec.series()) for k in (1, 2))
    so_far = spec.series().rowsBetween(Window.unboundedPreceding, -1)
    return {
        "pct_change_1": F.try_divide(last - before_last, before_last),
        "state_expanding_mean": F.avg(spec.target).over(so_far),
    }


def first_date(panel: DataFrame, spec: PanelSpec = DEFAULT) -> Column:
    """The global first date as a scalar subquery."""
    return panel.agg(F.min(spec.time).alias("origin")).scalar()


def add_calendar(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(spec.time)))


def add_cyclical(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    return df.withColumns(cyclical_columns(F.col(spec.time)))


def add_holiday_flag(
    df: DataFrame, spec: PanelSpec = DEFAULT, holidays: DataFrame | None = None
) -> DataFrame:
    """Flag weeks with a holiday: by rule, or against a table with a ``holiday`` column.

    A given table is reduced to its distinct Saturdays and joined on equality; Spark
    picks the join by the table's measured size.
    """
    if holidays is None:
        return df.withColumn("is_holiday_week", holiday_week(F.col(spec.time)))
    weeks = holidays.select(week_ending(F.col("holiday")).alias(spec.time)).distinct()
    flagged = df.join(weeks.withColumn("_hit", F.lit(1)), spec.time, "left")
    return flagged.select(*df.columns, F.coalesce("_hit", F.lit(0)).alias("is_holiday_week"))


def add_lags(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    return df.withColumns(lag_columns(spec))


def add_rolling(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    return df.withColumns(rolling_columns(spec))


def add_derived(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    return df.withColumns(derived_columns(spec))


def add_week_index(
    df: DataFrame, spec: PanelSpec = DEFAULT, origin: Column | None = None
) -> DataFrame:
    origin = first_date(df, spec) if origin is None else origin
    return df.withColumn("week_index", weeks_between(F.col(spec.time), origin))


def build_features(
    panel: DataFrame, spec: PanelSpec = DEFAULT, origin: Column | None = None
) -> DataFrame:
    """All 23 features in one projection over one shared window."""
    origin = first_date(panel, spec) if origin is None else origin
    day = F.col(spec.time)
    columns = {
        **calendar_columns(day),
        **cyclical_columns(day),
        "is_holiday_week": holiday_week(day),
        "week_index": weeks_between(day, origin),
        **lag_columns(spec),
        **rolling_columns(spec),
        **derived_columns(spec),
    }
    return panel.withColumns(columns).select(*panel.columns, *ALL_FEATURES)


def complete_cases(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where every listed feature is present; keys and date stay in the row."""
    return df.dropna(subset=list(columns))


def dropped_count(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows ``complete_cases`` keeps and drops: one row."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    return df.agg(
        F.count_if(whole).alias("kept_rows"), F.count_if(~whole).alias("dropped_rows")
    )


def design_matrix(df: DataFrame, columns: list[str], spec: PanelSpec = DEFAULT) -> DataFrame:
    """Complete rows with features and target in single precision, keys kept."""
    kept = complete_cases(df, columns)
    return kept.select(
        *spec.keys,
        spec.time,
        F.col(spec.target).cast("float").alias(spec.target),
        *[F.col(c).cast("float").alias(c) for c in columns],
    )


def feature_null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls per feature, one row each: one aggregate pass, then unpivoted."""
    columns = list(ALL_FEATURES if columns is None else columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "feature", "null_rows")
