"""Per-series models that are plain aggregates: any number of series in one query.

Neither needs a solver, a Python worker or a loop; a series without enough rows
produces no rows instead of failing the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekloom.functions.calendar import holiday_week
from weekloom.operators.horizon import extend, future_dates
from weekloom.spec import DEFAULT, FORECAST_WEEKS, MIN_TRAIN_ROWS, SEASON, PanelSpec


def _differences(spec: PanelSpec, season: int) -> dict[str, Column]:
    """The differenced series and its predecessor, seasonal and plain."""
    y = F.col(spec.target)

    def back(k: int) -> Column:
        return F.lag(spec.target, k).over(spec.series())

    return {
        "_ds": y - back(season),
        "_ds_before": back(1) - back(season + 1),
        "_dp": y - back(1),
        "_dp_before": back(1) - back(2),
    }


def seasonal_ar_fit(
    history: DataFrame, spec: PanelSpec = DEFAULT, season: int = SEASON
) -> DataFrame:
    """One row per series: the coefficients and state of an AR(1) on differences.

    Differences are seasonal when there are at least two seasons of rows, plain
    otherwise. ``tail`` holds the last ``season`` values at most.
    """
    rows = history.withColumns(
        {
            **_differences(spec, season),
            "_in_tail": F.lead(spec.time, season).over(spec.series()).isNull(),
        }
    )
    tail = F.array_sort(
        F.collect_list(F.when(F.col("_in_tail"), F.struct(spec.time, spec.target)))
    )
    fitted = rows.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n_train"),
        F.max(spec.time).alias(spec.time),
        F.regr_slope("_ds", "_ds_before").alias("_bs"),
        F.regr_intercept("_ds", "_ds_before").alias("_as"),
        F.regr_slope("_dp", "_dp_before").alias("_bp"),
        F.regr_intercept("_dp", "_dp_before").alias("_ap"),
        F.max_by("_ds", spec.time).alias("_last_s"),
        F.max_by("_dp", spec.time).alias("_last_p"),
        F.transform(tail, lambda x: x[spec.target]).alias("tail"),
    )
    seasonal = F.col("n_train") >= 2 * season

    def pick(a: str, b: str) -> Column:
        return F.when(seasonal, F.col(a)).otherwise(F.col(b))

    return fitted.select(
        *spec.cell,
        "n_train",
        F.when(seasonal, F.lit(season)).otherwise(F.lit(1)).alias("lag"),
        pick("_bs", "_bp").alias("slope"),
        pick("_as", "_ap").alias("intercept"),
        pick("_last_s", "_last_p").alias("last_difference"),
        "tail",
    ).filter((F.col("n_train") >= MIN_TRAIN_ROWS) & F.col("slope").isNotNull())


def seasonal_ar_predict(
    fitted: DataFrame, horizon: int = FORECAST_WEEKS, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """Closed-form forecasts from a coefficient table.

    The difference ``j`` steps ahead is a(1-b^j)/(1-b) + b^j d, or d + a j when b = 1.
    Step h adds the differences h, h-lag, h-2 lag, ... to the last observed value in
    phase, which also covers horizons beyond one season.
    """
    a, b, d = F.col("intercept"), F.col("slope"), F.col("last_difference")

    def ahead(j: Column) -> Column:
        power = F.pow(b, j)
        geometric = a * (F.lit(1.0) - power) / F.nullif(F.lit(1.0) - b, F.lit(0.0)) + power * d
        return F.when(b == 1.0, d + a * j).otherwise(geometric)

    step, lag = F.col("step"), F.col("lag")
    cycles = F.ceil(step / lag).cast("int")
    base = F.element_at("tail", (step - lag * cycles - 1).cast("int"))
    moved = F.aggregate(
        F.sequence(F.lit(0), cycles - 1), F.lit(0.0), lambda acc, k: acc + ahead(step - lag * k)
    )
    future = future_dates(fitted, horizon, spec.time)
    return future.select(
        *spec.cell, F.lit("seasonal_ar").alias("model"), (base + moved).alias("forecast")
    )


def seasonal_ar(
    history: DataFrame, horizon: int = FORECAST_WEEKS, spec: PanelSpec = DEFAULT
) -> DataFrame:
    return seasonal_ar_predict(seasonal_ar_fit(history, spec), horizon, spec)


def seasonal_ar_insample(
    history: DataFrame, spec: PanelSpec = DEFAULT, season: int = SEASON
) -> DataFrame:
    """One-step fitted values on the training rows; NULL during warm-up."""
    whole = spec.whole_series()
    rows = history.withColumns(
        {
            **_differences(spec, season),
            "_base_s": F.lag(spec.target, season).over(spec.series()),
            "_base_p": F.lag(spec.target, 1).over(spec.series()),
            "_n": F.count(F.lit(1)).over(whole),
        }
    ).withColumns(
        {
            "_bs": F.regr_slope("_ds", "_ds_before").over(whole),
            "_as": F.regr_intercept("_ds", "_ds_before").over(whole),
            "_bp": F.regr_slope("_dp", "_dp_before").over(whole),
            "_ap": F.regr_intercept("_dp", "_dp_before").over(whole),
        }
    )
    seasonal = F.col("_base_s") + F.col("_as") + F.col("_bs") * F.col("_ds_before")
    plain = F.col("_base_p") + F.col("_ap") + F.col("_bp") * F.col("_dp_before")
    fitted = F.when(F.col("_n") >= 2 * season, seasonal).otherwise(plain)
    return rows.filter(F.col("_n") >= MIN_TRAIN_ROWS).select(
        *spec.cell, spec.target, F.lit("seasonal_ar").alias("model"), fitted.alias("fitted")
    )


def decomposition_fit(
    history: DataFrame, horizon: int = FORECAST_WEEKS, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """Trend, season and holiday factors on history and future rows alike.

    Future rows have no target, which every aggregate below skips, so one pass fits
    the history and projects it. All windows are within a series and share its
    partitioning.
    """
    whole = spec.whole_series()
    y = F.col(spec.target)
    rows = extend(history, horizon, spec)
    age = F.date_diff(spec.time, F.min(spec.time).over(whole)) / 7
    rows = rows.withColumns({"_age": age, "_n": F.count(y).over(whole)}).filter(
        F.col("_n") >= MIN_TRAIN_ROWS
    )
    slope = F.regr_slope(y, F.col("_age")).over(whole)
    intercept = F.regr_intercept(y, F.col("_age")).over(whole)
    rows = rows.withColumns(
        {
            "trend": intercept + slope * F.col("_age"),
            "_week": F.least(F.weekofyear(spec.time), F.lit(52)),
            "_holiday": holiday_week(F.col(spec.time)),
        }
    )
    ratio = F.when(F.col("trend") > 0, y / F.col("trend"))
    by_week = Window.partitionBy(*spec.keys, "_week")
    rows = rows.withColumn("season", F.coalesce(F.avg(ratio).over(by_week), F.lit(1.0)))
    left = F.when(
        F.col("trend") > 0, y / F.nullif(F.col("trend") * F.col("season"), F.lit(0.0))
    )
    by_flag = Window.partitionBy(*spec.keys, "_holiday")
    rows = rows.withColumn("holiday", F.coalesce(F.avg(left).over(by_flag), F.lit(1.0)))
    fitted = F.col("trend") * F.col("season") * F.col("holiday")
    return rows.select(
        *spec.columns, "step", "trend", "season", "holiday", fitted.alias("fitted")
    )


def decomposition(
    history: DataFrame, horizon: int = FORECAST_WEEKS, spec: PanelSpec = DEFAULT
) -> DataFrame:
    rows = decomposition_fit(history, horizon, spec).filter("step > 0 and fitted is not null")
    return rows.select(
        *spec.cell, F.lit("decomposition").alias("model"), F.col("fitted").alias("forecast")
    )


def decomposition_coefficients(history: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """The fitted model of every series as one row: what a later prediction needs.

    (keys, first_date, level, slope, season by week, holiday by flag); a plain table, so
    saving and loading it is writing and reading Parquet.
    """
    day = F.col(spec.time)
    fit = decomposition_fit(history, 0, spec).withColumns(
        {"_week": F.least(F.weekofyear(day), F.lit(52)), "_flag": holiday_week(day)}
    )
    weeks = F.date_diff(F.max(day), F.min(day)) / 7
    rise = F.max_by("trend", day) - F.min_by("trend", day)
    # At most one entry for each week of a year, and one for each flag.
    table = lambda k, v: F.map_from_entries(F.collect_set(F.struct(k, v)))
    return fit.groupBy(*spec.keys).agg(
        F.min(day).alias("first_date"),
        F.min_by("trend", day).alias("level"),
        (rise / F.nullif(weeks, F.lit(0.0))).alias("slope"),
        table("_week", "season").alias("season"),
        table("_flag", "holiday").alias("holiday"),
    )


def decomposition_predict(
    coefficients: DataFrame, rows: DataFrame, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """(keys, time, model, forecast) for given dates; weeks never seen count as average."""
    day = F.col(spec.time)
    joined = rows.select(*spec.cell).join(coefficients, list(spec.keys))
    trend = F.col("level") + F.col("slope") * (F.date_diff(day, F.col("first_date")) / 7)
    season = F.try_element_at("season", F.least(F.weekofyear(day), F.lit(52)))
    holiday = F.try_element_at("holiday", holiday_week(day))
    value = trend * F.coalesce(season, F.lit(1.0)) * F.coalesce(holiday, F.lit(1.0))
    return joined.select(
        *spec.cell, F.lit("decomposition").alias("model"), value.alias("forecast")
    ).filter(F.col("forecast").isNotNull())


def decomposition_insample(history: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    rows = decomposition_fit(history, 0, spec)
    return rows.select(*spec.columns, F.lit("decomposition").alias("model"), "fitted")
