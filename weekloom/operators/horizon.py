"""Future rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.spec import DEFAULT, PanelSpec


def weeks_after(day: Column, k: Column | int) -> Column:
    return F.date_add(day, F.lit(7) * k)


def future_dates(last: DataFrame, horizon: int, time: str = "date") -> DataFrame:
    """``horizon`` weekly rows after each row's date, numbered by ``step``."""
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return last.withColumn("step", steps).withColumn(time, weeks_after(F.col(time), F.col("step")))


def extend(history: DataFrame, horizon: int, spec: PanelSpec = DEFAULT) -> DataFrame:
    """History (step 0) plus ``horizon`` rows without a target after each series' last.

    The last row multiplies in place, so no second pass, union or join is needed and
    the partitioning by key is kept for the windows that follow.
    """
    is_last = F.lead(spec.time).over(spec.series()).isNull()
    steps = F.when(F.col("_is_last"), F.sequence(F.lit(0), F.lit(horizon))).otherwise(
        F.array(F.lit(0))
    )
    rows = history.select(*spec.columns, is_last.alias("_is_last")).select(
        *spec.columns, F.explode(steps).alias("step")
    )
    return rows.select(
        *spec.keys,
        weeks_after(F.col(spec.time), F.col("step")).alias(spec.time),
        F.when(F.col("step") == 0, F.col(spec.target)).alias(spec.target),
        "step",
    )
