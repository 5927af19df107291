"""From raw records to a complete weekly panel.

Shuffles: one on (keys, week) for the weekly mean, with partial aggregation before
it, so a key holding a third of all raw records is already reduced to one row per
week and task. One on keys for everything after it. Gaps are filled by exploding
each observation's distance to its neighbour, so there is no grid to build, no
cross product and no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.calendar import parse_mixed_date, week_ending
from weekloom.spec import DEFAULT, PanelSpec



def parse_dates(df: DataFrame, spec: PanelSpec = DEFAULT, on_error: str = "raise") -> DataFrame:
    """Read the text date column and drop rows without a date."""
    parsed = df.withColumn(spec.time, parse_mixed_date(F.col(spec.time), on_error))
    return parsed.filter(F.col(spec.time).isNotNull())


def date_quality(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """How many date texts are missing, unreadable or fine: one row."""
    text = F.col(spec.time)
    parsed = parse_mixed_date(text, on_error="null")
    blank = text.isNull() | (F.trim(text) == "")
    return df.agg(
        F.count_if(blank).alias("blank_dates"),
        F.count_if(parsed.isNull() & ~blank).alias("junk_dates"),
        F.count_if(parsed.isNotNull()).alias("good_dates"),
    )


def drop_constant_column(df: DataFrame, column: str) -> DataFrame:
    """Drop ``column`` when it holds a single value (NULL counts as a value).

    The schema of the result depends on the data, so this runs one small job:
    minimum, maximum and null count, all partially aggregated.
    """
    if column not in df.columns:
        return df
    seen = df.agg(
        F.min(column).alias("lo"),
        F.max(column).alias("hi"),
        F.count_if(F.col(column).isNull()).alias("nulls"),
        F.count(F.lit(1)).alias("total"),
    ).first()
    if seen.total == 0:
        return df
    constant = seen.nulls == seen.total or (seen.nulls == 0 and seen.lo == seen.hi)
    return df.drop(column) if constant else df


def dedupe_last(df: DataFrame, order_by: str, spec: PanelSpec = DEFAULT) -> DataFrame:
    """One row per (keys, time): the one with the largest ``order_by``.

    An aggregate rather than a window: repeats of a hot cell collapse before the
    shuffle instead of being sorted in one task. ``order_by`` must not repeat within a
    cell. Numeric columns keep this a hash aggregate.
    """
    others = [c for c in df.columns if c not in (*spec.cell, order_by)]
    kept = df.groupBy(*spec.cell).agg(
        F.max(order_by).alias(order_by), *[F.max_by(c, order_by).alias(c) for c in others]
    )
    return kept.select(*df.columns)


def duplicate_count(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Rows beyond the first of each (keys, time): one row."""
    per_cell = df.groupBy(*spec.cell).agg(F.count(F.lit(1)).alias("n"))
    return per_cell.agg(
        F.sum("n").alias("raw_rows"),
        F.count(F.lit(1)).alias("kept_rows"),
        F.sum(F.col("n") - 1).alias("duplicate_rows"),
    )


def quality_counts(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    target = F.col(spec.target)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(target.isNull()).alias("null_sales"),
        F.count_if(target < 0).alias("negative_sales"),
    )


def weekly_mean(df: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Mean of the target per (keys, week ending Saturday); rows without a key go."""
    known = df
    for key in spec.keys:
        known = known.filter(F.col(key).isNotNull())
    week = week_ending(F.col(spec.time)).alias(spec.time)
    return known.groupBy(*spec.keys, week).agg(F.avg(spec.target).alias(spec.target))


def date_bounds(weekly: DataFrame, spec: PanelSpec = DEFAULT) -> Column:
    """(lo, hi) of the whole table as a scalar subquery: no join, no driver round trip.

    Give it a stored table: the answer then comes out of a scan of the date column.
    """
    bounds = F.struct(F.min(spec.time).alias("lo"), F.max(spec.time).alias("hi"))
    return weekly.agg(bounds.alias("bounds")).scalar()


def _gap_spans(weekly: DataFrame, spec: PanelSpec, bounds: Column) -> DataFrame:
    """Every observed cell, exploded over the weeks up to the next one.

    The first cell of a series also covers the weeks before it and the last one the
    weeks after it, out to the global bounds. A series without any value keeps one
    carrier row. ``_week`` is the grid week; the neighbour is in ``_to``/``_next``.
    """
    here, ahead = F.col(spec.time), F.lead(spec.time).over(spec.series())
    observed = F.count(spec.target).over(spec.whole_series())
    first_row = F.row_number().over(spec.series()) == 1
    anchors = (
        weekly.withColumns({"_observed": observed, "_first_row": first_row})
        .filter(F.col(spec.target).isNotNull() | ((F.col("_observed") == 0) & F.col("_first_row")))
        .withColumns(
            {
                "_to": ahead,
                "_next": F.lead(spec.target).over(spec.series()),
                "_head": F.lag(spec.time).over(spec.series()).isNull(),
                "_bounds": bounds,
            }
        )
    )
    start = F.when(F.col("_head"), F.col("_bounds.lo")).otherwise(here)
    stop = F.when(F.col("_to").isNull(), F.col("_bounds.hi")).otherwise(F.date_sub("_to", 7))
    weeks = F.explode(F.sequence(start, stop, F.expr("interval 7 days")))
    return anchors.select(
        *spec.keys, here.alias("_from"), spec.target, "_to", "_next", weeks.alias("_week")
    )


def weekly_grid(
    weekly: DataFrame, spec: PanelSpec = DEFAULT, bounds: Column | None = None
) -> DataFrame:
    """Every series over every week of the global range; NULL where nothing was observed."""
    bounds = date_bounds(weekly, spec) if bounds is None else bounds
    spans = _gap_spans(weekly, spec, bounds)
    value = F.when(F.col("_week") == F.col("_from"), F.col(spec.target))
    return spans.select(*spec.keys, F.col("_week").alias(spec.time), value.alias(spec.target))


def impute_weekly(
    weekly: DataFrame, spec: PanelSpec = DEFAULT, bounds: Column | None = None
) -> DataFrame:
    """The grid with interior gaps filled linearly, head and tail filled flat."""
    bounds = date_bounds(weekly, spec) if bounds is None else bounds
    spans = _gap_spans(weekly, spec, bounds)
    value, after = F.col(spec.target), F.col("_next")
    into = F.date_diff("_week", "_from") / 7
    width = F.date_diff("_to", "_from") / 7
    between = value + (after - value) * into / width
    filled = F.when((F.col("_week") <= F.col("_from")) | after.isNull(), value).otherwise(between)
    return spans.select(*spec.keys, F.col("_week").alias(spec.time), filled.alias(spec.target))


def missing_report(
    weekly: DataFrame, spec: PanelSpec = DEFAULT, bounds: Column | None = None
) -> DataFrame:
    """Weeks without a value per series, with the total and its share of the grid.

    Counting observed cells against the length of the range needs no grid.
    """
    bounds = date_bounds(weekly, spec) if bounds is None else bounds
    per_key = (
        weekly.groupBy(*spec.keys)
        .agg(F.count(spec.target).alias("_seen"))
        .withColumn("_bounds", bounds)
        .withColumn(
            "grid_weeks",
            (F.date_diff("_bounds.hi", "_bounds.lo") / 7).cast("long") + F.lit(1),
        )
        .select(*spec.keys, (F.col("grid_weeks") - F.col("_seen")).alias("missing_weeks"), "grid_weeks")
    )
    total = per_key.agg(
        F.struct(
            F.sum("missing_weeks").alias("missing"), F.sum("grid_weeks").alias("cells")
        ).alias("total")
    ).scalar()
    return per_key.withColumn("_total", total).select(
        *spec.keys,
        "missing_weeks",
        "grid_weeks",
        F.col("_total.missing").alias("total_missing"),
        (F.lit(100.0) * F.col("_total.missing") / F.col("_total.cells")).alias("missing_pct"),
    )


def panel_summary(panel: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Series, range, weeks per series, rows and nulls: one row, two-level aggregate."""
    per_key = panel.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("_weeks"),
        F.min(spec.time).alias("_lo"),
        F.max(spec.time).alias("_hi"),
        F.count_if(F.col(spec.target).isNull()).alias("_nulls"),
    )
    return per_key.agg(
        F.count(F.lit(1)).alias("series"),
        F.min("_lo").alias("first_date"),
        F.max("_hi").alias("last_date"),
        F.min("_weeks").alias("min_weeks"),
        F.max("_weeks").alias("max_weeks"),
        F.sum("_weeks").alias("total_rows"),
        F.sum("_nulls").alias("null_sales"),
    )


def gap_check(panel: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Non-weekly steps per series, all series checked; only offenders are returned."""
    step = F.date_diff(spec.time, F.lag(spec.time).over(spec.series()))
    return (
        panel.select(*spec.keys, step.alias("_step"))
        .groupBy(*spec.keys)
        .agg(F.count_if(F.col("_step") != 7).alias("gaps"))
        .filter("gaps > 0")
    )
