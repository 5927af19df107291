"""Raw records to panel, features, splits and model-ready tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weekloom.functions.calendar import week_ending
from weekloom.operators import guards, panel
from weekloom.operators.features import ALL_FEATURES, SEQUENCE_FEATURES, build_features, design_matrix
from weekloom.operators.scale import fit_features, fit_target
from weekloom.operators.sequence import sequence_windows
from weekloom.operators.split import with_split
from weekloom.sources.staging import stage
from weekloom.sources.tables import save_report
from weekloom.spec import DEFAULT, PanelSpec


@dataclass
class WeeklyTable:
    """The stored weekly means and the date bounds read from them.

    This is the boundary between the raw data and everything else: raw records are
    scanned once, and what follows works on at most one row per series and week.
    """

    cells: DataFrame
    spec: PanelSpec = DEFAULT

    @property
    def bounds(self) -> Column:
        return panel.date_bounds(self.cells, self.spec)

    @property
    def origin(self) -> Column:
        return self.cells.agg(F.min(self.spec.time)).scalar()

    def grid(self) -> DataFrame:
        return panel.weekly_grid(self.cells, self.spec, self.bounds)

    def panel(self) -> DataFrame:
        return panel.impute_weekly(self.cells, self.spec, self.bounds)

    def missing(self) -> DataFrame:
        return panel.missing_report(self.cells, self.spec, self.bounds)

    def features(self) -> DataFrame:
        return build_features(self.panel(), self.spec, self.origin)


def weekly_table(records: DataFrame, spec: PanelSpec = DEFAULT) -> WeeklyTable:
    """Reduce typed records to stored weekly means."""
    return WeeklyTable(stage(panel.weekly_mean(records, spec), "weekly"), spec)


def clean_records(
    raw: DataFrame, order_by: str, spec: PanelSpec = DEFAULT, on_error: str = "raise"
) -> DataFrame:
    """Text dates parsed and repeats reduced to the last.

    Only the columns of the panel go on, so a category column, constant or not, is
    never read.
    """
    guards.require_columns(raw, spec)
    rows = panel.parse_dates(raw.select(*spec.columns, order_by), spec, on_error)
    return panel.dedupe_last(rows, order_by, spec)


def ingest_report(raw: DataFrame, order_by: str, spec: PanelSpec = DEFAULT) -> DataFrame:
    """One row on the records as given: repeats, nulls and negatives, from one aggregate."""
    guards.require_columns(raw, spec)
    rows = panel.parse_dates(raw.select(*spec.columns, order_by), spec, "null")
    target = F.col(spec.target)
    per_cell = rows.groupBy(*spec.cell).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(target.isNull()).alias("nulls"),
        F.count_if(target < 0).alias("negatives"),
    )
    return per_cell.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
        F.count(F.lit(1)).alias("kept_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_sales"),
        F.coalesce(F.sum("negatives"), F.lit(0)).alias("negative_sales"),
    )


#: What a week of a series keeps of its records, beside their mean.
COUNTS = ("_raw_rows", "_kept_rows", "_null_sales", "_negative_sales")


def counted_weeks(raw: DataFrame, order_by: str, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Weekly means of the cleaned records, with the counts of what they were made from.

    The counts ride along the two aggregates that clean and reduce the records, so that no
    report has to read those again. Weeks of records without a key are kept here, since
    the report counts them.
    """
    guards.require_columns(raw, spec)
    rows = panel.parse_dates(raw.select(*spec.columns, order_by), spec)
    target = F.col(spec.target)
    cells = rows.groupBy(*spec.cell).agg(
        F.max_by(spec.target, order_by).alias(spec.target),
        F.count(F.lit(1)).alias("_n"),
        F.count_if(target.isNull()).alias("_nulls"),
        F.count_if(target < 0).alias("_negatives"),
    )
    sums = [F.sum("_n"), F.count(F.lit(1)), F.sum("_nulls"), F.sum("_negatives")]
    week = week_ending(F.col(spec.time)).alias(spec.time)
    return cells.groupBy(*spec.keys, week).agg(
        F.avg(spec.target).alias(spec.target),
        *[c.alias(name) for c, name in zip(sums, COUNTS, strict=True)],
    )


def counted_report(weeks: DataFrame) -> DataFrame:
    """``ingest_report`` of the records behind ``counted_weeks``."""
    raw_rows, kept, nulls, negatives = (F.coalesce(F.sum(c), F.lit(0)) for c in COUNTS)
    return weeks.agg(
        raw_rows.alias("raw_rows"),
        kept.alias("kept_rows"),
        (raw_rows - kept).alias("duplicate_rows"),
        nulls.alias("null_sales"),
        negatives.alias("negative_sales"),
    )


def run_ingestion(
    raw: DataFrame,
    order_by: str,
    spec: PanelSpec = DEFAULT,
    out: str | None = None,
    check: bool = True,
) -> DataFrame:
    """Raw records to the imputed weekly panel, guarded on both sides.

    Two jobs: one reads the records once and writes the weekly table, one writes the panel.
    What the guards look at is observed while these tables are written, in the stage that
    writes them, so a stage that is run again counts nothing twice. With ``out`` the
    panel, the missing-week report and the quality report of the raw records are written;
    the reports come from the weekly table.
    """
    weeks = counted_weeks(raw, order_by, spec)
    seen, whole = Observation(), Observation()
    if check:
        weeks = guards.observe_raw(weeks, seen, spec)
    stored = stage(weeks, "weekly")
    if check:
        guards.check_raw(seen.get)
    known = stored
    for key in spec.keys:
        known = known.filter(F.col(key).isNotNull())
    weekly = WeeklyTable(known.select(*spec.columns), spec)
    result = weekly.panel()
    if check:
        result = guards.observe_panel(result, whole, spec)
    if out is not None:
        schema = result.schema
        result.write.mode("overwrite").parquet(f"{out}/panel")
        result = raw.sparkSession.read.schema(schema).parquet(f"{out}/panel")
    elif check:
        result = stage(result, "panel")
    if check:
        guards.check_panel(whole.get)
    if out is not None:
        save_report(counted_report(stored), f"{out}/quality_report")
        report = weekly.missing()
        report.write.mode("overwrite").option("header", True).csv(f"{out}/missing_weeks_report")
    return result


@dataclass
class Datasets:
    """Scalers learnt on train, and model inputs for every split."""

    target_stats: DataFrame
    feature_stats: DataFrame
    matrix: DataFrame
    sequences: DataFrame


def build_datasets(
    featured: DataFrame, val_start: str, test_start: str, spec: PanelSpec = DEFAULT
) -> Datasets:
    """Design matrix and sequence windows with a ``split`` column; windows stay in a split."""
    labelled = with_split(featured, val_start, test_start, spec)
    train = labelled.filter(F.col("split") == "train")
    target_stats = fit_target(train, spec)
    feature_stats = fit_features(train, SEQUENCE_FEATURES)
    matrix = design_matrix(labelled, ALL_FEATURES, spec.with_key("split"))
    sequences = sequence_windows(
        labelled, target_stats, feature_stats, spec=spec, within=("split",)
    )
    return Datasets(target_stats, feature_stats, matrix, sequences)
