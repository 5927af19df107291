"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.functions.calendar import parse_mixed_date, week_ending
from weekloom.functions.text import slug
from weekloom.models import treetable
from weekloom.models.gbt import PooledTrees
from weekloom.models.seqlinear import SequenceRegression
from weekloom.models.state import recursive_features
from weekloom.operators import (
    backtest,
    baselines,
    closed_form,
    custom,
    encode,
    ensemble,
    features,
    guards,
    horizon,
    metrics,
    panel,
    scale,
    selection,
    sequence,
    split,
)
from weekloom.plans import ingestion, training
from weekloom.plans.serving import ForecastStore
from weekloom.sources import raw, tables
from weekloom.sources.staging import stage, staged_path
from weekloom.spec import FORECAST_WEEKS, PanelSpec

VAL_START = "2000-07-01"
TEST_START = "2000-12-30"
ONE_STATE = "NATION_7"
LOOKUP_TEXT = "  nation_7 "
SEGMENTS = PanelSpec(("state", "segment"))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(places: int | None = 4) -> Callable[[Query], Query]:
    """Register a query; its doubles are rounded to ``places``."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return df if places is None else rounded(df, places)

        run.__name__ = fn.__name__
        QUERIES[fn.__name__] = run
        return run

    return register


def rounded(df: DataFrame, places: int) -> DataFrame:
    """Doubles rounded half up; what lies a thousandth of a step below a tie counts as one."""
    step = float(10**places)
    return df.select(
        *[
            (F.floor(F.col(f.name).cast("double") * step + 0.501) / step).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# Shared inputs ---------------------------------------------------------------------


def star(spark: SparkSession, sf_dir: str) -> raw.StarSchema:
    return raw.StarSchema(spark, sf_dir)


def weekly(spark: SparkSession, sf_dir: str) -> ingestion.WeeklyTable:
    return ingestion.weekly_table(star(spark, sf_dir).daily_sales())


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The imputed panel, stored because its consumers read it several times."""
    return stage(weekly(spark, sf_dir).panel(), "panel")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.with_split(stored_panel(spark, sf_dir), VAL_START, TEST_START)


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with their split label, stored for the trained models."""
    wide = weekly(spark, sf_dir).features()
    return stage(split.with_split(wide, VAL_START, TEST_START), "features")


def cut(spark: SparkSession, sf_dir: str) -> training.Evaluation:
    return training.evaluation(stored_panel(spark, sf_dir), VAL_START, TEST_START)


def closed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored validation metrics of the closed-form families."""
    ev = cut(spark, sf_dir)
    return stage(ev.metrics(ev.closed_forecasts()), "metrics")


def closed_selection(scores: DataFrame) -> DataFrame:
    return selection.select_best(scores, training.CLOSED_FAMILIES)


def closed_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return training.select_and_forecast(stored_panel(spark, sf_dir), VAL_START, TEST_START)


def store(spark: SparkSession, sf_dir: str) -> ForecastStore:
    """Results saved and reopened the way a lookup service would."""
    run = closed_run(spark, sf_dir)
    board = metrics.leaderboard(run["metrics"])
    path = staged_path(spark, "store")
    ForecastStore(run["forecasts"], run["selection"], run["metrics"], board).save(path)
    return ForecastStore.load(spark, path)


# Sources and sinks -----------------------------------------------------------------


@query()
def load_raw(spark, sf_dir):
    messy = star(spark, sf_dir).order_records()
    path = staged_path(spark, "raw-csv")
    headers = {"state": " State", "date": "Date ", "category": "Category", "sales": "Total"}
    named = messy.select(*[F.col(c).alias(headers.get(c, "Order Seq")) for c in messy.columns])
    named.write.option("header", True).csv(path)
    loaded = raw.load_raw(spark, path)
    return loaded.withColumn("order_seq", F.col("order_seq").cast("long"))


@query()
def split_roundtrip(spark, sf_dir):
    path = staged_path(spark, "splits")
    tables.save_splits(labelled(spark, sf_dir), path)
    parts = tables.load_splits(spark, path)
    return reduce(
        lambda a, b: a.unionByName(b),
        [part.withColumn("split", F.lit(name)) for name, part in parts.items()],
    )


@query(3)
def forecast_sink(spark, sf_dir):
    path = staged_path(spark, "by-key")
    tables.save_by_key(closed_run(spark, sf_dir)["forecasts"], path)
    return spark.read.parquet(path).select("state", "date", "forecast", "model_used", "state_slug")


@query()
def selection_reports(spark, sf_dir):
    """The leaderboard as its report file says it."""
    scores, folder = closed_metrics(spark, sf_dir), staged_path(spark, "reports")
    board = metrics.leaderboard(scores)
    reports = {"leaderboard": board, "selection": closed_selection(scores), "all_metrics": scores}
    tables.save_selection_tables(reports, folder)
    return spark.read.schema(board.schema).csv(f"{folder}/leaderboard", header=True)


@query()
def all_metrics(spark, sf_dir):
    scores = closed_metrics(spark, sf_dir)
    folder = staged_path(spark, "metrics-by-family")
    for family in training.CLOSED_FAMILIES:
        part = scores.filter(F.col("model") == family)
        if family.endswith("naive"):
            part = part.drop("n_train")
        tables.save_metrics(part, folder, family)
    return tables.load_all_metrics(spark, folder, training.FAMILIES)


@query(None)
def model_roundtrip(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    path = staged_path(spark, "model")
    PooledTrees().fit(rows).save(path)
    return PooledTrees.load(spark, path).predict_onestep(rows.filter("split = 'val'"))


# Records ---------------------------------------------------------------------------


@query()
def parse_mixed_dates(spark, sf_dir):
    return panel.parse_dates(star(spark, sf_dir).order_records()).drop("category")


@query(None)
def parse_text_dates(spark, sf_dir):
    """Dates written out in six layouts, with month names and without separators."""
    orders = star(spark, sf_dir).table("orders")
    layouts = ["d-MMM-yyyy", "MMM d, yyyy", "d MMMM yyyy", "yyyyMMdd", "yyyy-M-d", "MMMM d yyyy"]
    pick = F.lit(None).cast("string")
    for i, layout in enumerate(layouts):
        day = F.date_format("o_orderdate", layout)
        pick = F.when(F.col("o_orderkey") % len(layouts) == i, day).otherwise(pick)
    return orders.select("o_orderkey", parse_mixed_date(pick).alias("date"))


@query(None)
def ingest_report(spark, sf_dir):
    return ingestion.ingest_report(star(spark, sf_dir).order_records(), "seq")


@query(None)
def date_quality(spark, sf_dir):
    return panel.date_quality(star(spark, sf_dir).order_records())


@query()
def drop_constant_col(spark, sf_dir):
    return panel.drop_constant_column(star(spark, sf_dir).order_records(), "category")


@query()
def dedupe_last(spark, sf_dir):
    rows = panel.parse_dates(star(spark, sf_dir).order_records()).drop("category")
    return panel.dedupe_last(rows, "seq")


@query(None)
def duplicate_count(spark, sf_dir):
    return panel.duplicate_count(panel.parse_dates(star(spark, sf_dir).order_records()))


@query(None)
def quality_counts(spark, sf_dir):
    # Order balance against account balance: a target with real negatives and nulls.
    customers = star(spark, sf_dir).table("customer")
    orders = star(spark, sf_dir).table("orders").select("o_custkey", "o_totalprice")
    rows = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_name").alias("state"),
        F.lit(None).cast("date").alias("date"),
        F.when(F.col("o_totalprice").isNotNull(), F.col("c_acctbal")).alias("sales"),
    )
    return panel.quality_counts(rows)


@query(None)
def snap_week(spark, sf_dir):
    orders = star(spark, sf_dir).table("orders")
    day = F.col("o_orderdate").cast("date")
    return orders.select("o_orderkey", day.alias("date"), week_ending(day).alias("week"))


@query(None)
def validate_raw(spark, sf_dir):
    records = star(spark, sf_dir).order_records()
    return spark.createDataFrame([guards.validate_raw(records)])


# Panel -----------------------------------------------------------------------------


@query()
def weekly_mean(spark, sf_dir):
    return panel.weekly_mean(star(spark, sf_dir).daily_sales())


@query()
def weekly_grid(spark, sf_dir):
    return weekly(spark, sf_dir).grid()


@query()
def impute_weekly(spark, sf_dir):
    return weekly(spark, sf_dir).panel()


@query()
def impute_segments(spark, sf_dir):
    records = star(spark, sf_dir).daily_sales("c_mktsegment")
    records = records.withColumnRenamed("c_mktsegment", "segment")
    return ingestion.weekly_table(records, SEGMENTS).panel()


@query()
def missing_report(spark, sf_dir):
    return weekly(spark, sf_dir).missing()


@query(None)
def panel_summary(spark, sf_dir):
    return panel.panel_summary(weekly(spark, sf_dir).panel())


@query(None)
def gap_check(spark, sf_dir):
    return panel.gap_check(weekly(spark, sf_dir).cells)


@query()
def run_ingestion(spark, sf_dir):
    return ingestion.run_ingestion(star(spark, sf_dir).order_records(), "seq")


@query(None)
def validate_panel(spark, sf_dir):
    row = guards.validate_panel(stored_panel(spark, sf_dir))
    return spark.createDataFrame([row])


# Features --------------------------------------------------------------------------


@query(None)
def calendar_features(spark, sf_dir):
    return features.add_calendar(weekly(spark, sf_dir).panel().select("state", "date"))


@query(6)
def cyclical_features(spark, sf_dir):
    return features.add_cyclical(weekly(spark, sf_dir).panel().select("state", "date"))


@query(None)
def holiday_flag(spark, sf_dir):
    return features.add_holiday_flag(weekly(spark, sf_dir).panel().select("state", "date"))


@query()
def lag_features(spark, sf_dir):
    return features.add_lags(weekly(spark, sf_dir).panel())


@query()
def rolling_features(spark, sf_dir):
    return features.add_rolling(weekly(spark, sf_dir).panel())


@query()
def expanding_mean(spark, sf_dir):
    rows = features.add_derived(weekly(spark, sf_dir).panel())
    return rows.select("state", "date", "state_expanding_mean")


@query(6)
def pct_change(spark, sf_dir):
    rows = features.add_derived(weekly(spark, sf_dir).panel())
    return rows.select("state", "date", "pct_change_1")


@query(None)
def week_index(spark, sf_dir):
    table = weekly(spark, sf_dir)
    return features.add_week_index(table.panel().select("state", "date"), origin=table.origin)


@query()
def build_features(spark, sf_dir):
    return weekly(spark, sf_dir).features()


@query()
def feature_subset(spark, sf_dir):
    wide = weekly(spark, sf_dir).features()
    return wide.select("state", "date", *features.SEQUENCE_FEATURES)


@query()
def complete_cases(spark, sf_dir):
    return features.complete_cases(weekly(spark, sf_dir).features(), features.ALL_FEATURES)


@query(None)
def dropped_count(spark, sf_dir):
    return features.dropped_count(weekly(spark, sf_dir).features(), features.ALL_FEATURES)


@query(None)
def feature_null_counts(spark, sf_dir):
    return features.feature_null_counts(weekly(spark, sf_dir).features())


@query(None)
def encode_state(spark, sf_dir):
    return encode.encode_keys(weekly(spark, sf_dir).cells)


@query(None)
def state_slug(spark, sf_dir):
    parts = star(spark, sf_dir).table("part").select("p_partkey", "p_type", "p_name")
    return parts.withColumn("slug", slug(F.concat_ws(" ", "p_type", "p_name")))


@query(3)
def recursive_features_query(spark, sf_dir):
    table = weekly(spark, sf_dir)
    return recursive_features(table.panel(), origin=table.origin)


QUERIES["recursive_features"] = QUERIES.pop("recursive_features_query")


# Splits, scaling, sequences --------------------------------------------------------


@query()
def temporal_split(spark, sf_dir):
    parts = split.temporal_split(stored_panel(spark, sf_dir), VAL_START, TEST_START)
    return reduce(
        lambda a, b: a.unionByName(b),
        [part.withColumn("split", F.lit(name)) for name, part in parts.items()],
    )


@query(None)
def split_summary(spark, sf_dir):
    return split.split_summary(labelled(spark, sf_dir))


@query(None)
def missing_states(spark, sf_dir):
    spec = PanelSpec(("o_custkey",), "o_orderdate", "o_totalprice")
    orders = star(spark, sf_dir).table("orders")
    parts = split.temporal_split(orders, VAL_START, TEST_START, spec)
    return split.missing_series(parts["train"], parts["val"], spec)


@query()
def state_series(spark, sf_dir):
    return split.one_series(weekly(spark, sf_dir).panel(), state=ONE_STATE)


@query()
def series_ds_y(spark, sf_dir):
    return split.as_ds_y(split.one_series(weekly(spark, sf_dir).panel(), state=ONE_STATE))


@query()
def history_tail(spark, sf_dir):
    return split.history_tail(weekly(spark, sf_dir).panel())


@query(None)
def validate_splits(spark, sf_dir):
    parts = split.temporal_split(stored_panel(spark, sf_dir), VAL_START, TEST_START)
    row = guards.validate_splits(parts["train"], parts["val"], parts["test"])
    return spark.createDataFrame([row])


@query()
def scaler_fit(spark, sf_dir):
    train = stored_features(spark, sf_dir).filter("split = 'train'")
    per_series = scale.fit_target(train).select(
        F.lit("target").alias("kind"), F.col("state").alias("name"), "lo", "hi"
    )
    ranges = scale.feature_ranges(scale.fit_features(train, features.SEQUENCE_FEATURES))
    return per_series.unionByName(
        ranges.select(F.lit("feature").alias("kind"), F.col("feature").alias("name"), "lo", "hi")
    )


@query(6)
def scale_target(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    stats = scale.fit_target(rows.filter("split = 'train'"))
    return scale.scale_target(rows, stats).select("state", "date", "target_scaled")


@query()
def scale_inverse(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    stats = scale.fit_target(rows.filter("split = 'train'"))
    scaled = scale.scale_target(rows, stats)
    back = scale.unscale_target(scaled, stats, "target_scaled", "restored")
    return back.select("state", "date", "restored")


@query(6)
def scale_features(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    fitted = scale.fit_features(rows.filter("split = 'train'"), features.SEQUENCE_FEATURES)
    scaled = scale.scale_features(rows, fitted, features.SEQUENCE_FEATURES)
    return scaled.select("state", "date", *features.SEQUENCE_FEATURES)


@query(5)
def sequence_windows(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    train = rows.filter("split = 'train'")
    names = features.SEQUENCE_FEATURES
    windows = sequence.sequence_windows(
        rows, scale.fit_target(train), scale.fit_features(train, names)
    )
    steps = windows.select("state", "date", "target_scaled", F.posexplode("seq").alias("pos", "v"))
    return steps.select(
        "state",
        "date",
        "target_scaled",
        "pos",
        *[F.col("v")[i].alias(c) for i, c in enumerate(names)],
    )


@query(5)
def build_datasets(spark, sf_dir):
    """Every value of the matrix and of all windows; the matrix's money in units of 100,000."""
    data = ingestion.build_datasets(weekly(spark, sf_dir).features(), VAL_START, TEST_START)
    names = features.SEQUENCE_FEATURES
    money = {*features.LAG_FEATURES, *features.ROLLING_FEATURES, "state_expanding_mean"}
    shown = {c: F.col(c).cast("double") / (1e5 if c in money else 1) for c in features.ALL_FEATURES}
    head = ["split", "state", "date"]
    matrix = data.matrix.select(
        F.lit("matrix").alias("kind"),
        *head,
        F.lit(0).alias("pos"),
        (F.col("sales").cast("double") / 1e5).alias("label"),
        *[v.alias(c) for c, v in shown.items()],
    )
    steps = data.sequences.select(*head, "target_scaled", F.posexplode("seq").alias("pos", "v"))
    windows = steps.select(
        F.lit("sequence").alias("kind"),
        *head,
        "pos",
        F.col("target_scaled").cast("double").alias("label"),
        *[F.col("v")[i].cast("double").alias(c) for i, c in enumerate(names)],
    )
    return matrix.unionByName(windows, allowMissingColumns=True)


# Baselines and closed-form models --------------------------------------------------


@query()
def naive_forecast(spark, sf_dir):
    return baselines.naive_forecast(weekly(spark, sf_dir).panel())


@query()
def seasonal_naive(spark, sf_dir):
    rows = baselines.baseline_forecasts(labelled(spark, sf_dir))
    return rows.filter("model = 'seasonal_naive'").drop("model")


@query(None)
def future_dates(spark, sf_dir):
    last = baselines.last_observed(weekly(spark, sf_dir).panel()).select("state", "date")
    return horizon.future_dates(last, 8)


@query()
def baseline_metrics(spark, sf_dir):
    return baselines.baseline_metrics(labelled(spark, sf_dir))


@query(3)
def seasonal_ar(spark, sf_dir):
    return closed_form.seasonal_ar(weekly(spark, sf_dir).panel())


@query(3)
def decomposition(spark, sf_dir):
    return closed_form.decomposition(weekly(spark, sf_dir).panel())


@query(3)
def decomposition_stored(spark, sf_dir):
    """Coefficients saved, loaded, and asked for the weeks to come."""
    history = stored_panel(spark, sf_dir)
    fitted = stage(closed_form.decomposition_coefficients(history), "coefficients")
    ahead = horizon.extend(history, FORECAST_WEEKS).filter("step > 0")
    return closed_form.decomposition_predict(fitted, ahead)


@query(3)
def insample_fit(spark, sf_dir):
    train = labelled(spark, sf_dir).filter("split = 'train'").drop("split")
    both = closed_form.seasonal_ar_insample(train).unionByName(
        closed_form.decomposition_insample(train)
    )
    return both.filter("fitted is not null").select("state", "date", "model", "fitted")


@query(3)
def custom_model(spark, sf_dir):
    rows = weekly(spark, sf_dir).panel()
    return custom.fit_predict_each(rows, mean_model(), "mean").drop("error")


def mean_model() -> type:
    """A user's model of one series: its mean. Made here, so that it travels by value."""

    class MeanModel:
        def fit(self, history):
            self.mean = history["sales"].mean()
            return self

        def predict(self, horizon):
            return [self.mean] * horizon

        def predict_insample(self, history):
            return [self.mean] * len(history)

        def dump(self):
            return repr(float(self.mean)).encode()

        @classmethod
        def load(cls, data):
            out = cls()
            out.mean = float(data)
            return out

    return MeanModel


@query(3)
def custom_model_stored(spark, sf_dir):
    """Fitted series by series, saved, loaded, and only then asked for forecasts."""
    model, path = mean_model(), staged_path(spark, "custom")
    custom.save_models(custom.fit_each(weekly(spark, sf_dir).panel(), model, "mean"), path)
    return custom.predict_each(custom.load_models(spark, path), model.load).drop("error")


@query(3)
def custom_insample(spark, sf_dir):
    """In-sample values of stored models beside the histories they were fitted on."""
    model, rows = mean_model(), stored_panel(spark, sf_dir)
    fitted = stage(custom.fit_each(rows, model, "mean"), "custom")
    return custom.insample_each(fitted, rows, model.load).drop("error")


# Metrics and selection -------------------------------------------------------------


@query()
def forecast_metrics(spark, sf_dir):
    return closed_metrics(spark, sf_dir)


@query(3)
def joined_eval(spark, sf_dir):
    """Forecasts beside the actual values of the same series and week."""
    ev = cut(spark, sf_dir)
    return metrics.align(ev.closed_forecasts(), ev.val)


@query(3)
def align_eval(spark, sf_dir):
    ev = cut(spark, sf_dir)
    return metrics.align_by_position(ev.closed_forecasts(), ev.val)


@query()
def mase(spark, sf_dir):
    return metrics.mase_scale(labelled(spark, sf_dir).filter("split = 'train'"))


@query(None)
def leaderboard(spark, sf_dir):
    return metrics.leaderboard(closed_metrics(spark, sf_dir))


@query()
def model_comparison(spark, sf_dir):
    return metrics.model_comparison(closed_metrics(spark, sf_dir))


@query()
def baseline_summary(spark, sf_dir):
    return metrics.baseline_summary(
        stage(baselines.baseline_metrics(labelled(spark, sf_dir)), "baseline-metrics")
    )


@query()
def improvement(spark, sf_dir):
    scores = closed_metrics(spark, sf_dir)
    board = metrics.baseline_summary(scores)
    return metrics.improvement(board, board)


@query()
def select_best(spark, sf_dir):
    return closed_selection(closed_metrics(spark, sf_dir))


@query(None)
def winner_counts(spark, sf_dir):
    return selection.winner_counts(closed_selection(closed_metrics(spark, sf_dir)))


@query(None)
def state_comparison(spark, sf_dir):
    return selection.state_comparison(closed_metrics(spark, sf_dir), training.CLOSED_FAMILIES)


@query(None)
def worst_states(spark, sf_dir):
    return selection.worst_states(closed_metrics(spark, sf_dir), training.CLOSED_FAMILIES)


@query()
def spread_states(spark, sf_dir):
    rows = selection.spread_states(closed_metrics(spark, sf_dir))
    return rows.select("state", "model", "smape")


@query(6)
def ensemble_weights(spark, sf_dir):
    chosen = closed_selection(closed_metrics(spark, sf_dir))
    best, second = selection.ensemble_weights(F.col("best_smape"), F.col("second_smape"))
    return chosen.select("state", best.alias("w_best"), second.alias("w_second"))


@query(3)
def ensemble_blend(spark, sf_dir):
    run = closed_run(spark, sf_dir)
    return ensemble.blend(run["candidates"], run["selection"])


@query(None)
def not_forecast(spark, sf_dir):
    """Selected series without a forecast, after some of their candidates are taken away."""
    run = closed_run(spark, sf_dir)
    chosen = run["selection"].select("state", "best_model", "second_model")
    ends = lambda digit: F.col("state").endswith(digit)
    wanted = F.col("model").isin(F.col("best_model"), F.col("second_model"))
    left = run["candidates"].join(chosen, "state").filter(~ends("1") & ~(ends("2") & wanted))
    return ensemble.not_forecast(left.drop("best_model", "second_model"), run["selection"])


@query(None)
def ensemble_validation(spark, sf_dir):
    ev = cut(spark, sf_dir)
    candidates = stage(ev.closed_forecasts(), "candidates")
    chosen = closed_selection(ev.metrics(candidates))
    return ensemble.ensemble_validation(candidates, chosen, ev.val)


@query(3)
def ensemble_summary(spark, sf_dir):
    ev = cut(spark, sf_dir)
    candidates = stage(ev.closed_forecasts(), "candidates")
    chosen = closed_selection(ev.metrics(candidates))
    return ensemble.ensemble_summary(ensemble.ensemble_validation(candidates, chosen, ev.val))


@query(3)
def final_forecast(spark, sf_dir):
    return closed_run(spark, sf_dir)["forecasts"]


@query(None)
def model_usage(spark, sf_dir):
    return selection.model_usage(closed_run(spark, sf_dir)["forecasts"])


# Backtest --------------------------------------------------------------------------


@query(None)
def backtest_folds(spark, sf_dir):
    return backtest.backtest_folds(stored_panel(spark, sf_dir))


@query()
def fold_rows(spark, sf_dir):
    rows = stored_panel(spark, sf_dir)
    return backtest.fold_rows(rows, backtest.backtest_folds(rows))


@query()
def backtest_closed(spark, sf_dir):
    return training.backtest_closed(stored_panel(spark, sf_dir))


@query()
def backtest_by_fold(spark, sf_dir):
    scores = stage(training.backtest_closed(stored_panel(spark, sf_dir)), "backtest")
    return backtest.backtest_by_fold(scores)


@query()
def backtest_summary(spark, sf_dir):
    scores = stage(training.backtest_closed(stored_panel(spark, sf_dir)), "backtest")
    return backtest.backtest_summary(scores)


@query(None)
def backtest_gbt(spark, sf_dir):
    return training.backtest_trained(stored_panel(spark, sf_dir))


# Trained models --------------------------------------------------------------------


@query(None)
def gbt_fit(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    fitted = PooledTrees().fit(rows)
    return fitted.predict_onestep(rows.filter("split <> 'train'"))


@query(None)
def onestep_eval(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    val = rows.filter("split = 'val'")
    fitted = PooledTrees().fit(rows)
    return metrics.forecast_metrics(fitted.predict_onestep(val), val)


@query(None)
def feature_importance(spark, sf_dir):
    return PooledTrees().fit(stored_features(spark, sf_dir)).feature_importance(spark)


@query(None)
def recursive_gbt(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    fitted = PooledTrees().fit(rows)
    return fitted.predict_recursive(rows.select("state", "date", "sales"))


#: Feature pairs of the trees whose splits need no search.
TREE_PAIRS = [("roll_mean_13", "lag_52"), ("lag_1", "week_of_year"), ("roll_mean_4", "lag_7")]


def mean_trees(rows: DataFrame) -> PooledTrees:
    """Trees that split at feature means, fitted on the complete train rows."""
    train = rows.filter("split = 'train'")
    codes = stage(encode.encode_keys(train, ("state",)), "codes")
    usable = stage(features.complete_cases(train, features.ALL_FEATURES), "tree-rows")
    return PooledTrees.of_nodes(treetable.mean_split_trees(usable, TREE_PAIRS, "sales"), codes)


@query()
def tree_table(spark, sf_dir):
    """The nodes of a model after saving and loading."""
    path = staged_path(spark, "tree-table")
    mean_trees(stored_features(spark, sf_dir)).save(path)
    nodes = PooledTrees.load(spark, path).nodes
    sides = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("left", "right")]
    return nodes.select("tree", "node", "feature", "threshold", *sides, "value")


@query()
def tree_table_onestep(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    path = staged_path(spark, "tree-table")
    mean_trees(rows).save(path)
    loaded = PooledTrees.load(spark, path)
    return loaded.predict_onestep(rows.filter("split = 'val'")).drop("model")


@query()
def tree_table_recursive(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    return mean_trees(rows).predict_recursive(rows.select("state", "date", "sales")).drop("model")


@query(None)
def gbt_table_check(spark, sf_dir):
    """Does the saved node table predict what the fitted model predicts?"""
    rows = stored_features(spark, sf_dir)
    path = staged_path(spark, "model")
    fitted = PooledTrees().fit(rows)
    fitted.save(path)
    want = fitted.predict_onestep(rows.filter("split <> 'train'"))
    got = PooledTrees.load(spark, path).predict_onestep(rows.filter("split <> 'train'"))
    both = want.join(got.withColumnRenamed("forecast", "other"), ["state", "date", "model"])
    close = F.abs(F.col("forecast") - F.col("other")) <= 1e-9 * F.abs("forecast")
    return both.select("state", "date", close.alias("agrees"))


@query(None)
def seq_linear(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    fitted = SequenceRegression().fit(rows)
    return metrics.forecast_metrics(
        fitted.predict_onestep(rows), rows.filter("split = 'val'"), rows.filter("split = 'train'")
    )


@query(None)
def recursive_seq(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    fitted = SequenceRegression().fit(rows)
    return fitted.predict_recursive(rows.select("state", "date", "sales"))


@query(None)
def evaluate_models(spark, sf_dir):
    rows = stored_features(spark, sf_dir)
    ev = training.evaluation(rows, VAL_START, TEST_START)
    models = training.fit_trained(rows)
    forecasts = ev.closed_forecasts().unionByName(ev.trained_forecasts(models))
    return ev.metrics(stage(forecasts, "candidates"))


@query(None)
def final_forecast_all(spark, sf_dir):
    run = training.select_and_forecast(
        stored_panel(spark, sf_dir), VAL_START, TEST_START, with_trained=True
    )
    return run["forecasts"]


# Lookups ---------------------------------------------------------------------------


@query(None)
def serving_inputs(spark, sf_dir):
    """The tables that lookups need: are they there, and how many rows do they have?"""
    run, folder = closed_run(spark, sf_dir), staged_path(spark, "inputs")
    for name in ("forecasts", "selection", "metrics"):
        run[name].write.parquet(f"{folder}/{name}")
    paths = {n: f"{folder}/{n}" for n in ("forecasts", "selection", "metrics", "leaderboard")}
    absent = guards.missing_tables(paths, spark)
    rows = [
        spark.read.parquet(path).agg(
            F.lit(name).alias("name"), F.lit(True).alias("present"), F.count("*").alias("n_rows")
        )
        for name, path in paths.items()
        if name not in absent
    ]
    none = [(n, False, 0) for n in absent]
    rows.append(spark.createDataFrame(none, "name string, present boolean, n_rows long"))
    return reduce(lambda a, b: a.unionByName(b), rows)


@query(None)
def serve_states(spark, sf_dir):
    return store(spark, sf_dir).states()


@query(3)
def lookup_ci(spark, sf_dir):
    return store(spark, sf_dir).forecast(LOOKUP_TEXT)


@query(3)
def forecast_for_state(spark, sf_dir):
    one = store(spark, sf_dir).forecast_response(LOOKUP_TEXT)
    return one.select("state", "horizon_weeks", F.inline("forecasts"))


@query(3)
def all_forecasts(spark, sf_dir):
    nested = store(spark, sf_dir).all_forecasts()
    return nested.select("state", "horizon_weeks", F.inline("forecasts"))


@query()
def model_info(spark, sf_dir):
    nested = store(spark, sf_dir).model_info()
    return nested.select(
        "state",
        "best_model",
        "best_smape",
        "best_mae",
        "second_model",
        "ensemble_eligible",
        F.size("all_models").alias("n_models"),
        F.inline("all_models"),
    )


@query(None)
def leaderboard_wins(spark, sf_dir):
    return store(spark, sf_dir).leaderboard_wins()
