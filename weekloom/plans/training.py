"""Validation forecasts, metrics, backtests and final forecasts over model families."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from weekloom.models.gbt import PooledTrees
from weekloom.models.seqlinear import SequenceRegression
from weekloom.operators.backtest import backtest_folds, fold_rows
from weekloom.operators.baselines import (
    baseline_forecasts,
    naive_forecast,
    seasonal_naive_forecast,
)
from weekloom.operators.closed_form import decomposition, seasonal_ar
from weekloom.operators.ensemble import final_forecast
from weekloom.operators.features import build_features
from weekloom.operators.metrics import forecast_metrics
from weekloom.operators.selection import select_best
from weekloom.operators.split import saturdays_between, temporal_split, with_split
from weekloom.sources.staging import stage
from weekloom.spec import BACKTEST_WEEKS, DEFAULT, FORECAST_WEEKS, PanelSpec

# Model families in load order, which settles ties.
CLOSED_FAMILIES = ("naive", "seasonal_naive", "seasonal_ar", "decomposition")
TRAINED_FAMILIES = ("gbt", "seq_linear")
FAMILIES = CLOSED_FAMILIES + TRAINED_FAMILIES
#: Folds of a backtest whose fits run side by side.
FOLDS_AT_ONCE = 3


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


@dataclass
class TrainedModels:
    """The pooled families, fitted once on the train rows and used for every horizon."""

    trees: PooledTrees
    linear: SequenceRegression
    spec: PanelSpec = DEFAULT
    origin: Column | None = None

    def forecasts(
        self, history: DataFrame, horizon: int, selection: DataFrame | None = None
    ) -> DataFrame:
        """Both families' forecasts; with ``selection`` only those of series that chose them."""
        rows = history.select(*self.spec.columns)
        origin = self.origin
        if selection is not None and origin is None:
            origin = rows.agg(F.min(self.spec.time)).scalar()  # of all series, chosen or not
        models = zip(TRAINED_FAMILIES, (self.trees, self.linear), strict=True)
        return _union(
            [
                m.predict_recursive(chosen(rows, selection, (name,), self.spec), horizon, origin)
                for name, m in models
            ]
        )


def chosen(
    history: DataFrame, selection: DataFrame | None, families: tuple[str, ...], spec: PanelSpec
) -> DataFrame:
    """The series whose best or second model is one of ``families``; all without selection.

    A semi join on one row a series, whose keys a stored selection offers as a runtime
    filter to the scan: a family is computed for the series that use it, not for all.
    """
    if selection is None:
        return history
    named = F.col("best_model").isin(*families) | F.col("second_model").isin(*families)
    return history.join(selection.filter(named).select(*spec.keys), list(spec.keys), "left_semi")


def fit_trained(
    features: DataFrame,
    spec: PanelSpec = DEFAULT,
    origin: Column | None = None,
    tree_params: dict | None = None,
) -> TrainedModels:
    """Fit both pooled families on a stored feature table with a ``split`` column."""
    trees = PooledTrees(spec, **(tree_params or {})).fit(features)
    return TrainedModels(trees, SequenceRegression(spec).fit(features), spec, origin)


@dataclass
class Evaluation:
    """A panel cut by date, ready for scoring.

    Train and val are date filters on the panel itself, which reach the scan of a
    stored panel; a filter on the derived label would not.
    """

    panel: DataFrame
    val_start: str
    test_start: str
    spec: PanelSpec = DEFAULT

    @property
    def horizon(self) -> int:
        return saturdays_between(self.val_start, self.test_start)

    @property
    def train(self) -> DataFrame:
        return temporal_split(self.panel, self.val_start, self.test_start, self.spec)["train"]

    @property
    def val(self) -> DataFrame:
        return temporal_split(self.panel, self.val_start, self.test_start, self.spec)["val"]

    def closed_forecasts(self) -> DataFrame:
        """Long validation forecasts of the families that need no training loop."""
        day = F.col(self.spec.time)
        rows = self.panel.filter(day < F.lit(self.test_start).cast("date"))
        labelled = with_split(rows, self.val_start, self.test_start, self.spec)
        return closed_forecasts(labelled, self.train, self.horizon, self.spec)

    def trained_forecasts(self, models: TrainedModels) -> DataFrame:
        """Long validation forecasts of the pooled families, recursive from the train end."""
        return models.forecasts(self.train, self.horizon)

    def metrics(self, forecasts: DataFrame) -> DataFrame:
        return forecast_metrics(forecasts, self.val, self.train, spec=self.spec)


def evaluation(
    panel: DataFrame, val_start: str, test_start: str, spec: PanelSpec = DEFAULT
) -> Evaluation:
    return Evaluation(panel.select(*spec.columns), val_start, test_start, spec)


def closed_forecasts(
    labelled: DataFrame, train: DataFrame, horizon: int, spec: PanelSpec = DEFAULT
) -> DataFrame:
    """Every closed-form family on the val rows of a panel with a ``split`` column."""
    history = train.select(*spec.columns)
    return _union(
        [
            baseline_forecasts(labelled, spec),
            seasonal_ar(history, horizon, spec),
            decomposition(history, horizon, spec),
        ]
    )


def future_candidates(
    history: DataFrame,
    horizon: int = FORECAST_WEEKS,
    spec: PanelSpec = DEFAULT,
    selection: DataFrame | None = None,
) -> DataFrame:
    """Every closed-form family beyond the end of ``history``.

    With ``selection`` a family forecasts only the series that chose it, first or second.
    """
    rows = history.select(*spec.columns)
    makers = (naive_forecast, seasonal_naive_forecast, seasonal_ar, decomposition)
    return _union(
        [
            make(chosen(rows, selection, (name,), spec), horizon, spec)
            for name, make in zip(CLOSED_FAMILIES, makers, strict=True)
        ]
    )


def generate_forecasts(
    selection: DataFrame,
    history: DataFrame,
    horizon: int = FORECAST_WEEKS,
    use_ensemble: bool = True,
    extra: list[DataFrame] | None = None,
    spec: PanelSpec = DEFAULT,
) -> DataFrame:
    """Final forecasts of the selected models; ``extra`` adds trained candidates."""
    candidates = _union([future_candidates(history, horizon, spec, selection), *(extra or [])])
    return final_forecast(candidates, selection, use_ensemble, spec)


def backtest_closed(panel: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Metrics of the closed-form families per series, model and fold.

    The fold is one more series key: all folds of all series are one query. The fold rows
    are stored once, since every family reads them.
    """
    rows = stage(fold_rows(panel, backtest_folds(panel, spec=spec), spec), "folds")
    inner = PanelSpec(("fold", *spec.keys), spec.time, spec.target)
    train = rows.filter(F.col("split") == "train")
    val = rows.filter(F.col("split") == "val")
    forecasts = closed_forecasts(rows, train, BACKTEST_WEEKS, inner)
    return forecast_metrics(forecasts, val, train, spec=inner)


def backtest_trained(
    panel: DataFrame,
    spec: PanelSpec = DEFAULT,
    origin: Column | None = None,
    tree_params: dict | None = None,
) -> DataFrame:
    """Metrics of the pooled families per series, model and fold.

    Only the few folds are handled one by one, ``FOLDS_AT_ONCE`` of them together: their
    fits are jobs of the same application that share its executors, since a fit alone is a
    row of small jobs. Within a fold everything is distributed. Features look backwards
    only, so one stored feature table serves all folds. Boosting stops on the last weeks
    before a fold, never on the weeks that the fold scores.
    """
    origin = panel.agg(F.min(spec.time)).scalar() if origin is None else origin
    features = stage(build_features(panel, spec, origin), "features")

    def one_fold(fold: Row) -> DataFrame:
        start, end = str(fold.train_end), str(fold.val_end)
        upto = features.filter(F.col(spec.time) < F.lit(fold.val_end))
        stop = str(fold.train_end - timedelta(weeks=BACKTEST_WEEKS))
        rows = with_split(upto, stop, start, spec)
        cut = evaluation(upto, start, end, spec)
        models = fit_trained(rows, spec, origin, tree_params)
        scored = stage(cut.metrics(cut.trained_forecasts(models)), "fold")
        return scored.withColumn("fold", F.lit(fold.fold))

    folds = backtest_folds(panel, spec=spec).orderBy("fold").collect()
    with ThreadPoolExecutor(FOLDS_AT_ONCE) as pool:
        return _union(list(pool.map(inheritable_thread_target(one_fold), folds)))


def select_and_forecast(
    panel: DataFrame,
    val_start: str,
    test_start: str,
    horizon: int = FORECAST_WEEKS,
    use_ensemble: bool = True,
    with_trained: bool = False,
    spec: PanelSpec = DEFAULT,
    tree_params: dict | None = None,
) -> dict[str, DataFrame]:
    """Metrics, selection and final forecasts of one panel, stored between the stages."""
    cut = evaluation(panel, val_start, test_start, spec)
    families = list(CLOSED_FAMILIES)
    candidates = cut.closed_forecasts()
    extra = []
    if with_trained:
        families += TRAINED_FAMILIES
        features = build_features(panel, spec)
        features = stage(with_split(features, val_start, test_start, spec), "features")
        models = fit_trained(features, spec, tree_params=tree_params)
        candidates = candidates.unionByName(cut.trained_forecasts(models))
    candidates = stage(candidates, "candidates")
    metrics = stage(cut.metrics(candidates), "metrics")
    selection = stage(select_best(metrics, families, spec), "selection")
    if with_trained:
        extra.append(models.forecasts(panel, horizon, selection))
    forecasts = generate_forecasts(selection, panel, horizon, use_ensemble, extra, spec)
    return {
        "candidates": candidates,
        "metrics": metrics,
        "selection": selection,
        "forecasts": forecasts,
    }
