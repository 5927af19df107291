from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import PANEL_SCHEMA
from weekloom.functions.calendar import holiday_week
from weekloom.functions.arrays import bound
from weekloom.models import treetable
from weekloom.models.gbt import PooledTrees
from weekloom.models.seqlinear import SequenceRegression
from weekloom.operators import baselines, closed_form, custom
from weekloom.operators.custom import fit_predict_each
from weekloom.operators.ensemble import final_forecast
from weekloom.operators.features import SEQUENCE_FEATURES, TREE_FEATURES, build_features
from weekloom.operators.split import with_split
from weekloom.plans import training
from weekloom.sources.staging import stage

VAL, TEST = "2020-09-26", "2021-04-24"
FIRST = date(2019, 1, 5)


@pytest.fixture(scope="module")
def featured(tiny_panel):
    df = with_split(build_features(tiny_panel), VAL, TEST).cache()
    df.count()
    return df


@pytest.fixture(scope="module")
def trees(featured):
    return PooledTrees(maxIter=5, maxDepth=3, stepSize=0.3, minInstancesPerNode=3).fit(featured)


@pytest.fixture(scope="module")
def linear(featured):
    return SequenceRegression().fit(featured)


def one(spark, values, start=FIRST):
    rows = [("A", start + timedelta(weeks=i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, PANEL_SCHEMA)


def ar_by_hand(y, horizon, season=52):
    lag = season if len(y) >= 2 * season else 1
    d = y[lag:] - y[:-lag]
    b = np.cov(d[:-1], d[1:], bias=True)[0, 1] / d[:-1].var()
    a = d[1:].mean() - b * d[:-1].mean()
    path, last = list(y), d[-1]
    for _ in range(horizon):
        last = a + b * last
        path.append(path[-lag] + last)
    return path[len(y) :]


@pytest.mark.parametrize(("n", "horizon"), [(110, 8), (110, 60), (60, 8), (20, 3)])
def test_seasonal_ar_equals_stepwise_recursion(spark, n, horizon):
    rng = np.random.default_rng(n)
    y = 500 + 50 * np.sin(np.arange(n) / 8) + rng.normal(0, 10, n)
    got = closed_form.seasonal_ar(one(spark, y), horizon).orderBy("date").collect()
    assert [r.forecast for r in got] == pytest.approx(ar_by_hand(y, horizon), rel=1e-9)
    assert got[0].date == FIRST + timedelta(weeks=n)


def test_seasonal_ar_gates(spark):
    assert closed_form.seasonal_ar(one(spark, range(19))).count() == 0
    assert closed_form.seasonal_ar(one(spark, [5.0] * 30)).count() == 0


def test_seasonal_ar_with_unit_slope(spark):
    fitted = spark.createDataFrame(
        [("A", FIRST, 30, 1, 1.0, 2.0, 3.0, [10.0])],
        "state string, date date, n_train long, lag int, slope double, intercept double, last_difference double, tail array<double>",
    )
    got = closed_form.seasonal_ar_predict(fitted, 3).orderBy("date").collect()
    assert [r.forecast for r in got] == [15.0, 22.0, 31.0]


def test_insample_equals_one_step_ahead(spark):
    y = 500 + np.random.default_rng(1).normal(0, 10, 60)
    got = closed_form.seasonal_ar_insample(one(spark, y)).orderBy("date").collect()
    d = np.diff(y)
    b = np.cov(d[:-1], d[1:], bias=True)[0, 1] / d[:-1].var()
    a = d[1:].mean() - b * d[:-1].mean()
    assert [r.fitted for r in got[2:]] == pytest.approx(list(y[1:-1] + a + b * d[:-1]), rel=1e-9)
    assert got[1].fitted is None


def test_decomposition_equals_pandas(spark):
    n, horizon = 120, 8
    t = np.arange(n + horizon)
    y = (300 + 2 * t[:n]) * (1 + 0.2 * np.sin(2 * np.pi * t[:n] / 52))
    days = [FIRST + timedelta(weeks=int(i)) for i in t]
    flags = spark.createDataFrame([(d,) for d in days], "date date")
    flags = flags.withColumn("flag", holiday_week(F.col("date"))).orderBy("date").collect()
    frame = pd.DataFrame({"t": t, "y": np.append(y, [np.nan] * horizon), "flag": [r.flag for r in flags]})
    frame["wk"] = [min(d.isocalendar()[1], 52) for d in days]
    slope, base = np.polyfit(t[:n], y, 1)
    frame["trend"] = base + slope * t
    frame["season"] = (frame.y / frame.trend).groupby(frame.wk).transform("mean").fillna(1)
    frame["hol"] = (frame.y / frame.trend / frame.season).groupby(frame.flag).transform("mean").fillna(1)
    want = (frame.trend * frame.season * frame.hol).tail(horizon).tolist()
    got = closed_form.decomposition(one(spark, y), horizon).orderBy("date").collect()
    assert [r.forecast for r in got] == pytest.approx(want, rel=1e-9)


def test_baselines(spark, tiny_panel):
    labelled = with_split(tiny_panel, VAL, TEST)
    rows = baselines.baseline_metrics(labelled).collect()
    assert {r.model for r in rows} == {"naive", "seasonal_naive"}
    assert all(r.smape is not None and r.n_val == 30 for r in rows)
    short = with_split(tiny_panel, "2019-10-05", "2019-12-07")
    assert {r.model for r in baselines.baseline_metrics(short).collect()} == {"naive"}
    future = baselines.seasonal_naive_forecast(one(spark, range(60)), 54).orderBy("date").collect()
    assert [future[i].forecast for i in (0, 51, 52, 53)] == [8.0, 59.0, 8.0, 9.0]
    naive = baselines.naive_forecast(one(spark, range(60)), 2).collect()
    assert {r.forecast for r in naive} == {59.0}


def test_trees_fit_predict_and_importance(spark, trees, featured):
    history = featured.filter("split = 'train'")
    got = trees.predict_recursive(history, 6).orderBy("state", "date").collect()
    assert len(got) == 12 and all(np.isfinite(r.forecast) for r in got)
    assert got[0].date == date.fromisoformat(VAL)
    imp = trees.feature_importance(spark).collect()
    assert len(imp) == len(TREE_FEATURES) and sum(r.importance for r in imp) > 0


def test_tree_recursion_equals_growing_the_panel(spark, trees, tiny_rows):
    """Each step: append the prediction, rebuild all features from scratch, predict again."""
    cut = date.fromisoformat(VAL)
    rows = [r for r in tiny_rows if r[1] < cut]
    want = []
    for step in range(3):
        day = cut + timedelta(weeks=step)
        grown = rows + [(s, day, None) for s in ("StateA", "StateB")]
        wide = build_features(spark.createDataFrame(grown, PANEL_SCHEMA))
        fresh = trees.predict_onestep(wide.filter(F.col("date") == F.lit(day))).collect()
        rows = rows + [(r.state, day, r.forecast) for r in fresh]
        want += [(r.state, day, r.forecast) for r in fresh]
    history = spark.createDataFrame([r for r in tiny_rows if r[1] < cut], PANEL_SCHEMA)
    got = {(r.state, r.date): r.forecast for r in trees.predict_recursive(history, 3).collect()}
    assert {(s, d): pytest.approx(v, rel=1e-9) for s, d, v in want} == got


def test_sequence_fold_equals_model_on_grown_panel(spark, linear, tiny_rows):
    cut = date.fromisoformat(VAL)
    rows = [r for r in tiny_rows if r[1] < cut]
    got = linear.predict_recursive(spark.createDataFrame(rows, PANEL_SCHEMA), 3)
    got = {(r.state, r.date): r.forecast for r in got.collect()}
    for step in range(3):
        day = cut + timedelta(weeks=step)
        grown = rows + [(s, day, 0.0) for s in ("StateA", "StateB")]
        wide = build_features(spark.createDataFrame(grown, PANEL_SCHEMA))
        fresh = linear.predict_onestep(wide).filter(F.col("date") == F.lit(day)).collect()
        for r in fresh:
            assert got[r.state, day] == pytest.approx(r.forecast, rel=1e-6)
            rows = rows + [(r.state, day, got[r.state, day])]
    assert len(got) == 6 and len(linear.model.coefficients) == 12 * len(SEQUENCE_FEATURES)


def test_models_survive_saving(spark, trees, linear, featured, tmp_path):
    history = featured.filter("split = 'train'")
    for model, cls in ((trees, PooledTrees), (linear, SequenceRegression)):
        path = str(tmp_path / cls.__name__)
        model.save(path)
        again = cls.load(spark, path)
        a = model.predict_recursive(history, 2).orderBy("state", "date").collect()
        assert a == again.predict_recursive(history, 2).orderBy("state", "date").collect()


def test_closed_coefficients_survive_saving(spark, tiny_panel, tmp_path):
    fitted = closed_form.seasonal_ar_fit(tiny_panel)
    fitted.write.parquet(str(tmp_path / "ar"))
    again = spark.read.parquet(str(tmp_path / "ar"))
    a = closed_form.seasonal_ar_predict(fitted, 4).orderBy("state", "date").collect()
    assert a == closed_form.seasonal_ar_predict(again, 4).orderBy("state", "date").collect()


def test_a_short_series_never_stops_the_run(spark, tiny_panel):
    short = one(spark, range(100, 110), date(2020, 9, 19)).withColumn("state", F.lit("Short"))
    ev = training.evaluation(tiny_panel.unionByName(short), VAL, TEST)
    rows = ev.metrics(ev.closed_forecasts()).collect()
    assert {r.model for r in rows if r.state == "Short"} == {"naive"}
    assert {r.model for r in rows if r.state == "StateA"} == set(training.CLOSED_FAMILIES)
    assert ev.horizon == 30


def test_backtest_has_every_fold_and_family(tiny_panel):
    rows = training.backtest_closed(tiny_panel).collect()
    assert {(r.fold, r.model) for r in rows} == {
        (k, m) for k in (1, 2, 3) for m in training.CLOSED_FAMILIES
    }
    assert all(r.n_val == 13 for r in rows)


def test_custom_model_isolates_failures(spark, tiny_panel):
    class Fussy:
        def fit(self, history):
            if history["sales"].mean() > 400:
                raise ValueError("too large")
            self.last = history["sales"].iloc[-1]
            return self

        def predict(self, horizon):
            return [self.last] * horizon

    rows = fit_predict_each(tiny_panel, Fussy, "fussy", 3).collect()
    good = [r for r in rows if r.state == "StateB"]
    bad = [r for r in rows if r.state == "StateA"]
    assert len(good) == 3 and all(r.error is None and r.forecast > 0 for r in good)
    assert len(bad) == 1 and "too large" in bad[0].error and bad[0].forecast is None


def test_node_table_predicts_as_the_fitted_trees(spark, trees, featured, tmp_path):
    trees.save(str(tmp_path / "trees"))
    table = PooledTrees.load(spark, str(tmp_path / "trees"))
    assert table.model is None and table.nodes.count() > 5
    rows = lambda m: m.predict_onestep(featured).orderBy("state", "date").collect()
    want, got = rows(trees), rows(table)
    assert [r.forecast for r in got] == pytest.approx([r.forecast for r in want], rel=1e-12)
    own = {r.feature: r.importance for r in table.feature_importance(spark).collect()}
    fitted = trees.model.featureImportances.toArray().tolist()
    assert own == {f: pytest.approx(v, abs=1e-12) for f, v in zip(TREE_FEATURES, fitted, strict=True)}


def test_recursion_is_one_projection_of_the_state(trees, featured):
    """All steps are one fold: the plan has no exchange beyond those of the state."""
    history = featured.filter("split = 'train'")
    plans = [
        trees.predict_recursive(history, h)._jdf.queryExecution().executedPlan().toString()
        for h in (1, 20)
    ]
    assert plans[0].count("Exchange") == plans[1].count("Exchange")


def test_mean_split_trees_by_hand(spark):
    rows = [(float(i), float(i % 3), 10.0 * i) for i in range(8)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    nodes = treetable.mean_split_trees(df, [("a", "b"), ("b", "a")], "y", rate=0.5)
    left = {i: r[2] for i, r in enumerate(rows)}
    total = dict.fromkeys(range(8), 0.0)
    cut = {"a": 3.5, "b": sum(r[1] for r in rows) / 8}
    for pair in (("a", "b"), ("b", "a")):
        place = {
            i: tuple({"a": r[0], "b": r[1]}[f] > cut[f] for f in pair) for i, r in enumerate(rows)
        }
        for leaf in set(place.values()):
            own = [i for i in place if place[i] == leaf]
            mean = 0.5 * sum(left[i] for i in own) / len(own)
            for i in own:
                total[i] += mean
                left[i] -= mean
    ensemble = treetable.packed(nodes, ["a", "b"])
    value = bound(ensemble, lambda e: treetable.walk(F.array("a", "b"), e))
    got = {int(r.a): r.v for r in df.select("a", value.alias("v")).collect()}
    assert got == {i: pytest.approx(v) for i, v in total.items()}


def test_stored_custom_models(spark, tiny_panel, tmp_path):
    def make():
        class Last:
            def fit(self, history):
                if history["sales"].mean() > 400:
                    raise ValueError("too large")
                self.last = float(history["sales"].iloc[-1])
                return self

            def predict(self, horizon):
                return [self.last] * horizon

            def predict_insample(self, history):
                return [None, *history["sales"].iloc[:-1]]

            def dump(self):
                return repr(self.last).encode()

            @classmethod
            def load(cls, data):
                out = cls()
                out.last = float(data)
                return out

        return Last

    model = make()
    custom.save_models(custom.fit_each(tiny_panel, model, "last"), str(tmp_path / "m"))
    stored = custom.load_models(spark, str(tmp_path / "m"))
    assert {r.state: r.n_train for r in stored.collect()} == {"StateA": 120, "StateB": 120}
    direct = [r for r in fit_predict_each(tiny_panel, model, "last", 3).collect() if r.error is None]
    later = custom.predict_each(stored, model.load, 3).collect()
    assert sorted(direct) == sorted(r for r in later if r.error is None)
    assert ["too large" in r.error for r in later if r.state == "StateA"] == [True]
    more = tiny_panel.unionByName(one(spark, [1.0, 2.0]).withColumn("state", F.lit("New")))
    fitted = custom.insample_each(stored, more, model.load).orderBy("state", "date").collect()
    own = [r for r in fitted if r.state == "StateB"]
    sales = [r.sales for r in tiny_panel.filter("state = 'StateB'").orderBy("date").collect()]
    assert [r.fitted for r in own] == [None, *sales[:-1]]
    assert {r.state: r.error for r in fitted if r.error}.keys() == {"StateA", "New"}
    assert custom.predict_each(stored.limit(0), model.load).count() == 0


def test_backtest_folds_side_by_side_equal_one_by_one(tiny_panel, monkeypatch):
    params = {"maxIter": 3, "maxDepth": 2, "minInstancesPerNode": 3}
    run = lambda: sorted(map(tuple, training.backtest_trained(tiny_panel, tree_params=params).collect()))
    together = run()
    monkeypatch.setattr(training, "FOLDS_AT_ONCE", 1)
    assert together == run() and len(together) == 3 * 2 * 2


def test_only_chosen_families_forecast_a_series(spark, tiny_panel):
    """Forecasts made for the selected series alone are those of all series, selected after."""
    small = {"maxIter": 3, "maxDepth": 2, "minInstancesPerNode": 3}
    rows = stage(with_split(build_features(tiny_panel), VAL, TEST), "rows")
    models = training.fit_trained(rows, tree_params=small)
    selection = spark.createDataFrame(
        [("StateA", "gbt", 5.0, "naive", 6.0, True), ("StateB", "seasonal_ar", 5.0, "seq_linear", 5.5, True)],
        "state string, best_model string, best_smape double, second_model string, second_smape double, ensemble_eligible boolean",
    )
    extra = [models.forecasts(tiny_panel, 8, selection)]
    assert {(r.state, r.model) for r in extra[0].collect()} == {("StateA", "gbt"), ("StateB", "seq_linear")}
    got = training.generate_forecasts(selection, tiny_panel, 8, extra=extra)
    every = training.future_candidates(tiny_panel).unionByName(models.forecasts(tiny_panel, 8))
    got, want = (
        df.orderBy("state", "date").collect() for df in (got, final_forecast(every, selection))
    )
    assert [r.model_used for r in got] == [r.model_used for r in want] and len(got) == 16
    assert [r.forecast for r in got] == pytest.approx([r.forecast for r in want], rel=1e-9)
    picked = spark.createDataFrame([("StateA", "naive", "seasonal_ar")], "state string, best_model string, second_model string")
    made = training.future_candidates(tiny_panel, 2, selection=picked).select("state", "model").distinct()
    assert {tuple(r) for r in made.collect()} == {("StateA", "naive"), ("StateA", "seasonal_ar")}
