import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import PANEL_SCHEMA
from weekloom.operators import backtest, ensemble, metrics, selection
from weekloom.operators.median import exact_medians
from weekloom.spec import PanelSpec

FIRST = date(2021, 1, 2)


def scored(spark, actual, predicted, train=None):
    days = [FIRST + timedelta(weeks=500 + i) for i in range(len(actual))]
    preds = spark.createDataFrame(
        [("A", d, "m", float(p)) for d, p in zip(days, predicted)],
        "state string, date date, model string, forecast double",
    )
    acts = spark.createDataFrame([("A", d, float(a)) for d, a in zip(days, actual)], PANEL_SCHEMA)
    history = None
    if train is not None:
        history = spark.createDataFrame(
            [("A", FIRST + timedelta(weeks=i), float(v)) for i, v in enumerate(train)], PANEL_SCHEMA
        )
    return metrics.forecast_metrics(preds, acts, history).first()


def test_perfect_and_known_values(spark):
    row = scored(spark, [1, 2, 3], [1, 2, 3])
    assert (row.mae, row.smape) == (0, 0) and "mase" not in row.asDict()
    assert scored(spark, [10, 20, 30], [12, 18, 33]).mae == pytest.approx(7 / 3)


def test_smape_is_bounded_and_symmetric(spark):
    assert scored(spark, [100], [0]).smape == pytest.approx(200)
    assert scored(spark, [10, 20], [15, 25]).smape == pytest.approx(scored(spark, [15, 25], [10, 20]).smape)


def test_undefined_metrics_are_null(spark):
    row = scored(spark, [0, 0], [0, 0], [3, 3, 3])
    assert row.mape is None and row.smape is None and row.mase is None


def test_mase_short_and_seasonal(spark):
    assert scored(spark, [6, 7], [5, 8], [1, 2, 3, 4, 5]).mase == pytest.approx(1.0)
    rng = random.Random(0)
    train = [100 + rng.gauss(0, 5) for _ in range(60)]
    scale = statistics.mean(abs(train[i] - train[i - 52]) for i in range(52, 60))
    row = scored(spark, [100, 105], [101, 104], train)
    assert row.mase == pytest.approx(1.0 / scale) and row.n_train == 60 and row.n_val == 2
    exact = [100 + rng.gauss(0, 5) for _ in range(52)]
    plain = statistics.mean(abs(exact[i] - exact[i - 1]) for i in range(1, 52))
    assert scored(spark, [100], [101], exact).mase == pytest.approx(1 / plain)


def test_all_metrics_finite_on_plain_data(spark):
    row = scored(spark, [100, 200, 150, 180, 220], [110, 190, 160, 170, 230], range(80, 150, 10))
    assert all(row[m] > 0 for m in ("mae", "rmse", "mape", "smape", "mase"))


def test_alignment_by_position_trims_to_the_shorter(spark):
    days = [FIRST + timedelta(days=3 * i) for i in range(4)]
    preds = spark.createDataFrame(
        [("A", d + timedelta(days=1), "m", float(i)) for i, d in enumerate(days[:3])],
        "state string, date date, model string, forecast double",
    )
    acts = spark.createDataFrame([("A", d, 10.0 * i) for i, d in enumerate(days)], PANEL_SCHEMA)
    got = metrics.align_by_position(preds, acts).orderBy("date").collect()
    assert [(r.forecast, r.actual) for r in got] == [(0.0, 0.0), (1.0, 10.0), (2.0, 20.0)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 1001, 60000])
def test_exact_median_of_hot_groups(spark, n):
    rng = random.Random(n)
    rows = [("a", round(rng.lognormvariate(3, 2), 3)) for _ in range(n)]
    rows += [("ties", float(i % 3)) for i in range(n)] + [("none", None), ("nan", float("nan"))]
    df = spark.createDataFrame(rows, "model string, smape double").repartition(7)
    got = {r.model: r.median_smape for r in exact_medians(df, ["model"], ["smape"]).collect()}
    assert got["a"] == pytest.approx(statistics.median(v for m, v in rows if m == "a"), abs=1e-12)
    assert got["ties"] == statistics.median(v for m, v in rows if m == "ties")
    assert got.get("none") is None and got.get("nan") is None


METRICS = "state string, model string, smape double, mase double, mae double, rmse double, mape double"
MODELS = ["seasonal_ar", "decomposition", "gbt", "seq_linear"]


def metric_rows(spark, *rows):
    return spark.createDataFrame([(s, m, sm, ma, 1.0, 1.0, 1.0) for s, m, sm, ma in rows], METRICS)


def test_selection_order_ties_and_eligibility(spark):
    df = metric_rows(
        spark,
        ("A", "gbt", 5.0, 1.0), ("A", "seq_linear", 3.0, 0.8),
        ("B", "gbt", 4.0, 1.0), ("B", "seq_linear", 4.0, 0.5),
        ("C", "seq_linear", 4.0, 1.0), ("C", "decomposition", 4.0, 1.0),
        ("D", "gbt", 2.0, None),
        ("E", "gbt", float("nan"), 1.0), ("E", "seq_linear", 9.0, 1.0),
        ("F", "gbt", 0.0, 1.0), ("F", "seq_linear", 1.0, 1.0),
    )
    got = {r.state: r for r in selection.select_best(df, MODELS).collect()}
    assert (got["A"].best_model, got["A"].second_model) == ("seq_linear", "gbt")
    assert not got["A"].ensemble_eligible and got["B"].ensemble_eligible
    assert got["B"].best_model == "seq_linear" and got["C"].best_model == "decomposition"
    assert got["D"].second_model is None and got["D"].ensemble_eligible is False
    assert got["E"].best_model == "seq_linear" and got["E"].ensemble_eligible is False
    assert got["F"].best_model == "gbt" and got["F"].ensemble_eligible is False


def test_comparison_and_worst_use_their_own_tie_rules(spark):
    df = metric_rows(
        spark,
        ("C", "seq_linear", 4.0, 1.0), ("C", "decomposition", 4.0, 1.0), ("C", "gbt", 4.0, 0.1),
        ("D", "gbt", 7.126, 1.0), ("N", "gbt", None, None),
    )
    wide = {r.state: r for r in selection.state_comparison(df, MODELS).collect()}
    assert set(wide) == {"C", "D"}
    assert wide["C"].best_model == "decomposition" and wide["C"].seasonal_ar is None
    worst = selection.worst_states(df, MODELS, n=5).collect()
    assert [(r.state, r.model, r.smape) for r in worst] == [("D", "gbt", 7.13), ("C", "decomposition", 4.0)]


def test_weights_sum_to_one_and_survive_zero(spark):
    df = spark.createDataFrame([(5.0, 8.0), (0.0, 1.0)], "b double, s double")
    w1, w2 = selection.ensemble_weights(F.col("b"), F.col("s"))
    rows = df.select(w1.alias("w1"), w2.alias("w2")).collect()
    assert all(r.w1 + r.w2 == pytest.approx(1.0) and r.w1 > r.w2 for r in rows)


def test_blend_falls_back_and_trims(spark):
    days = [FIRST + timedelta(weeks=i) for i in range(2)]
    rows = [(s, d, "gbt", 100.0) for s in "ABC" for d in days]
    rows += [("A", d, "seq_linear", 200.0) for d in days] + [("C", days[0], "seq_linear", 200.0)]
    rows += [("A", d, "decomposition", 999.0) for d in days]
    cand = spark.createDataFrame(rows, "state string, date date, model string, forecast double")
    chosen = spark.createDataFrame(
        [(s, "gbt", 5.0, "seq_linear", 5.0, True) for s in "ABC"],
        "state string, best_model string, best_smape double, second_model string, second_smape double, ensemble_eligible boolean",
    )
    got = [(r.state, r.date, r.forecast, r.model_used) for r in ensemble.final_forecast(cand, chosen).orderBy("state", "date").collect()]
    label = "ensemble(gbt:0.50+seq_linear:0.50)"
    assert got == [
        ("A", days[0], 150.0, label), ("A", days[1], 150.0, label),
        ("B", days[0], 100.0, "gbt"), ("B", days[1], 100.0, "gbt"),
        ("C", days[0], 150.0, label),
    ]
    alone = ensemble.final_forecast(cand, chosen, use_ensemble=False)
    assert {r.model_used for r in alone.collect()} == {"gbt"} and alone.count() == 6


def test_folds_walk_back_and_stop_before_the_first_season(spark):
    def folds(weeks):
        rows = [("A", FIRST + timedelta(weeks=i), 1.0) for i in range(weeks)]
        return backtest.backtest_folds(spark.createDataFrame(rows, PANEL_SCHEMA)).orderBy("fold").collect()

    full = folds(120)
    last = FIRST + timedelta(weeks=119)
    assert [r.fold for r in full] == [1, 2, 3]
    assert full[2].val_end == last and full[2].val_start == last - timedelta(weeks=13)
    assert full[0].train_end == last - timedelta(weeks=39) == full[0].val_start
    # train_end must lie after the 53rd week: with 66 weeks the last fold starts exactly on it.
    assert len(folds(66)) == 0 and len(folds(67)) == 1 and len(folds(50)) == 0


def test_fold_rows_are_half_open(spark):
    rows = [("A", FIRST + timedelta(weeks=i), 1.0) for i in range(80)]
    df = spark.createDataFrame(rows, PANEL_SCHEMA)
    folds = backtest.backtest_folds(df)
    got = backtest.fold_rows(df, folds).groupBy("fold", "split").count().collect()
    assert {(r.fold, r.split): r["count"] for r in got} == {(1, "train"): 53, (1, "val"): 13, (2, "train"): 66, (2, "val"): 13}
    assert PanelSpec().with_key("fold").keys == ("state", "fold")


def test_no_series_is_lost_without_its_best_model(spark):
    day = date(2022, 1, 1)
    rows = [
        ("A", day, "naive", 5.0), ("B", day, "gbt", 7.0), ("B", day, "naive", 9.0), ("C", day, "x", 1.0),
    ]
    made = spark.createDataFrame(rows, "state string, date date, model string, forecast double")
    chosen = spark.createDataFrame(
        [(s, "gbt", 4.0, "naive", 5.0, False) for s in "ABCD"],
        "state string, best_model string, best_smape double, second_model string, "
        "second_smape double, ensemble_eligible boolean",
    )
    got = {r.state: (r.forecast, r.model_used) for r in ensemble.final_forecast(made, chosen).collect()}
    assert got == {"A": (5.0, "naive"), "B": (7.0, "gbt")}
    lost = {r.state: r.reason for r in ensemble.not_forecast(made, chosen).collect()}
    assert lost == {
        "C": "neither selected model has a forecast",
        "D": "no model has a forecast",
    }


def test_infinite_values_have_a_median(spark):
    inf = float("inf")
    rows = [("a", inf), ("a", inf), ("a", 1.0), ("b", -inf), ("b", 2.0), ("b", 3.0), ("b", inf)]
    df = spark.createDataFrame(rows, "model string, mae double")
    got = {r.model: r.median_mae for r in exact_medians(df, ["model"], ["mae"]).collect()}
    assert got == {"a": inf, "b": 2.5}
