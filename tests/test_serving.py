from datetime import date

import pytest

from weekloom.operators.guards import ValidationError
from weekloom.plans.serving import ForecastStore
from weekloom.sources import staging, tables


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    days = [date(2023, 4, 1), date(2023, 4, 8)]
    forecasts = spark.createDataFrame(
        [(s, d, v + i, m) for s, v, m in (("California", 1000.0, "seq_linear"), ("Texas", 500.0, "gbt")) for i, d in reversed(list(enumerate(days)))],
        "state string, date date, forecast double, model_used string",
    )
    selection = spark.createDataFrame(
        [("California", "seq_linear", 5.0, 100.0, "gbt", True), ("Texas", "gbt", 6.0, 80.0, "seq_linear", False)],
        "state string, best_model string, best_smape double, best_mae double, second_model string, ensemble_eligible boolean",
    )
    metrics = spark.createDataFrame(
        [("California", "seq_linear", 100.0, 120.0, 5.0, 0.8), ("California", "gbt", 110.0, 130.0, 6.0, 0.9), ("Texas", "gbt", 80.0, 95.0, 6.0, 0.7), ("Texas", "seq_linear", 90.0, 100.0, 7.0, 0.85)],
        "state string, model string, mae double, rmse double, smape double, mase double",
    )
    board = spark.createDataFrame(
        [("seq_linear", 5.0, 5.5, 95.0, 0.82), ("gbt", 6.0, 6.0, 95.0, 0.8), ("naive", 9.0, 9.0, 99.0, 1.0)],
        "model string, median_smape double, mean_smape double, median_mae double, median_mase double",
    )
    path = str(tmp_path_factory.mktemp("store") / "tables")
    ForecastStore(forecasts, selection, metrics, board).save(path)
    return ForecastStore.load(spark, path)


def test_states(store):
    assert [r.state for r in store.states().collect()] == ["California", "Texas"]


@pytest.mark.parametrize("text", ["California", "california", " CALIFORNIA "])
def test_lookup_ignores_case_and_blanks(store, text):
    rows = store.forecast(text).collect()
    assert [r.forecast for r in rows] == [1000.0, 1001.0]
    nested = store.forecast_response(text).first()
    assert nested.horizon_weeks == 2 and nested.forecasts[0].model_used == "seq_linear"


def test_unknown_state_is_empty(store):
    assert store.forecast("Narnia").count() == 0
    assert store.model_info("Narnia").count() == 0


def test_lookup_filter_reaches_the_scan(store):
    plan = store.forecast("texas")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lookup_key,texas)" in plan


def test_all_forecasts_and_model_info(store):
    nested = {r.state: r for r in store.all_forecasts().collect()}
    assert len(nested) == 2 and [p.forecast for p in nested["Texas"].forecasts] == [500.0, 501.0]
    info = store.model_info("texas").first()
    assert info.best_model == "gbt" and [m.model for m in info.all_models] == ["gbt", "seq_linear"]


def test_leaderboard_counts_wins_with_zero(store):
    wins = {r.model: r.states_won for r in store.leaderboard_wins().collect()}
    assert wins == {"seq_linear": 1, "gbt": 1, "naive": 0}


def test_views(spark, store):
    store.register("t_")
    assert spark.sql("select count(*) from t_forecasts").first()[0] == 4


def test_missing_tables_are_named(spark, tmp_path):
    with pytest.raises(ValidationError, match="forecasts.*metrics.*selection"):
        ForecastStore.load(spark, str(tmp_path))


@pytest.mark.parametrize("n", [10, 5000])
def test_by_key_sink_has_one_layout(spark, tmp_path, n):
    rows = [(f"State {i}", float(i)) for i in range(n)] + [("New York", 1.5), ("new_york", 2.5)]
    df = spark.createDataFrame(rows, "state string, forecast double")
    path = str(tmp_path / "keys")
    assert tables.save_by_key(df, path) == "key_bucket"
    assert all(p.name.startswith("key_bucket=") for p in (tmp_path / "keys").iterdir() if p.is_dir())
    assert spark.read.parquet(path).count() == n + 2
    assert [r.forecast for r in tables.load_key(spark, path, " STATE 7").collect()] == [7.0]
    assert [r.forecast for r in tables.load_key(spark, path, "New York").collect()] == [1.5]


def test_unknown_series_is_rejected(store):
    with pytest.raises(KeyError, match="atlantis"):
        store.require("atlantis")
    known = store.states().first().state
    assert store.require(f" {known.upper()} ")


def test_metric_files_union_and_skip_missing(spark, tmp_path):
    a = spark.createDataFrame([("A", 1.0, 10)], "state string, smape double, n_train int")
    tables.save_metrics(a, str(tmp_path), "one")
    tables.save_metrics(a.drop("n_train"), str(tmp_path), "two")
    got = tables.load_all_metrics(spark, str(tmp_path), ["one", "absent", "two"])
    assert sorted((r.n_train is None) for r in got.collect()) == [False, True]
    with pytest.raises(FileNotFoundError):
        tables.load_all_metrics(spark, str(tmp_path), ["absent"])


def test_split_tables_prune_partitions(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.0, s) for s in ("train", "val", "test")], "state string, sales double, split string")
    tables.save_splits(df, str(tmp_path / "s"))
    parts = tables.load_splits(spark, str(tmp_path / "s"))
    assert {k: v.count() for k, v in parts.items()} == {"train": 1, "val": 1, "test": 1}
    plan = parts["val"]._jdf.queryExecution().executedPlan().toString()
    assert "(split" in plan.split("PartitionFilters")[1][:80]


def test_report_csv(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.5)], "state string, smape double")
    tables.save_report(df, str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).first().smape == "1.5"


def test_staged_tables_live_in_the_named_folder_until_dropped(spark, tmp_path, monkeypatch):
    assert staging.staged_root(spark).startswith(staging.shared_dir(spark))
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path))
    df = staging.stage(spark.range(5).toDF("id"), "unit")
    assert df.count() == 5 and str(tmp_path) in df.inputFiles()[0]
    assert staging.drop_staged(spark)
    assert not any(p.name.startswith("unit") for p in tmp_path.rglob("*"))
