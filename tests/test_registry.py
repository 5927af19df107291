"""Registered queries against their SQL on the given tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from weekloom.registry.oracle import oracles
from weekloom.registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TRAINED = {
    "backtest_gbt", "evaluate_models", "feature_importance", "final_forecast_all", "gbt_fit",
    "model_roundtrip", "onestep_eval", "recursive_gbt", "recursive_seq", "seq_linear",
}
# One query per area; the whole list is compared by the driver.
SAMPLE = [
    "parse_mixed_dates", "dedupe_last", "impute_weekly", "impute_segments", "missing_report",
    "build_features", "recursive_features", "sequence_windows", "seasonal_ar", "decomposition",
    "forecast_metrics", "leaderboard", "select_best", "ensemble_blend", "backtest_closed",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{name}'")
    yield con
    con.close()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def test_every_query_has_sql_unless_it_is_trained():
    assert set(QUERIES) - set(oracles()) == TRAINED
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    names = sorted(df.columns)
    got = sorted(map(repr, (tuple(plain(r[c]) for c in names) for r in df.collect())))
    cursor = duck.execute(entry.oracle_sql()[name])
    order = [c[0] for c in cursor.description]
    assert sorted(order) == names
    rows = cursor.fetchall()
    want = sorted(map(repr, (tuple(plain(r[order.index(c)]) for c in names) for r in rows)))
    assert got == want


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 8600
