from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import PANEL_SCHEMA
from weekloom.functions.calendar import federal_holidays, holiday_week
from weekloom.models.state import recursive_features
from weekloom.operators import features as f
from weekloom.operators import scale, sequence, split
from weekloom.operators.encode import encode_keys


@pytest.fixture(scope="module")
def featured(spark, tiny_panel):
    df = f.build_features(tiny_panel).cache()
    df.count()
    return df


def test_all_features_present_and_rows_kept(featured, tiny_rows):
    assert featured.columns == ["state", "date", "sales", *f.ALL_FEATURES]
    assert len(f.ALL_FEATURES) == 23 and len(f.SEQUENCE_FEATURES) == 18
    assert featured.count() == len(tiny_rows)


def test_calendar_ranges(featured):
    rows = featured.collect()
    assert all(1 <= r.month <= 12 and r.day_of_week == 5 for r in rows)
    for c in ("month_sin", "month_cos", "week_of_year_sin", "week_of_year_cos"):
        assert all(-1 <= r[c] <= 1 for r in rows)
    assert {r.week_index for r in rows} == set(range(120))


def test_lags_rolling_and_derived_against_brute_force(featured, tiny_rows):
    for state in ("StateA", "StateB"):
        y = [v for s, _, v in tiny_rows if s == state]
        rows = featured.filter(F.col("state") == state).orderBy("date").collect()
        for i, r in enumerate(rows):
            for k in (1, 7, 30, 52):
                assert r[f"lag_{k}"] == (y[i - k] if i >= k else None)
            for w in (4, 8, 13):
                past = y[max(0, i - w) : i]
                if not past:
                    assert r[f"roll_mean_{w}"] is None
                    continue
                mean = sum(past) / len(past)
                assert r[f"roll_mean_{w}"] == pytest.approx(mean)
                if len(past) > 1:
                    std = (sum((x - mean) ** 2 for x in past) / (len(past) - 1)) ** 0.5
                    assert r[f"roll_std_{w}"] == pytest.approx(std)
                else:
                    assert r[f"roll_std_{w}"] is None
            if i >= 2:
                assert r.pct_change_1 == pytest.approx((y[i - 1] - y[i - 2]) / y[i - 2])
            if i:
                assert r.state_expanding_mean == pytest.approx(sum(y[:i]) / i)


def test_changing_a_row_moves_no_feature_of_that_row_or_earlier(spark, tiny_rows, featured):
    day = date(2020, 6, 6)
    moved = [(s, d, v * 10 if (s, d) == ("StateA", day) else v) for s, d, v in tiny_rows]
    changed = f.build_features(spark.createDataFrame(moved, PANEL_SCHEMA))
    upto = F.col("date") <= F.lit(day)
    a = featured.filter(upto).drop("sales").orderBy("state", "date").collect()
    b = changed.filter(upto).drop("sales").orderBy("state", "date").collect()
    assert a == b
    other = F.col("state") == "StateB"
    assert featured.filter(other).orderBy("date").collect() == changed.filter(other).orderBy("date").collect()
    after = changed.filter(~upto & ~other).drop("sales").orderBy("date").collect()
    assert after != featured.filter(~upto & ~other).drop("sales").orderBy("date").collect()


def test_zero_divisor_gives_null_change(spark):
    rows = [("A", date(2021, 1, 2) + timedelta(weeks=i), v) for i, v in enumerate([0.0, 5.0, 6.0])]
    got = f.add_derived(spark.createDataFrame(rows, PANEL_SCHEMA)).orderBy("date").collect()
    assert [r.pct_change_1 for r in got] == [None, None, None]


def test_holiday_rule_equals_interval_join(spark):
    days = federal_holidays(spark, 1990, 2035)
    weeks = spark.sql(
        "select explode(sequence(date'1990-01-06', date'2035-12-29', interval 7 days)) as date"
    )
    flagged = weeks.select("date", holiday_week(F.col("date")).alias("flag"))
    inside = F.col("holiday").between(F.date_sub("date", 6), F.col("date"))
    hit = weeks.join(F.broadcast(days), inside, "left_semi").withColumn("hit", F.lit(1))
    both = flagged.join(hit, "date", "left").select("flag", F.coalesce("hit", F.lit(0)).alias("hit"))
    assert both.filter("flag <> hit").count() == 0
    assert both.filter("flag = 1").count() > 400
    named = {r.holiday for r in days.filter("year(holiday) in (2021, 2022)").collect()}
    for day in ("2021-06-18", "2021-07-05", "2021-12-31", "2022-06-20", "2022-11-24", "2022-12-26"):
        assert date.fromisoformat(day) in named
    table = f.add_holiday_flag(weeks, holidays=days)
    rule = f.add_holiday_flag(weeks)
    assert table.exceptAll(rule).count() == 0


def test_one_exchange_and_one_sort_for_all_window_features(tiny_panel):
    plan = f.build_features(tiny_panel)._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert main.count("Exchange hashpartitioning") == 1
    assert main.count("Sort [") == 1


def test_complete_cases_and_null_report(featured):
    assert f.complete_cases(featured, f.ALL_FEATURES).count() == 2 * (120 - 52)
    counts = {r.feature: r.null_rows for r in f.feature_null_counts(featured).collect()}
    assert counts["lag_52"] == 104 and counts["month"] == 0 and counts["roll_std_4"] == 4
    row = f.dropped_count(featured, f.ALL_FEATURES).first()
    assert (row.kept_rows, row.dropped_rows) == (136, 104)


def test_recursive_features_equal_window_features(spark, tiny_rows, featured):
    cut = date(2019, 1, 5) + timedelta(weeks=110)
    history = spark.createDataFrame([r for r in tiny_rows if r[1] < cut], PANEL_SCHEMA)
    got = {r.state: r for r in recursive_features(history).collect()}
    for want in featured.filter(F.col("date") == F.lit(cut)).collect():
        for c in f.ALL_FEATURES:
            assert got[want.state][c] == pytest.approx(want[c], rel=1e-9), c


def test_encoding_is_dense_and_sorted(spark):
    names = [f"k{i:03d}" for i in range(200)]
    df = spark.createDataFrame([(n,) for n in names * 3], "state string").repartition(7)
    got = {r.state: r.state_encoded for r in encode_keys(df).collect()}
    assert got == {n: i for i, n in enumerate(names)}


def test_encoding_of_composite_keys(spark):
    pairs = [(a, b) for a in "xyz" for b in ("p", "q")]
    df = spark.createDataFrame(list(reversed(pairs)), "state string, segment string")
    got = {(r.state, r.segment): r.state_encoded for r in encode_keys(df, ["state", "segment"]).collect()}
    assert got == {pair: i for i, pair in enumerate(pairs)}


def test_split_partitions_the_rows(featured):
    parts = split.temporal_split(featured, "2020-06-01", "2021-01-01")
    assert sum(p.count() for p in parts.values()) == featured.count()
    labelled = split.with_split(featured, "2020-06-01", "2021-01-01")
    sizes = {r.split: r for r in split.split_summary(labelled).collect()}
    assert {k: v.total_rows for k, v in sizes.items()} == {k: p.count() for k, p in parts.items()}
    assert sizes["train"].series == 2
    assert split.saturdays_between("2020-06-01", "2021-01-01") == sizes["val"].weeks


def test_history_tail_and_series(tiny_panel, tiny_rows):
    tail = split.history_tail(tiny_panel, 52)
    assert tail.count() == 104
    one = split.as_ds_y(split.one_series(tiny_panel, state="StateB")).collect()
    assert [(r.ds, r.y) for r in one] == [(d, v) for s, d, v in tiny_rows if s == "StateB"]


def test_scaler_round_trip_and_constant_series(spark, tiny_panel):
    flat = spark.createDataFrame([("Flat", date(2021, 1, 2), 7.0)], PANEL_SCHEMA)
    df = tiny_panel.unionByName(flat)
    stats = scale.fit_target(df)
    scaled = scale.scale_target(df, stats)
    back = scale.unscale_target(scaled, stats, "target_scaled", "restored")
    for r in back.collect():
        assert r.restored == pytest.approx(r.sales, rel=1e-9)
        assert 0 <= r.target_scaled <= 1
        assert r.state != "Flat" or r.target_scaled == 0


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = scale.scale_features(df, scale.fit_features(df, ["a", "b"]), ["a", "b"]).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0), (1.0, 0.0)]


def test_sequences_are_full_windows_before_the_row(featured):
    stats = scale.fit_target(featured)
    ranges = scale.fit_features(featured, f.SEQUENCE_FEATURES)
    rows = sequence.sequence_windows(featured, stats, ranges).orderBy("state", "date").collect()
    assert len(rows) == 2 * (68 - 12)
    assert all(len(r.seq) == 12 and len(r.seq[0]) == 18 for r in rows)
    a = [r for r in rows if r.state == "StateA"]
    assert a[0].seq[1:] == a[1].seq[:-1]
