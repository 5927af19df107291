from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.conftest import PANEL_SCHEMA
from weekloom.functions.calendar import parse_mixed_date, week_ending
from weekloom.operators import guards, panel
from weekloom.plans import ingestion
from weekloom.plans.ingestion import run_ingestion
from weekloom.sources.raw import load_raw

D = date.fromisoformat


def test_mixed_dates_are_day_first(spark):
    texts = [
        "2021-01-15", "15-02-2021", "05-06-2021", "05-25-2021", "2021-13-02",
        "2021-03-20 10:30:00", "20/03/2021", " ", None,
    ]
    df = spark.createDataFrame([("A", t, 1.0) for t in texts], "state string, date string, sales double")
    got = [r.date for r in panel.parse_dates(df).collect()]
    assert got == [
        D("2021-01-15"), D("2021-02-15"), D("2021-06-05"), D("2021-05-25"), D("2021-02-13"),
        D("2021-03-20"), D("2021-03-20"),
    ]
    row = panel.date_quality(df).first()
    assert (row.blank_dates, row.junk_dates, row.good_dates) == (2, 0, 7)


def test_junk_date_raises_unless_told_otherwise(spark):
    df = spark.createDataFrame(
        [("A", "2021-01-15", 1.0), ("A", "not_a_date", 2.0)], "state string, date string, sales double"
    )
    with pytest.raises(Exception, match="Unparseable date"):
        panel.parse_dates(df).collect()
    assert panel.parse_dates(df, on_error="null").count() == 1


def test_weeks_snap_forward_to_saturday(spark):
    df = spark.createDataFrame([(D("2021-01-03"),), (D("2021-01-09"),), (D("2021-01-08"),)], "d date")
    assert {r[0] for r in df.select(week_ending(df.d)).collect()} == {D("2021-01-09")}


def test_dedupe_keeps_the_last_of_each_cell(spark):
    rows = [("A", D("2021-01-01"), 10.0, 1), ("A", D("2021-01-01"), 20.0, 2), ("A", D("2021-01-08"), 30.0, 3)]
    df = spark.createDataFrame(rows, "state string, date date, sales double, seq long")
    got = {(r.date, r.sales) for r in panel.dedupe_last(df, "seq").collect()}
    assert got == {(D("2021-01-01"), 20.0), (D("2021-01-08"), 30.0)}
    assert panel.duplicate_count(df).first().duplicate_rows == 1


@pytest.mark.parametrize(
    ("values", "dropped"),
    [(["x", "x"], True), ([None, None], True), (["x", None], False), (["x", "y"], False)],
)
def test_constant_column_counts_null_as_a_value(spark, values, dropped):
    df = spark.createDataFrame([(v, 1.0) for v in values], "category string, sales double")
    assert ("category" not in panel.drop_constant_column(df, "category").columns) is dropped


def weeks(*values, state="A"):
    first = D("2021-01-02").toordinal()
    return [(state, date.fromordinal(first + 7 * i), v) for i, v in enumerate(values)]


def test_imputation_interpolates_and_fills_edges(spark):
    # B pins the global range; A is [., 1, ., ., 4, .]; C never has a value.
    rows = [r for r in weeks(None, 1.0, None, None, 4.0, None) if r[2] is not None]
    rows += weeks(5.0, 5.0, 5.0, 5.0, 5.0, 5.0, state="B") + weeks(None, None, state="C")
    weekly = panel.weekly_mean(spark.createDataFrame(rows, PANEL_SCHEMA))
    full = panel.impute_weekly(weekly).orderBy("state", "date").collect()
    assert [r.sales for r in full if r.state == "A"] == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]
    assert [r.sales for r in full if r.state == "C"] == [None] * 6
    assert len(full) == 18
    grid = panel.weekly_grid(weekly).orderBy("state", "date").collect()
    assert [r.sales for r in grid if r.state == "A"] == [None, 1.0, None, None, 4.0, None]
    report = {r.state: r for r in panel.missing_report(weekly).collect()}
    assert [report[s].missing_weeks for s in "ABC"] == [4, 0, 6]
    assert report["A"].total_missing == 10
    assert report["A"].missing_pct == pytest.approx(1000 / 18)


def test_a_null_cell_between_values_is_a_gap(spark):
    weekly = panel.weekly_mean(spark.createDataFrame(weeks(2.0, None, 4.0), PANEL_SCHEMA))
    assert [r.sales for r in panel.impute_weekly(weekly).orderBy("date").collect()] == [2.0, 3.0, 4.0]


def test_week_mean_skips_nulls_and_null_keys(spark):
    rows = [("A", D("2021-01-04"), 10.0), ("A", D("2021-01-05"), None), ("A", D("2021-01-09"), 20.0), (None, D("2021-01-09"), 7.0)]
    got = panel.weekly_mean(spark.createDataFrame(rows, PANEL_SCHEMA)).collect()
    assert [(r.state, r.date, r.sales) for r in got] == [("A", D("2021-01-09"), 15.0)]


def test_one_key_with_a_third_of_all_rows(spark):
    """A hot key collapses to one row per week; nothing is lost or capped."""
    hot = spark.range(60000).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('s', id % 500) end as state",
        "date_add(date'2021-01-01', cast(id % 700 as int)) as date",
        "cast(id % 11 as double) as sales",
    )
    weekly = panel.weekly_mean(hot)
    assert weekly.filter("state = 'hot'").count() <= 101
    plain = hot.selectExpr("state", "next_day(date_sub(date, 1), 'SAT') as date", "sales")
    want = plain.groupBy("state", "date").avg("sales").collect()
    assert {tuple(r) for r in weekly.collect()} == {tuple(r) for r in want}


def test_gap_check_finds_irregular_series(spark):
    rows = weeks(1.0, 2.0, 3.0) + [("B", D("2021-01-02"), 1.0), ("B", D("2021-01-16"), 2.0)]
    df = spark.createDataFrame(rows, PANEL_SCHEMA)
    assert [(r.state, r.gaps) for r in panel.gap_check(df).collect()] == [("B", 1)]
    with pytest.raises(guards.ValidationError, match="non-weekly"):
        guards.validate_panel(df)


def test_load_raw_normalises_headers(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(" State,Date ,Product Line,Total\nA,2021-01-15,x,10.5\n")
    df = load_raw(spark, str(tmp_path / "raw.csv"))
    assert df.columns == ["state", "date", "product_line", "sales"]
    assert df.first().sales == 10.5


def test_ingestion_end_to_end(spark, tmp_path):
    rows = [
        ("A", "2021-01-02", "Goods", 100.0, 1),
        ("A", "2021-01-02", "Goods", 110.0, 2),
        ("A", "30-01-2021", "Goods", 150.0, 3),
        ("B", "2021-01-09", "Goods", 50.0, 4),
    ]
    raw = spark.createDataFrame(rows, "state string, date string, category string, sales double, seq long")
    out = run_ingestion(raw, "seq", out=str(tmp_path))
    got = {(r.state, r.date): r.sales for r in out.collect()}
    assert len(got) == 10
    assert got["A", D("2021-01-02")] == 110.0
    assert got["A", D("2021-01-16")] == 130.0
    assert got["B", D("2021-01-30")] == 50.0
    assert spark.read.parquet(f"{tmp_path}/panel").count() == 10


RAW_SCHEMA = "state string, date string, sales double, seq long"


@pytest.mark.parametrize(
    ("rows", "message"),
    [
        ([], "empty"),
        ([("A", "", 1.0, 1)], "empty"),
        ([("A", "2021-01-02", 1.0, 1), (None, "2021-01-09", 2.0, 2)], "multiple"),
        ([("A", "2021-01-02", None, 1), ("B", "2021-01-09", None, 2)], "entirely null"),
    ],
)
def test_ingestion_guards_while_it_writes(spark, rows, message):
    with pytest.raises(guards.ValidationError, match=message):
        run_ingestion(spark.createDataFrame(rows, RAW_SCHEMA), "seq")


def test_ingestion_reports_come_from_the_weekly_table(spark, tmp_path, monkeypatch):
    """The records are read by one job; the reports equal those made from the records."""
    rows = [("A", f"2021-01-{1 + i % 28:02d}", float(i - 3) if i % 7 else None, i) for i in range(60)]
    rows += [("B", "2021-02-06", 5.0, 100), ("B", "2021-02-06", -5.0, 101), (None, "2021-02-06", 1.0, 102)]
    path = str(tmp_path / "raw")
    spark.createDataFrame(rows, RAW_SCHEMA).write.parquet(path)
    raw = spark.read.parquet(path)
    want = ingestion.ingest_report(raw, "seq").first().asDict()
    jobs = []
    plain = ingestion.stage
    monkeypatch.setattr(ingestion, "stage", lambda df, label: jobs.append(label) or plain(df, label))
    run_ingestion(raw, "seq", out=str(tmp_path / "out"))
    assert jobs == ["weekly"]
    got = spark.read.csv(str(tmp_path / "out" / "quality_report"), header=True).first().asDict()
    assert {k: int(v) for k, v in got.items()} == want


def test_panel_guard_sees_what_is_written(spark, tmp_path):
    rows = weeks(1.0, None, -3.0) + [("B", D("2021-01-02"), 1.0), ("B", D("2021-01-16"), 2.0)]
    df, seen = spark.createDataFrame(rows, PANEL_SCHEMA), Observation()
    guards.observe_panel(df, seen).write.parquet(str(tmp_path / "p"))
    assert seen.get == {"total_rows": 5, "null_sales": 1, "negative_sales": 1, "gap_series": 1}
    assert spark.read.parquet(str(tmp_path / "p")).columns == df.columns


class TestGuards:
    def test_missing_columns(self, spark):
        with pytest.raises(guards.ValidationError, match="Missing required columns"):
            guards.validate_raw(spark.createDataFrame([(1, 2)], "x int, y int"))

    def test_empty(self, spark):
        with pytest.raises(guards.ValidationError, match="empty"):
            guards.validate_raw(spark.createDataFrame([], PANEL_SCHEMA))

    def test_all_null_target(self, spark):
        with pytest.raises(guards.ValidationError, match="entirely null"):
            guards.validate_raw(spark.createDataFrame([("A", D("2021-01-01"), None)], PANEL_SCHEMA))

    def test_one_series(self, spark):
        with pytest.raises(guards.ValidationError, match="multiple"):
            guards.validate_raw(spark.createDataFrame([("A", D("2021-01-01"), 1.0)], PANEL_SCHEMA))

    def test_valid(self, spark):
        rows = [("A", D("2021-01-01"), 100.0), ("B", D("2021-01-02"), 200.0)]
        guards.validate_raw(spark.createDataFrame(rows, PANEL_SCHEMA))

    def test_null_after_imputation(self, spark):
        with pytest.raises(guards.ValidationError, match="null values"):
            guards.validate_panel(spark.createDataFrame(weeks(1.0, None), PANEL_SCHEMA))

    def test_splits(self, spark):
        def one(day):
            return spark.createDataFrame([("A", D(day), 1.0)], PANEL_SCHEMA)

        none = spark.createDataFrame([], PANEL_SCHEMA)
        with pytest.raises(guards.ValidationError, match="empty"):
            guards.validate_splits(none, one("2022-01-01"))
        with pytest.raises(guards.ValidationError, match="overlap"):
            guards.validate_splits(one("2022-06-01"), one("2022-01-01"))
        guards.validate_splits(one("2021-01-01"), one("2022-01-01"), one("2023-01-01"))


def test_textual_compact_and_short_dates(spark):
    texts = {
        "15-Jan-2021": "2021-01-15", "Jan 15, 2021": "2021-01-15", "15 January 2021": "2021-01-15",
        "20210115": "2021-01-15", "05-06-21": "2021-06-05", "SEPT 3 2021": "2021-09-03",
        "3/sep/21": "2021-09-03", "2021-12-31T10:00:00": "2021-12-31", "31.12.2021": "2021-12-31",
        "12-31-21": "2021-12-31", "not_a_date": None, "32-Jan-2021": None, "": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", parse_mixed_date(F.col("t"), "null").cast("string")).collect()
    assert {r[0]: r[1] for r in got} == texts
