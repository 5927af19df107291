"""The registered results in plain SQL, written from the definitions.

Grids are real cross products here and holidays a real range join: a statement of the
result, not of the way the library computes it. Each query pulls in the common table
expressions it names.

Doubles are rounded half up as floor(x * 10^p + 0.501) / 10^p on both sides. Means of money
amounts often end exactly on a decimal tie, where the last bit of a sum, which depends on
its order, would decide a plain ``round``; the last digit of 0.501 sends what lies within
a thousandth of a step below the tie up with it.
"""

from __future__ import annotations

import re

VAL, TEST = "DATE '2000-07-01'", "DATE '2000-12-30'"
STATE = "NATION_7"
VAL_WEEKS = 26
FUTURE_WEEKS = 8
FOLD_WEEKS = 13

CTES: dict[str, str] = {}

# Records and panel -----------------------------------------------------------------

CTES["order_totals"] = """
    SELECT o_orderkey AS order_id, n_name AS state, c_mktsegment AS segment,
           CAST(o_orderdate AS DATE) AS date,
           SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS total
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2, 3, 4"""
CTES["records"] = """
    SELECT state, date, CAST(total AS DOUBLE) AS sales, order_id AS seq FROM order_totals"""
CTES["daily"] = """
    SELECT state, date, CAST(SUM(total) AS DOUBLE) AS sales FROM order_totals GROUP BY 1, 2"""
CTES["weekly"] = """
    SELECT state, CAST(date + CAST(6 - dayofweek(date) AS INTEGER) AS DATE) AS date,
           AVG(sales) AS sales
    FROM daily GROUP BY 1, 2"""


def grid_sql(weekly: str, key: str) -> str:
    return f"""
    SELECT k.*, w.date, c.sales
    FROM (SELECT DISTINCT {key} FROM {weekly}) k
    CROSS JOIN (
        SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                           INTERVAL 7 DAY)) AS DATE) AS date
        FROM (SELECT MIN(date) AS lo, MAX(date) AS hi FROM {weekly})
    ) w
    LEFT JOIN {weekly} c USING ({key}, date)"""


def imputed_sql(grid: str, key: str) -> str:
    return f"""
    SELECT {key}, date,
           CASE WHEN sales IS NOT NULL THEN sales
                WHEN pv IS NULL THEN nv
                WHEN nv IS NULL THEN pv
                ELSE pv + (nv - pv) * ((date - pd) / 7) / ((nd - pd) / 7) END AS sales
    FROM (
        SELECT {key}, date, sales,
               last_value(sales IGNORE NULLS) OVER before AS pv,
               last_value(CASE WHEN sales IS NOT NULL THEN date END IGNORE NULLS)
                   OVER before AS pd,
               first_value(sales IGNORE NULLS) OVER after AS nv,
               first_value(CASE WHEN sales IS NOT NULL THEN date END IGNORE NULLS)
                   OVER after AS nd
        FROM {grid}
        WINDOW before AS (PARTITION BY {key} ORDER BY date
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               after AS (PARTITION BY {key} ORDER BY date
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    )"""


CTES["grid"] = grid_sql("weekly", "state")
CTES["panel"] = imputed_sql("grid", "state")
CTES["segment_weekly"] = """
    SELECT state, segment, CAST(date + CAST(6 - dayofweek(date) AS INTEGER) AS DATE) AS date,
           AVG(sales) AS sales
    FROM (SELECT state, segment, date, CAST(SUM(total) AS DOUBLE) AS sales
          FROM order_totals GROUP BY 1, 2, 3)
    GROUP BY 1, 2, 3"""
CTES["segment_grid"] = grid_sql("segment_weekly", "state, segment")
CTES["clean"] = """
    SELECT state, date, sales, seq
    FROM (SELECT *, row_number() OVER (PARTITION BY state, date ORDER BY seq DESC) AS rn
          FROM records)
    WHERE rn = 1"""
CTES["clean_weekly"] = """
    SELECT state, CAST(date + CAST(6 - dayofweek(date) AS INTEGER) AS DATE) AS date,
           AVG(sales) AS sales
    FROM clean GROUP BY 1, 2"""
CTES["clean_grid"] = grid_sql("clean_weekly", "state")

# Calendar and features -------------------------------------------------------------

CTES["days"] = """
    SELECT CAST(unnest(generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2030-12-31',
                                       INTERVAL 1 DAY)) AS DATE) AS day"""
CTES["actual_holidays"] = """
    SELECT day FROM days WHERE
       (month(day) = 1 AND day(day) = 1)
    OR (month(day) = 1 AND isodow(day) = 1 AND day(day) BETWEEN 15 AND 21)
    OR (month(day) = 2 AND isodow(day) = 1 AND day(day) BETWEEN 15 AND 21)
    OR (month(day) = 5 AND isodow(day) = 1 AND day(day) BETWEEN 25 AND 31)
    OR (month(day) = 6 AND day(day) = 19 AND year(day) >= 2021)
    OR (month(day) = 7 AND day(day) = 4)
    OR (month(day) = 9 AND isodow(day) = 1 AND day(day) BETWEEN 1 AND 7)
    OR (month(day) = 10 AND isodow(day) = 1 AND day(day) BETWEEN 8 AND 14)
    OR (month(day) = 11 AND day(day) = 11)
    OR (month(day) = 11 AND isodow(day) = 4 AND day(day) BETWEEN 22 AND 28)
    OR (month(day) = 12 AND day(day) = 25)"""
CTES["holidays"] = """
    SELECT day FROM actual_holidays
    UNION SELECT CAST(day - 1 AS DATE) FROM actual_holidays WHERE isodow(day) = 6
    UNION SELECT CAST(day + 1 AS DATE) FROM actual_holidays WHERE isodow(day) = 7"""
CTES["holiday_weeks"] = """
    SELECT DISTINCT w.day AS date FROM days w
    JOIN holidays h ON h.day BETWEEN w.day - 6 AND w.day
    WHERE isodow(w.day) = 6"""
CTES["features"] = """
    SELECT p.state, p.date, p.sales,
           month(p.date) AS month, week(p.date) AS week_of_year, year(p.date) AS year,
           quarter(p.date) AS quarter, isodow(p.date) - 1 AS day_of_week,
           sin(2 * pi() * month(p.date) / 12) AS month_sin,
           cos(2 * pi() * month(p.date) / 12) AS month_cos,
           sin(2 * pi() * week(p.date) / 52) AS week_of_year_sin,
           cos(2 * pi() * week(p.date) / 52) AS week_of_year_cos,
           CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS is_holiday_week,
           (p.date - (SELECT MIN(date) FROM panel)) // 7 AS week_index,
           lag(sales, 1) OVER w AS lag_1, lag(sales, 7) OVER w AS lag_7,
           lag(sales, 30) OVER w AS lag_30, lag(sales, 52) OVER w AS lag_52,
           AVG(sales) OVER w4 AS roll_mean_4, stddev_samp(sales) OVER w4 AS roll_std_4,
           AVG(sales) OVER w8 AS roll_mean_8, stddev_samp(sales) OVER w8 AS roll_std_8,
           AVG(sales) OVER w13 AS roll_mean_13, stddev_samp(sales) OVER w13 AS roll_std_13,
           (lag(sales, 1) OVER w - lag(sales, 2) OVER w)
               / nullif(lag(sales, 2) OVER w, 0) AS pct_change_1,
           AVG(sales) OVER past AS state_expanding_mean
    FROM panel p LEFT JOIN holiday_weeks h ON h.date = p.date
    WINDOW w AS (PARTITION BY state ORDER BY p.date),
           w4 AS (PARTITION BY state ORDER BY p.date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
           w8 AS (PARTITION BY state ORDER BY p.date ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING),
           w13 AS (PARTITION BY state ORDER BY p.date ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING),
           past AS (PARTITION BY state ORDER BY p.date
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""

CALENDAR = ["month", "week_of_year", "year", "quarter", "day_of_week"]
CYCLES = ["month_sin", "month_cos", "week_of_year_sin", "week_of_year_cos"]
LAGS = ["lag_1", "lag_7", "lag_30", "lag_52"]
ROLLING = [f"roll_{s}_{w}" for w in (4, 8, 13) for s in ("mean", "std")]
TAIL = ["pct_change_1", "state_expanding_mean"]
ALL = CALENDAR + CYCLES + ["is_holiday_week", "week_index"] + LAGS + ROLLING + TAIL
SEQ = CYCLES + ["is_holiday_week", "week_index"] + LAGS + ROLLING + TAIL
WHOLE_NUMBERS = {*CALENDAR, "is_holiday_week", "week_index"}


def cols(names: list[str], places: int = 4, prefix: str = "") -> str:
    return ", ".join(
        f"{prefix}{c} AS {c}" if c in WHOLE_NUMBERS else f"floor({prefix}{c} * 1e{places} + 0.501) / 1e{places} AS {c}"
        for c in names
    )


ALL_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in ALL)
SEQ_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in SEQ)

# Splits and scaling ----------------------------------------------------------------

SPLIT = f"CASE WHEN date < {VAL} THEN 'train' WHEN date < {TEST} THEN 'val' ELSE 'test' END"
CTES["labelled"] = f"SELECT state, date, sales, {SPLIT} AS split FROM panel"
CTES["train"] = f"SELECT state, date, sales FROM panel WHERE date < {VAL}"
CTES["val"] = f"SELECT state, date, sales FROM panel WHERE date >= {VAL} AND date < {TEST}"
CTES["target_range"] = "SELECT state, MIN(sales) AS lo, MAX(sales) AS hi FROM train GROUP BY 1"
CTES["feature_range"] = "SELECT " + ", ".join(
    f"CAST(MIN({c}) AS DOUBLE) AS lo_{c}, CAST(MAX({c}) AS DOUBLE) AS hi_{c}" for c in SEQ
) + f" FROM features WHERE date < {VAL} AND {SEQ_PRESENT}"
CTES["scaled"] = "SELECT f.state, f.date, f.sales, " + ", ".join(
    f"(f.{c} - lo_{c}) / CASE WHEN hi_{c} = lo_{c} THEN 1 ELSE hi_{c} - lo_{c} END AS {c}"
    for c in SEQ
) + " FROM features f, feature_range"
CTES["numbered"] = f"""
    SELECT s.*, CASE WHEN hi = lo THEN 0 ELSE (sales - lo) / (hi - lo) END AS target_scaled,
           row_number() OVER (PARTITION BY state ORDER BY date) AS rn
    FROM (SELECT * FROM scaled WHERE {SEQ_PRESENT}) s JOIN target_range USING (state)"""

CTES["split_numbered"] = CTES["numbered"].replace(
    "SELECT s.*,", f"SELECT s.*, {SPLIT} AS split,"
).replace("PARTITION BY state", f"PARTITION BY state, {SPLIT}")
MONEY = {*LAGS, *ROLLING, "state_expanding_mean"}


def shown(value: str, unit: float) -> str:
    """A single-precision value in larger units, at five places."""
    return f"floor(CAST(CAST({value} AS FLOAT) AS DOUBLE) / {unit} * 1e5 + 0.501) / 1e5"


# Forecasts -------------------------------------------------------------------------


def ar_sql(history: str, weeks: int, key: str = "state") -> str:
    """Seasonal AR(1) on 52-week differences; every series here has two full seasons."""
    return f"""
    SELECT {key}, CAST(c.last + 7 * h AS DATE) AS date, 'seasonal_ar' AS model,
           base.sales + CASE WHEN b = 1 THEN d0 + a * h
                             ELSE a * (1 - pow(b, h)) / (1 - b) + pow(b, h) * d0 END AS forecast
    FROM (
        SELECT {key}, regr_slope(d, p) AS b, regr_intercept(d, p) AS a, arg_max(d, date) AS d0,
               MAX(date) AS last, COUNT(*) AS n
        FROM (
            SELECT *, lag(d) OVER (PARTITION BY {key} ORDER BY date) AS p
            FROM (SELECT *, sales - lag(sales, 52) OVER (PARTITION BY {key} ORDER BY date) AS d
                  FROM {history})
        ) GROUP BY {key}
    ) c
    CROSS JOIN (SELECT CAST(unnest(range(1, {weeks} + 1)) AS INTEGER) AS h)
    JOIN {history} base USING ({key})
    WHERE base.date = c.last + 7 * h - 364 AND n >= 104 AND b IS NOT NULL"""


def decomposition_sql(history: str, weeks: int, key: str = "state") -> dict[str, str]:
    """Trend by regression, mean ratio per ISO week (53 as 52), mean rest per holiday flag."""
    h = history
    return {
        f"{h}_trend": f"""
    SELECT {key}, regr_slope(sales, age) AS slope, regr_intercept(sales, age) AS base,
           MIN(date) AS first, MAX(date) AS last
    FROM (SELECT *, (date - MIN(date) OVER (PARTITION BY {key})) / 7 AS age FROM {h})
    GROUP BY {key} HAVING COUNT(*) >= 20""",
        f"{h}_ratio": f"""
    SELECT {key}, p.date, sales, least(week(p.date), 52) AS wk,
           CASE WHEN hw.date IS NULL THEN 0 ELSE 1 END AS flag,
           base + slope * ((p.date - first) / 7) AS trend
    FROM {h} p JOIN {h}_trend t USING ({key})
    LEFT JOIN holiday_weeks hw ON hw.date = p.date""",
        f"{h}_season": f"""
    SELECT {key}, wk, AVG(CASE WHEN trend > 0 THEN sales / trend END) AS season
    FROM {h}_ratio GROUP BY {key}, wk""",
        f"{h}_holiday": f"""
    SELECT {key}, flag,
           AVG(CASE WHEN trend > 0 THEN sales / (trend * coalesce(season, 1)) END) AS holiday
    FROM {h}_ratio LEFT JOIN {h}_season USING ({key}, wk) GROUP BY {key}, flag""",
        f"{h}_decomposed": f"""
    SELECT {key}, f.date, 'decomposition' AS model,
           (base + slope * ((f.date - first) / 7)) * coalesce(season, 1) * coalesce(holiday, 1)
               AS forecast
    FROM (SELECT *, CAST(last + 7 * s AS DATE) AS date
          FROM {h}_trend CROSS JOIN (SELECT CAST(unnest(range(1, {weeks} + 1)) AS INTEGER) AS s)) f
    LEFT JOIN holiday_weeks hw ON hw.date = f.date
    LEFT JOIN {h}_season s USING ({key})
    LEFT JOIN {h}_holiday o USING ({key})
    WHERE s.wk = least(week(f.date), 52)
      AND o.flag = CASE WHEN hw.date IS NULL THEN 0 ELSE 1 END""",
    }


def naive_val_sql(train: str, val: str, key: str = "state") -> str:
    return f"""
    SELECT {key}, v.date, 'naive' AS model, arg_max(t.sales, t.date) AS forecast
    FROM {val} v JOIN {train} t USING ({key}) GROUP BY {key}, v.date"""


CTES["naive_val"] = naive_val_sql("train", "val")
CTES["seasonal_naive_val"] = """
    SELECT v.state, v.date, 'seasonal_naive' AS model, p.sales AS forecast
    FROM val v JOIN panel p ON p.state = v.state AND p.date = v.date - 364
    WHERE v.state IN (SELECT state FROM train GROUP BY state HAVING COUNT(*) >= 52)"""
CTES["ar_val"] = ar_sql("train", VAL_WEEKS)
CTES.update(decomposition_sql("train", VAL_WEEKS))
CTES["preds"] = """
    SELECT * FROM naive_val UNION ALL SELECT * FROM seasonal_naive_val
    UNION ALL SELECT * FROM ar_val UNION ALL SELECT * FROM train_decomposed"""
CTES["naive_future"] = f"""
    SELECT state, CAST(last + 7 * h AS DATE) AS date, 'naive' AS model, forecast
    FROM (SELECT state, MAX(date) AS last, arg_max(sales, date) AS forecast
          FROM panel GROUP BY 1)
    CROSS JOIN (SELECT CAST(unnest(range(1, {FUTURE_WEEKS} + 1)) AS INTEGER) AS h)"""
CTES["seasonal_naive_future"] = f"""
    SELECT n.state, n.date, 'seasonal_naive' AS model, p.sales AS forecast
    FROM naive_future n JOIN panel p ON p.state = n.state AND p.date = n.date - 364"""
CTES["ar_future"] = ar_sql("panel", FUTURE_WEEKS)
CTES.update(decomposition_sql("panel", FUTURE_WEEKS))
CTES["future"] = """
    SELECT * FROM naive_future UNION ALL SELECT * FROM seasonal_naive_future
    UNION ALL SELECT * FROM ar_future UNION ALL SELECT * FROM panel_decomposed"""

# Metrics and selection -------------------------------------------------------------


def scale_sql(train: str, key: str) -> str:
    return f"""
    SELECT {key}, CASE WHEN COUNT(*) > 52 THEN AVG(abs(sales - l52)) ELSE AVG(abs(sales - l1)) END
               AS mase_scale, COUNT(*) AS n_train
    FROM (SELECT *, lag(sales, 52) OVER (PARTITION BY {key} ORDER BY date) AS l52,
                 lag(sales, 1) OVER (PARTITION BY {key} ORDER BY date) AS l1 FROM {train})
    GROUP BY {key}"""


def metrics_sql(preds: str, val: str, scale: str, key: str) -> str:
    return f"""
    SELECT {key}, model, mae, rmse, mape, smape, mae / nullif(mase_scale, 0) AS mase, n_val, n_train
    FROM (
        SELECT {key}, model, AVG(abs(sales - forecast)) AS mae,
               sqrt(AVG(pow(sales - forecast, 2))) AS rmse,
               100 * AVG(abs((sales - forecast) / sales)) FILTER (sales <> 0) AS mape,
               100 * AVG(2 * abs(sales - forecast) / (abs(sales) + abs(forecast)))
                   FILTER (abs(sales) + abs(forecast) > 0) AS smape,
               COUNT(*) AS n_val
        FROM {preds} JOIN {val} USING ({key}, date) GROUP BY {key}, model
    ) LEFT JOIN {scale} USING ({key})"""


CTES["mase_scales"] = scale_sql("train", "state")
CTES["metrics"] = metrics_sql("preds", "val", "mase_scales", "state")
CTES["families"] = """
    SELECT * FROM (VALUES ('naive', 1), ('seasonal_naive', 2), ('seasonal_ar', 3),
                          ('decomposition', 4)) f(model, position)"""
CTES["ranked"] = """
    SELECT m.*, row_number() OVER (PARTITION BY state ORDER BY smape ASC NULLS LAST,
                                   mase ASC NULLS LAST, position) AS place
    FROM metrics m JOIN families USING (model)"""
CTES["selection"] = """
    SELECT b.state, b.model AS best_model, b.smape AS best_smape, b.mase AS best_mase,
           b.mae AS best_mae, s.model AS second_model, s.smape AS second_smape,
           coalesce(b.smape > 0 AND s.smape / nullif(b.smape, 0) <= 1.5, false)
               AS ensemble_eligible
    FROM (SELECT * FROM ranked WHERE place = 1) b
    LEFT JOIN (SELECT * FROM ranked WHERE place = 2) s USING (state)"""
CTES["weights"] = """
    SELECT *, (1 / greatest(best_smape, 0.01))
                 / (1 / greatest(best_smape, 0.01) + 1 / greatest(second_smape, 0.01)) AS w_best,
              (1 / greatest(second_smape, 0.01))
                 / (1 / greatest(best_smape, 0.01) + 1 / greatest(second_smape, 0.01)) AS w_second
    FROM selection"""


def blend_sql(preds: str) -> str:
    return f"""
    SELECT w.state, b.date, best_model, second_model, w_best, w_second,
           b.forecast AS best_forecast,
           CASE WHEN ensemble_eligible THEN s.forecast END AS second_forecast,
           ensemble_eligible AND s.forecast IS NOT NULL AS blended,
           CASE WHEN ensemble_eligible AND s.forecast IS NOT NULL
                THEN b.forecast * w_best + s.forecast * w_second ELSE b.forecast END AS forecast
    FROM weights w
    JOIN {preds} b ON b.state = w.state AND b.model = w.best_model
    LEFT JOIN {preds} s ON s.state = w.state AND s.model = w.second_model AND s.date = b.date"""


CTES["blend_val"] = blend_sql("preds")
CTES["blend_future"] = blend_sql("future")
CTES["final"] = """
    SELECT state, date, forecast,
           CASE WHEN blended THEN
               'ensemble(' || best_model || ':' || printf('%.2f', round(w_best, 2)) || '+'
               || second_model || ':' || printf('%.2f', round(w_second, 2)) || ')'
           ELSE best_model END AS model_used
    FROM blend_future"""
CTES["board"] = """
    SELECT model, median(smape) AS median_smape, AVG(smape) AS mean_smape,
           median(mae) AS median_mae, median(rmse) AS median_rmse, median(mase) AS median_mase,
           COUNT(*) AS states_count
    FROM metrics GROUP BY 1"""
CTES["ensemble_check"] = """
    SELECT state, best_model, second_model, w_best, w_second,
           100 * AVG(2 * abs(sales - best_forecast) / (abs(sales) + abs(best_forecast)))
               FILTER (abs(sales) + abs(best_forecast) > 0) AS best_smape,
           100 * AVG(2 * abs(sales - forecast) / (abs(sales) + abs(forecast)))
               FILTER (abs(sales) + abs(forecast) > 0) AS blend_smape
    FROM blend_val JOIN val USING (state, date) WHERE blended
    GROUP BY 1, 2, 3, 4, 5"""

# Backtest --------------------------------------------------------------------------

CTES["fold_table"] = f"""
    SELECT CAST(row_number() OVER (ORDER BY val_start) AS INTEGER) AS fold,
           val_start AS train_end, val_start, val_end
    FROM (SELECT CAST(hi - 7 * {FOLD_WEEKS} * (i + 1) AS DATE) AS val_start,
                 CAST(hi - 7 * {FOLD_WEEKS} * i AS DATE) AS val_end
          FROM (SELECT MAX(date) AS hi FROM panel), (SELECT CAST(unnest(range(0, 3)) AS INTEGER) AS i))
    WHERE val_start > (SELECT MAX(date) FROM (SELECT DISTINCT date FROM panel
                                              ORDER BY date LIMIT 53))"""
CTES["folded"] = """
    SELECT fold, state, date, sales,
           CASE WHEN date < train_end THEN 'train' ELSE 'val' END AS split
    FROM panel JOIN fold_table ON date < val_end"""
CTES["ftrain"] = """
    SELECT fold || '|' || state AS fs, date, sales FROM folded WHERE split = 'train'"""
CTES["fval"] = "SELECT fold || '|' || state AS fs, date, sales FROM folded WHERE split = 'val'"
CTES["fnaive"] = naive_val_sql("ftrain", "fval", "fs")
CTES["fseasonal"] = """
    SELECT v.fs, v.date, 'seasonal_naive' AS model, p.sales AS forecast
    FROM fval v JOIN panel p ON p.state = split_part(v.fs, '|', 2) AND p.date = v.date - 364"""
CTES["far"] = ar_sql("ftrain", FOLD_WEEKS, "fs")
CTES.update(decomposition_sql("ftrain", FOLD_WEEKS, "fs"))
CTES["fpreds"] = """
    SELECT * FROM fnaive UNION ALL SELECT * FROM fseasonal
    UNION ALL SELECT * FROM far UNION ALL SELECT * FROM ftrain_decomposed"""
CTES["fscales"] = scale_sql("ftrain", "fs")
CTES["fmetrics"] = metrics_sql("fpreds", "fval", "fscales", "fs")

METRIC_COLS = cols(["mae", "rmse", "mape", "smape", "mase"]) + ", n_val, n_train"
SELECTED = (
    "state, best_model, second_model, ensemble_eligible, "
    + cols(["best_smape", "best_mase", "best_mae", "second_smape"])
)
BOARD = ", ".join(
    f"round({c}, 2) AS {c}" for c in ("median_smape", "mean_smape", "median_mae", "median_mase")
)
PANEL4 = "state, date, floor((sales) * 1e4 + 0.501) / 1e4 AS sales"

QUERIES: dict[str, str] = {
    # sources and sinks
    "load_raw": """SELECT state, CASE WHEN seq % 2 = 0 THEN strftime(date, '%Y-%m-%d')
        ELSE strftime(date, '%d-%m-%Y') END AS date, 'Goods' AS category,
        floor((sales) * 1e4 + 0.501) / 1e4 AS sales, seq AS order_seq FROM records""",
    "split_roundtrip": f"SELECT {PANEL4}, split FROM labelled",
    "forecast_sink": """SELECT state, date, floor((forecast) * 1e3 + 0.501) / 1e3 AS forecast, model_used,
        replace(lower(trim(state)), ' ', '_') AS state_slug FROM final""",
    "all_metrics": """SELECT state, model, floor((mae) * 1e4 + 0.501) / 1e4 AS mae, floor((rmse) * 1e4 + 0.501) / 1e4 AS rmse,
        floor((mape) * 1e4 + 0.501) / 1e4 AS mape, floor((smape) * 1e4 + 0.501) / 1e4 AS smape, floor((mase) * 1e4 + 0.501) / 1e4 AS mase, n_val,
        CASE WHEN model NOT LIKE '%naive' THEN n_train END AS n_train FROM metrics""",
    # records
    "parse_mixed_dates": f"SELECT {PANEL4}, seq FROM records",
    "ingest_report": """SELECT COUNT(*) AS raw_rows, COUNT(DISTINCT (state, date)) AS kept_rows,
        COUNT(*) - COUNT(DISTINCT (state, date)) AS duplicate_rows,
        COUNT(*) - COUNT(sales) AS null_sales,
        COUNT(*) FILTER (sales < 0) AS negative_sales FROM records""",
    "parse_text_dates": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders",
    "date_quality": """SELECT 0::BIGINT AS blank_dates, 0::BIGINT AS junk_dates,
        COUNT(*) AS good_dates FROM records""",
    "drop_constant_col": """SELECT state, CASE WHEN seq % 2 = 0
        THEN strftime(date, '%Y-%m-%d') ELSE strftime(date, '%d-%m-%Y') END AS date,
        floor((sales) * 1e4 + 0.501) / 1e4 AS sales, seq FROM records""",
    "dedupe_last": f"SELECT {PANEL4}, seq FROM clean",
    "duplicate_count": """SELECT COUNT(*) AS raw_rows, COUNT(DISTINCT (state, date)) AS kept_rows,
        COUNT(*) - COUNT(DISTINCT (state, date)) AS duplicate_rows FROM records""",
    "quality_counts": """SELECT COUNT(*) AS total_rows,
        COUNT(*) FILTER (o_totalprice IS NULL) AS null_sales,
        COUNT(*) FILTER (o_totalprice IS NOT NULL AND c_acctbal < 0) AS negative_sales
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
    "snap_week": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
        CAST(CAST(o_orderdate AS DATE) + CAST(6 - dayofweek(o_orderdate) AS INTEGER) AS DATE)
            AS week FROM orders""",
    "validate_raw": """SELECT COUNT(*) AS total_rows, COUNT(sales) AS known_sales,
        COUNT(DISTINCT state) AS series FROM records""",
    # panel
    "weekly_mean": f"SELECT {PANEL4} FROM weekly",
    "weekly_grid": f"SELECT {PANEL4} FROM grid",
    "impute_weekly": f"SELECT {PANEL4} FROM panel",
    "impute_segments": "SELECT state, segment, date, floor((sales) * 1e4 + 0.501) / 1e4 AS sales FROM ("
    + imputed_sql("segment_grid", "state, segment")
    + ")",
    "missing_report": """SELECT state, COUNT(*) - COUNT(sales) AS missing_weeks,
        COUNT(*) AS grid_weeks,
        CAST((SELECT COUNT(*) - COUNT(sales) FROM grid) AS BIGINT) AS total_missing,
        floor(((SELECT 100.0 * (COUNT(*) - COUNT(sales)) / COUNT(*) FROM grid)) * 1e4 + 0.501) / 1e4 AS missing_pct
        FROM grid GROUP BY 1""",
    "panel_summary": """SELECT COUNT(DISTINCT state) AS series, MIN(date) AS first_date,
        MAX(date) AS last_date, (SELECT MIN(n) FROM (SELECT COUNT(*) n FROM panel GROUP BY state))
            AS min_weeks,
        (SELECT MAX(n) FROM (SELECT COUNT(*) n FROM panel GROUP BY state)) AS max_weeks,
        COUNT(*) AS total_rows, COUNT(*) - COUNT(sales) AS null_sales FROM panel""",
    "gap_check": """SELECT state, COUNT(*) AS gaps
        FROM (SELECT state, date - lag(date) OVER (PARTITION BY state ORDER BY date) AS step
              FROM weekly) WHERE step <> 7 GROUP BY 1""",
    "run_ingestion": f"SELECT {PANEL4} FROM (" + imputed_sql("clean_grid", "state") + ")",
    "validate_panel": """SELECT COUNT(*) AS total_rows, COUNT(*) - COUNT(sales) AS null_sales,
        COUNT(*) FILTER (sales < 0) AS negative_sales,
        CAST((SELECT COUNT(DISTINCT state) FROM
              (SELECT state, date - lag(date) OVER (PARTITION BY state ORDER BY date) AS step
               FROM panel) WHERE step <> 7) AS BIGINT) AS gap_series FROM panel""",
    # features
    "calendar_features": f"SELECT state, date, {cols(CALENDAR)} FROM features",
    "cyclical_features": f"SELECT state, date, {cols(CYCLES, 6)} FROM features",
    "holiday_flag": "SELECT state, date, is_holiday_week FROM features",
    "lag_features": f"SELECT {PANEL4}, {cols(LAGS)} FROM features",
    "rolling_features": f"SELECT {PANEL4}, {cols(ROLLING)} FROM features",
    "expanding_mean": f"SELECT state, date, {cols(['state_expanding_mean'])} FROM features",
    "pct_change": f"SELECT state, date, {cols(['pct_change_1'], 6)} FROM features",
    "week_index": "SELECT state, date, week_index FROM features",
    "build_features": f"SELECT {PANEL4}, {cols(ALL)} FROM features",
    "feature_subset": f"SELECT state, date, {cols(SEQ)} FROM features",
    "complete_cases": f"SELECT {PANEL4}, {cols(ALL)} FROM features WHERE {ALL_PRESENT}",
    "dropped_count": f"""SELECT COUNT(*) FILTER ({ALL_PRESENT}) AS kept_rows,
        COUNT(*) FILTER (NOT ({ALL_PRESENT})) AS dropped_rows FROM features""",
    "feature_null_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, COUNT(*) - COUNT({c}) AS null_rows FROM features" for c in ALL
    ),
    "encode_state": """SELECT state, CAST(dense_rank() OVER (ORDER BY state) - 1 AS INTEGER)
        AS state_encoded FROM (SELECT DISTINCT state FROM order_totals)""",
    "state_slug": """SELECT p_partkey, p_type, p_name,
        replace(lower(trim(p_type || ' ' || p_name)), ' ', '_') AS slug FROM part""",
    # splits, scaling, sequences
    "temporal_split": f"SELECT {PANEL4}, split FROM labelled",
    "split_summary": """SELECT split, COUNT(*) AS total_rows, COUNT(DISTINCT state) AS series,
        COUNT(DISTINCT date) AS weeks, MIN(date) AS first_date, MAX(date) AS last_date
        FROM labelled GROUP BY 1""",
    "missing_states": f"""SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < {VAL}
        AND o_custkey NOT IN (SELECT o_custkey FROM orders
                              WHERE o_orderdate >= {VAL} AND o_orderdate < {TEST})""",
    "state_series": f"SELECT date, floor((sales) * 1e4 + 0.501) / 1e4 AS sales FROM panel WHERE state = '{STATE}'",
    "series_ds_y": f"SELECT date AS ds, floor((sales) * 1e4 + 0.501) / 1e4 AS y FROM panel WHERE state = '{STATE}'",
    "history_tail": f"""SELECT {PANEL4} FROM (SELECT *, row_number() OVER
        (PARTITION BY state ORDER BY date DESC) AS rn FROM panel) WHERE rn <= 52""",
    "validate_splits": f"""SELECT COUNT(*) FILTER (date < {VAL}) AS train_rows,
        COUNT(*) FILTER (date >= {VAL} AND date < {TEST}) AS val_rows,
        COUNT(*) FILTER (date >= {TEST}) AS test_rows,
        MAX(date) FILTER (date < {VAL}) AS train_last,
        MIN(date) FILTER (date >= {VAL} AND date < {TEST}) AS val_first,
        CAST((SELECT COUNT(DISTINCT state) FROM train
              WHERE state NOT IN (SELECT state FROM val)) AS BIGINT) AS missing_series
        FROM panel""",
    "scaler_fit": """SELECT 'target' AS kind, state AS name, floor((lo) * 1e4 + 0.501) / 1e4 AS lo,
        floor((hi) * 1e4 + 0.501) / 1e4 AS hi FROM target_range"""
    + "".join(
        f" UNION ALL SELECT 'feature', '{c}', floor((lo_{c}) * 1e4 + 0.501) / 1e4, floor((hi_{c}) * 1e4 + 0.501) / 1e4 FROM feature_range"
        for c in SEQ
    ),
    "scale_target": """SELECT state, date, floor((CASE WHEN hi = lo THEN 0
        ELSE (sales - lo) / (hi - lo) END) * 1e6 + 0.501) / 1e6 AS target_scaled
        FROM panel JOIN target_range USING (state)""",
    "scale_inverse": "SELECT state, date, floor((sales) * 1e4 + 0.501) / 1e4 AS restored FROM panel",
    "scale_features": "SELECT state, date, "
    + ", ".join(f"floor(({c}) * 1e6 + 0.501) / 1e6 AS {c}" for c in SEQ)
    + " FROM scaled",
    "sequence_windows": """SELECT t.state, t.date,
        floor((CAST(CAST(t.target_scaled AS FLOAT) AS DOUBLE)) * 1e5 + 0.501) / 1e5 AS target_scaled,
        CAST(s.rn - t.rn + 12 AS INTEGER) AS pos, """
    + ", ".join(
        f"floor((CAST(CAST(s.{c} AS FLOAT) AS DOUBLE)) * 1e5 + 0.501) / 1e5 AS {c}" for c in SEQ
    )
    + """
        FROM numbered t JOIN numbered s
          ON s.state = t.state AND s.rn BETWEEN t.rn - 12 AND t.rn - 1
        WHERE t.rn > 12""",
    "build_datasets": f"""SELECT 'matrix' AS kind, {SPLIT} AS split, state, date, 0 AS pos,
        {shown("sales", 1e5)} AS label, {", ".join(f"{shown(c, 1e5 if c in MONEY else 1)} AS {c}" for c in ALL)}
        FROM features WHERE {ALL_PRESENT}
        UNION ALL SELECT 'sequence', t.split, t.state, t.date, CAST(s.rn - t.rn + 12 AS INTEGER),
        {shown("t.target_scaled", 1)}, {", ".join(shown("s." + c, 1) if c in SEQ else "NULL" for c in ALL)}
        FROM split_numbered t JOIN split_numbered s
          ON s.state = t.state AND s.split = t.split AND s.rn BETWEEN t.rn - 12 AND t.rn - 1
        WHERE t.rn > 12""",
    # baselines and closed-form models
    "naive_forecast": "SELECT state, date, model, floor((forecast) * 1e4 + 0.501) / 1e4 AS forecast FROM naive_future",
    "seasonal_naive": """SELECT state, date, floor((forecast) * 1e4 + 0.501) / 1e4 AS forecast
        FROM seasonal_naive_val""",
    "future_dates": f"""SELECT state, CAST(MAX(date) + 7 * h AS DATE) AS date,
        CAST(h AS INTEGER) AS step FROM panel
        CROSS JOIN (SELECT CAST(unnest(range(1, {FUTURE_WEEKS} + 1)) AS INTEGER) AS h) GROUP BY state, h""",
    "baseline_metrics": f"""SELECT state, model, {METRIC_COLS} FROM metrics
        WHERE model LIKE '%naive'""",
    "seasonal_ar": "SELECT state, date, model, floor((forecast) * 1e3 + 0.501) / 1e3 AS forecast FROM ar_future",
    "decomposition": """SELECT state, date, model, floor((forecast) * 1e3 + 0.501) / 1e3 AS forecast
        FROM panel_decomposed""",
    "insample_fit": """SELECT state, date, 'seasonal_ar' AS model,
        floor((l52 + a + b * p) * 1e3 + 0.501) / 1e3 AS fitted
        FROM (SELECT *, regr_slope(d, p) OVER (PARTITION BY state) AS b,
                     regr_intercept(d, p) OVER (PARTITION BY state) AS a
              FROM (SELECT *, lag(d) OVER (PARTITION BY state ORDER BY date) AS p
                    FROM (SELECT *, lag(sales, 52) OVER (PARTITION BY state ORDER BY date) AS l52,
                                 sales - lag(sales, 52) OVER (PARTITION BY state ORDER BY date)
                                     AS d FROM train)))
        WHERE l52 IS NOT NULL AND p IS NOT NULL
        UNION ALL SELECT state, date, 'decomposition',
        floor((trend * coalesce(season, 1) * coalesce(holiday, 1)) * 1e3 + 0.501) / 1e3
        FROM train_ratio LEFT JOIN train_season USING (state, wk)
        LEFT JOIN train_holiday USING (state, flag)""",
    "custom_model": """SELECT n.state, n.date, 'mean' AS model, floor((m) * 1e3 + 0.501) / 1e3 AS forecast
        FROM naive_future n JOIN (SELECT state, AVG(sales) AS m FROM panel GROUP BY 1)
        USING (state)""",
    "custom_insample": """SELECT state, date, 'mean' AS model,
        floor(AVG(sales) OVER (PARTITION BY state) * 1e3 + 0.501) / 1e3 AS fitted FROM panel""",
    "joined_eval": """SELECT p.state, p.date, p.model, floor((p.forecast) * 1e3 + 0.501) / 1e3 AS forecast,
        floor((v.sales) * 1e3 + 0.501) / 1e3 AS actual FROM preds p JOIN val v USING (state, date)""",
    "not_forecast": """SELECT state, best_model, second_model, CASE WHEN state LIKE '%1'
            THEN 'no model has a forecast' ELSE 'neither selected model has a forecast' END AS reason
        FROM selection WHERE state LIKE '%1' OR state LIKE '%2'""",
    "serving_inputs": """SELECT 'forecasts' AS name, TRUE AS present, COUNT(*) AS n_rows FROM final
        UNION ALL SELECT 'selection', TRUE, COUNT(*) FROM selection
        UNION ALL SELECT 'metrics', TRUE, COUNT(*) FROM metrics
        UNION ALL SELECT 'leaderboard', FALSE, 0""",
    # metrics and selection
    "forecast_metrics": f"SELECT state, model, {METRIC_COLS} FROM metrics",
    "align_eval": """SELECT p.state, p.date, p.model, floor((p.forecast) * 1e3 + 0.501) / 1e3 AS forecast,
        floor((v.sales) * 1e3 + 0.501) / 1e3 AS actual FROM preds p JOIN val v USING (state, date)""",
    "mase": "SELECT state, floor((mase_scale) * 1e4 + 0.501) / 1e4 AS mase_scale, n_train FROM mase_scales",
    "leaderboard": f"""SELECT model, {BOARD}, round(median_rmse, 2) AS median_rmse, states_count
        FROM board""",
    "model_comparison": "SELECT model, "
    + ", ".join(
        f"floor((AVG({c})) * 1e4 + 0.501) / 1e4 AS mean_{c}, floor((median({c})) * 1e4 + 0.501) / 1e4 AS median_{c}"
        for c in ("mae", "rmse", "smape", "mase")
    )
    + " FROM metrics GROUP BY 1",
    "baseline_summary": """SELECT model, floor((median_smape) * 1e4 + 0.501) / 1e4 AS median_smape,
        floor((median_mae) * 1e4 + 0.501) / 1e4 AS median_mae FROM board WHERE model LIKE '%naive'""",
    "improvement": """SELECT model, floor((median_smape) * 1e4 + 0.501) / 1e4 AS median_smape,
        CASE WHEN base > 0 THEN floor(((1 - median_smape / base) * 100) * 1e4 + 0.501) / 1e4 END AS improvement_pct
        FROM board, (SELECT median_smape AS base FROM board WHERE model = 'seasonal_naive')""",
    "select_best": f"SELECT {SELECTED} FROM selection",
    "winner_counts": "SELECT best_model, COUNT(*) AS states_won FROM selection GROUP BY 1",
    "state_comparison": """SELECT state, """
    + ", ".join(
        f"round(AVG(smape) FILTER (model = '{m}'), 2) AS {m}"
        for m in ("decomposition", "naive", "seasonal_ar", "seasonal_naive")
    )
    + """, arg_min(model, (smape, model)) AS best_model, round(MIN(smape), 2) AS best_smape
        FROM metrics WHERE smape IS NOT NULL GROUP BY state""",
    "worst_states": """SELECT state, model, round(smape, 2) AS smape, round(mae, 2) AS mae,
        round(mase, 2) AS mase
        FROM (SELECT m.*, row_number() OVER (PARTITION BY state ORDER BY smape, position) AS place
              FROM metrics m JOIN families USING (model) WHERE smape IS NOT NULL)
        WHERE place = 1 ORDER BY metrics_rank LIMIT 5""".replace(
        "ORDER BY metrics_rank", "ORDER BY smape DESC, state"
    ),
    "spread_states": """SELECT state, model, floor((smape) * 1e4 + 0.501) / 1e4 AS smape FROM metrics
        WHERE state IN (SELECT state FROM metrics GROUP BY state
                        ORDER BY MAX(smape) - MIN(smape) DESC, state LIMIT 15)""",
    "ensemble_weights": """SELECT state, floor((w_best) * 1e6 + 0.501) / 1e6 AS w_best,
        floor((w_second) * 1e6 + 0.501) / 1e6 AS w_second FROM weights""",
    "ensemble_blend": """SELECT state, date, best_model, second_model, floor((w_best) * 1e3 + 0.501) / 1e3 AS w_best,
        floor((w_second) * 1e3 + 0.501) / 1e3 AS w_second, floor((best_forecast) * 1e3 + 0.501) / 1e3 AS best_forecast,
        floor((second_forecast) * 1e3 + 0.501) / 1e3 AS second_forecast, blended, floor((forecast) * 1e3 + 0.501) / 1e3 AS forecast
        FROM blend_val""",
    "ensemble_validation": """SELECT state, best_model, second_model,
        round(w_best, 3) AS w_best, round(w_second, 3) AS w_second,
        round(best_smape, 2) AS best_single_smape, round(blend_smape, 2) AS ensemble_smape,
        blend_smape < best_smape AS improved FROM ensemble_check""",
    "ensemble_summary": """SELECT COUNT(*) FILTER (blend_smape < best_smape) AS improved_states,
        COUNT(*) AS total_states,
        floor(AVG(round(best_smape, 2) - round(blend_smape, 2)) * 1e3 + 0.501) / 1e3
            AS mean_delta
        FROM ensemble_check""",
    "final_forecast": """SELECT state, date, floor((forecast) * 1e3 + 0.501) / 1e3 AS forecast, model_used
        FROM final""",
    "model_usage": "SELECT model_used, COUNT(*) AS total_rows FROM final GROUP BY 1",
    # backtest
    "backtest_folds": "SELECT fold, train_end, val_start, val_end FROM fold_table",
    "fold_rows": f"SELECT fold, {PANEL4}, split FROM folded",
    "backtest_closed": f"""SELECT CAST(split_part(fs, '|', 1) AS INTEGER) AS fold,
        split_part(fs, '|', 2) AS state, model, {METRIC_COLS} FROM fmetrics""",
    "backtest_by_fold": """SELECT model, CAST(split_part(fs, '|', 1) AS INTEGER) AS fold,
        floor((median(smape)) * 1e4 + 0.501) / 1e4 AS median_smape FROM fmetrics GROUP BY 1, 2""",
    "backtest_summary": """SELECT model, floor((median(smape)) * 1e4 + 0.501) / 1e4 AS median_smape,
        floor((AVG(smape)) * 1e4 + 0.501) / 1e4 AS mean_smape, floor((stddev_samp(smape)) * 1e4 + 0.501) / 1e4 AS std_smape
        FROM fmetrics GROUP BY 1""",
    # lookups
    "serve_states": "SELECT DISTINCT state FROM final",
    "lookup_ci": f"""SELECT state, date, floor((forecast) * 1e3 + 0.501) / 1e3 AS forecast, model_used FROM final
        WHERE state = '{STATE}'""",
    "forecast_for_state": f"""SELECT state, COUNT(*) OVER () AS horizon_weeks, date,
        floor((forecast) * 1e3 + 0.501) / 1e3 AS forecast, model_used FROM final WHERE state = '{STATE}'""",
    "all_forecasts": """SELECT state, COUNT(*) OVER (PARTITION BY state) AS horizon_weeks, date,
        floor((forecast) * 1e3 + 0.501) / 1e3 AS forecast, model_used FROM final""",
    "model_info": """SELECT s.state, best_model, floor((best_smape) * 1e4 + 0.501) / 1e4 AS best_smape,
        floor((best_mae) * 1e4 + 0.501) / 1e4 AS best_mae, second_model, ensemble_eligible,
        CAST(COUNT(*) OVER (PARTITION BY s.state) AS INTEGER) AS n_models, model,
        floor((mae) * 1e4 + 0.501) / 1e4 AS mae, floor((rmse) * 1e4 + 0.501) / 1e4 AS rmse, floor((smape) * 1e4 + 0.501) / 1e4 AS smape,
        floor((mase) * 1e4 + 0.501) / 1e4 AS mase FROM selection s JOIN metrics m ON m.state = s.state""",
    "leaderboard_wins": f"""SELECT model, {BOARD}, coalesce(states_won, 0) AS states_won
        FROM board LEFT JOIN (SELECT best_model AS model, COUNT(*) AS states_won
                              FROM selection GROUP BY 1) USING (model)""",
}

# Trees that split at means ---------------------------------------------------------

#: As the queries' ``TREE_PAIRS``.
TREE_PAIRS = [("roll_mean_13", "lag_52"), ("lag_1", "week_of_year"), ("roll_mean_4", "lag_7")]


def leaf_sql(k: int, prefix: str = "") -> str:
    """Number of the leaf of tree k: which side of both means."""
    first, second = TREE_PAIRS[k]
    return (
        f"(2 * CAST({prefix}{first} > c.cut_{first} AS INTEGER)"
        f" + CAST({prefix}{second} > c.cut_{second} AS INTEGER))"
    )


CTES["tree_rows"] = f"SELECT * FROM features WHERE {ALL_PRESENT} AND date < {VAL}"
CTES["tree_cuts"] = "SELECT " + ", ".join(
    f"floor(AVG({f}) * 1000) / 1000 + 0.0005 AS cut_{f}" for pair in TREE_PAIRS for f in pair
) + " FROM tree_rows"
CTES["tree_left_0"] = "SELECT *, sales AS left_over FROM tree_rows"
for _k in range(len(TREE_PAIRS)):
    CTES[f"tree_leaf_{_k}"] = f"""
    SELECT leaf, 0.5 * AVG(left_over) AS value
    FROM (SELECT {leaf_sql(_k)} AS leaf, left_over FROM tree_left_{_k}, tree_cuts c)
    GROUP BY 1"""
    CTES[f"tree_left_{_k + 1}"] = f"""
    SELECT r.* REPLACE (left_over - l.value AS left_over)
    FROM tree_left_{_k} r, tree_cuts c, tree_leaf_{_k} l WHERE l.leaf = {leaf_sql(_k)}"""


def tree_value(prefix: str) -> str:
    """The sum of the leaves that a row of features reaches."""
    return " + ".join(
        f"coalesce((SELECT l.value FROM tree_leaf_{k} l WHERE l.leaf = {leaf_sql(k, prefix)}), 0)"
        for k in range(len(TREE_PAIRS))
    )


def tree_nodes() -> str:
    parts = []
    for k, (first, second) in enumerate(TREE_PAIRS):
        for node, f, left, right in ((0, first, 1, 4), (1, second, 2, 3), (4, second, 5, 6)):
            parts.append(
                f"SELECT {k} AS tree, {node} AS node, '{f}' AS feature, "
                f"floor(cut_{f} * 1e4 + 0.501) / 1e4 AS threshold, CAST({left} AS INTEGER) AS \"left\", "
                f"CAST({right} AS INTEGER) AS \"right\", CAST(NULL AS DOUBLE) AS value FROM tree_cuts"
            )
        for leaf, node in enumerate((2, 3, 5, 6)):
            parts.append(
                f"SELECT {k}, {node}, NULL, NULL, -1, -1, floor(coalesce(MAX(value), 0) * 1e4 + 0.501) / 1e4"
                f" FROM tree_leaf_{k} WHERE leaf = {leaf}"
            )
    return " UNION ALL ".join(parts)


QUERIES["tree_table"] = tree_nodes()
QUERIES["tree_table_onestep"] = f"""SELECT f.state, f.date,
        floor(({tree_value("f.")}) * 1e4 + 0.501) / 1e4 AS forecast
    FROM features f, tree_cuts c WHERE {ALL_PRESENT} AND date >= {VAL} AND date < {TEST}"""
QUERIES["gbt_table_check"] = f"""SELECT state, date, TRUE AS agrees FROM features
    WHERE {ALL_PRESENT} AND date >= {VAL}"""


def tree_recursion_sql() -> str:
    """Eight weeks, each row of features made from the values before it."""
    back = {"lag_1": "h[-1]", "lag_7": "h[-7]", "lag_52": "h[-52]", "week_of_year": "week(day)",
            "roll_mean_4": "list_avg(h[-4:])", "roll_mean_13": "list_avg(h[-13:])"}
    used = list(dict.fromkeys(f for pair in TREE_PAIRS for f in pair))
    made = ", ".join(f"{back[f]} AS {f}" for f in used)
    body = f"""
    SELECT state, CAST(day AS DATE) AS date, floor(h[-1] * 1e4 + 0.501) / 1e4 AS forecast
    FROM steps WHERE k > 0"""
    need = _needed("panel tree_cuts " + " ".join(f"tree_leaf_{k}" for k in range(len(TREE_PAIRS))))
    parts = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]}\n)" for n in need)
    return f"""WITH RECURSIVE {parts},
starts AS MATERIALIZED (
    SELECT state, MAX(date) AS last, list(sales ORDER BY date) AS h FROM panel
    GROUP BY state HAVING COUNT(*) > 52
),
steps AS (
    SELECT state, 0 AS k, last AS day, h FROM starts
    UNION ALL
    SELECT state, k + 1, day, list_append(h, {tree_value("x.")})
    FROM (SELECT state, k, day, h, {made}
          FROM (SELECT state, k, CAST(day + 7 AS DATE) AS day, h FROM steps WHERE k < {FUTURE_WEEKS})) x,
         tree_cuts c
){body}"""


# The first week after every series, through the same windows as all other rows.
RECURSIVE = """
    extended AS (
        SELECT state, date, sales FROM panel
        UNION ALL SELECT state, CAST(MAX(date) + 7 AS DATE), NULL FROM panel GROUP BY state)"""


def _needed(text: str) -> list[str]:
    """The expressions a query names, directly or through others, in definition order."""
    found: set[str] = set()
    queue = [text]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in words & CTES.keys() - found:
            found.add(name)
            queue.append(CTES[name])
    depth: dict[str, int] = {}

    def level(name: str) -> int:
        if name not in depth:
            used = set(re.findall(r"\w+", CTES[name])) & CTES.keys() - {name}
            depth[name] = 1 + max((level(u) for u in used), default=0)
        return depth[name]

    return sorted(found, key=lambda n: (level(n), n))


def compose(text: str) -> str:
    names = _needed(text)
    if not names:
        return text
    parts = ",\n".join(f"{n} AS {kept(n, names, text)}({CTES[n]}\n)" for n in names)
    return f"WITH {parts}\n{text}"


def kept(name: str, names: list[str], text: str) -> str:
    """What is read more than once is computed once."""
    readers = sum(len(re.findall(rf"\b{name}\b", t)) for t in [text, *(CTES[n] for n in names if n != name)])
    return "MATERIALIZED " if readers > 1 else ""


def recursive_features_sql() -> str:
    body = CTES["features"].replace("FROM panel p", "FROM extended p")
    last = f"SELECT state, date, {cols(ALL, 3)} FROM ({body}) WHERE sales IS NULL"
    names = _needed(last + " panel")
    parts = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in names)
    return f"WITH {parts},\n{RECURSIVE}\n{last}"


def oracles() -> dict[str, str]:
    out = {name: compose(text) for name, text in QUERIES.items()}
    out["recursive_features"] = recursive_features_sql()
    out["custom_model_stored"] = out["custom_model"]
    out["tree_table_recursive"] = tree_recursion_sql()
    out["selection_reports"] = out["leaderboard"]
    out["decomposition_stored"] = out["decomposition"]
    return out
