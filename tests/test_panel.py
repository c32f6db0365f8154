"""The panel, its features and the forecasts, against pandas and plain loops."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from harborline.functions.calendar import calendar_features
from harborline.operators import checks, forecasting, metrics, panel, regression


@pytest.fixture(scope="module")
def daily():
    rng = np.random.default_rng(5)
    days = pd.date_range("2024-01-01", "2024-04-30")
    rows = [(b, d.date(), round(float(rng.uniform(1, 100)), 2), round(float(rng.uniform(1, 100)), 2)) for b in (1, 2, 3) for d in days if rng.random() < 0.7 or d in (days[0], days[-1])]
    return pd.DataFrame(rows, columns=["tran_br_code", "start_date", "daily_withdrawals", "daily_deposits"])


@pytest.fixture(scope="module")
def frame(spark, daily):
    return spark.createDataFrame(daily, "tran_br_code int, start_date date, daily_withdrawals double, daily_deposits double")


def reindexed(daily):
    days = pd.date_range(daily.start_date.min(), daily.start_date.max())
    parts = []
    for b, rows in daily.groupby("tran_br_code"):
        full = rows.assign(start_date=pd.to_datetime(rows.start_date)).set_index("start_date").reindex(days)
        parts.append(full.assign(tran_br_code=b).rename_axis("start_date").reset_index())
    return pd.concat(parts, ignore_index=True)


def test_lags_and_rolling_equal_pandas(frame, daily):
    got = panel.add_rolling(panel.add_lags(panel.complete_grid(frame))).toPandas()
    got = got.sort_values(["tran_br_code", "start_date"]).reset_index(drop=True)
    grid = reindexed(daily)
    for t in panel.TARGETS:
        by = grid.groupby("tran_br_code")[t]
        for k in panel.LAGS:
            np.testing.assert_allclose(got[f"{t}_{k}p_lag"], by.shift(k))
        for w in panel.ROLLING:
            for stat in ("mean", "std", "min", "max"):
                expected = by.transform(lambda x: getattr(x.rolling(w, min_periods=1), stat)().shift(1))
                np.testing.assert_allclose(got[f"{t}_{w}p_rolling_{stat}"].astype(float), expected, rtol=1e-9, atol=1e-6)


def test_calendar_equals_pandas(spark):
    days = pd.date_range("2023-12-25", "2025-01-10")
    got = calendar_features(spark.createDataFrame([(d.date(),) for d in days], "d date"), "d").orderBy("d").toPandas()
    dts = pd.Series(days).dt
    assert got.dayofweek.tolist() == dts.dayofweek.tolist()
    assert got.weekofyear.tolist() == dts.isocalendar().week.tolist()
    for name in ("is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end"):
        assert got[name].tolist() == getattr(dts, name).astype(int).tolist()


def test_week_parameter_selects_the_baseline_period(frame):
    df = panel.add_baselines(panel.add_rolling(panel.add_lags(panel.complete_grid(frame))), week=14)
    differs = df.where(~F.col("daily_deposits_prev_week_baseline").eqNullSafe(F.col("daily_deposits_14p_lag")))
    assert differs.count() == 0


def test_checks_pass_and_notice_a_wrong_lag(frame):
    grid = panel.complete_grid(frame)
    lagged = panel.add_lags(grid)
    raw = frame.select("tran_br_code", "start_date", F.col("daily_withdrawals").alias("wd"), F.col("daily_deposits").alias("dep"))
    assert all(r.ok for r in checks.stage_assertions(raw, frame, grid, lagged).collect())
    broken = lagged.withColumn("daily_withdrawals_7p_lag", F.col("daily_withdrawals_14p_lag"))
    assert {r.check for r in checks.stage_assertions(raw, frame, grid, broken).collect() if not r.ok} == {"lags_exact"}


def test_leak_is_reported(frame):
    df = panel.chrono_split(panel.panel_features(frame), F.lit(dt.date(2024, 3, 1)), F.lit(dt.date(2024, 4, 1)))
    names = panel.feature_columns(df.columns)
    assert not set(names) & set(panel.CURRENT_DAY)
    report = {r.check: r.ok for r in checks.integrity_report(df, [*names, "net_cash"]).collect()}
    assert report["no_target_leakage"] is False and report["chronological_splits"] is True


def test_metrics_without_pairs_are_null(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, None)], "a double, p double")
    row = metrics.flow_metrics(df, "a", "p", shortfalls=True).first()
    assert row.num_comparisons == 0 and row.mae is None and row.wape is None and row.max_shortfall is None


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(10.0, 8.0), (10.0, 13.0), (None, 4.0)], "a double, p double")
    row = metrics.flow_metrics(df, "a", "p", shortfalls=True).first()
    assert (row.mae, row.rmse, row.wape, row.underforecasting_rate, row.num_comparisons) == (2.5, 2.55, 0.25, 0.5, 2)
    assert (row.max_shortfall, row.total_shortfall) == (2.0, 2.0)


def test_missing_weekday_is_reported(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0)], "dayofweek int, a double, p double")
    rows = {r.weekday: r["count"] for r in metrics.metrics_by_weekday(df, "a", "p").collect()}
    assert len(rows) == 7 and rows["Monday"] == 1 and rows["Sunday"] == 0


def test_folds(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=2 * i) for i in range(400)]
    folds = panel.expanding_folds(spark.createDataFrame([(d,) for d in days], "start_date date")).orderBy("fold").collect()
    assert [f.fold for f in folds] == [1, 2, 3, 4, 5]
    for i, f in enumerate(folds):
        assert f.train_end == days[180 + 44 * i - 1] and f.val_start == days[180 + 44 * i] and f.val_end == days[180 + 44 * (i + 1) - 1]


def test_recursive_forecast_equals_a_loop(frame, daily):
    """A model that mixes a lag and two rolling statistics, followed day by day in plain Python."""
    origin, days = dt.date(2024, 4, 20), 7

    def predict(target):
        name = f"{target}_7p_rolling"
        value = F.col(f"{name}_mean") + 0.1 * F.col(f"{name}_std") + 0.2 * F.col(f"{target}_1p_lag") + 0.01 * F.col("dayofweek")
        return lambda df: df.withColumn("prediction", value)

    medians = {f"{t}_1p_lag": 5.0 for t in panel.TARGETS}
    got = forecasting.recursive_forecast(frame, origin, days, {t: predict(t) for t in panel.TARGETS}, medians).collect()
    assert len(got) == 3 * days
    for b, rows in daily.groupby("tran_br_code"):
        for t, name in (("daily_withdrawals", "predicted_withdrawals"), ("daily_deposits", "predicted_deposits")):
            known = dict(zip(rows.start_date, rows[t]))
            known = {d: v for d, v in known.items() if d < origin}
            for step in range(days):
                day = origin + dt.timedelta(days=step)
                last = [known[day - dt.timedelta(days=k)] for k in range(1, 8) if day - dt.timedelta(days=k) in known]
                lag = known.get(day - dt.timedelta(days=1), 5.0)
                spread = float(np.std(last, ddof=1)) if len(last) > 1 else 0.0
                known[day] = float(np.mean(last)) + 0.1 * spread + 0.2 * lag + 0.01 * day.weekday()
                row = next(r for r in got if r.branch_code == b and r.forecast_date == day)
                assert row[name] == pytest.approx(known[day], rel=1e-9)
    for r in got:
        assert r.predicted_net_cash == pytest.approx(r.predicted_deposits - r.predicted_withdrawals)
        assert r.predicted_cash_requirement == max(r.predicted_withdrawals - r.predicted_deposits, 0)


def test_expanding_cv_sees_only_the_past(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(240)]
    df = spark.createDataFrame([(d, float(i), 2.0 * i + 1) for i, d in enumerate(days)], "start_date date, x double, y double")
    folds = panel.expanding_folds(df, folds=2)
    seen = []

    def fit(train):
        seen.append(train.agg(F.max("start_date")).first()[0])
        return regression.linear_regression(train, ["x"], "y")

    cv = regression.expanding_cv(df, folds, "start_date", "y", {"ols": fit}).collect()
    assert len(cv) == 2 and all(r.mae == 0.0 for r in cv)
    assert seen == [f.train_end for f in folds.orderBy("fold").collect()]
