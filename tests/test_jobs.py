"""Whole jobs from files to reports."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from harborline import jobs
from harborline.operators import panel, regression
from harborline.session import scratch_path
from harborline.sources import readers


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    rng = np.random.default_rng(9)
    lines = ["tran_br_code,start_date,txn_hour,TOTAL_DR,TOTAL_CR"]
    for b in (1, 2):
        for i, d in enumerate(pd.date_range("2024-01-01", "2024-09-30")):
            if i % 11 == 5:
                continue
            for h in (9, 15):
                wd, dep = 50 + 10 * d.dayofweek + rng.normal(), 40 + 5 * b + rng.normal()
                lines.append(f"{b},{d:%d/%m/%Y},{h},{wd:.2f},{dep:.2f}")
    lines += [",01/02/2024,9,1,1", "1,never,9,1,1", "2,02/02/2024,x,bad,"]
    path = tmp_path_factory.mktemp("in") / "t.csv"
    path.write_text("\n".join(lines))
    rows = jobs.read_transactions(spark, str(path))
    target = scratch_path(spark, "store")
    paths = jobs.build_feature_store(spark, rows, target, dt.date(2024, 7, 1), dt.date(2024, 8, 15), dt.date(2024, 9, 28))
    return paths


def test_feature_store(spark, store):
    features = spark.read.parquet(store["features"])
    assert len(panel.feature_columns(features.columns)) == 49
    checks = {r.check: r.ok for r in spark.read.json(store["checks"]).collect()}
    assert checks["chronological_splits"] and checks["splits_not_empty"] and not checks["enough_rows"]
    coverage = spark.read.option("header", True).csv(store["coverage"]).collect()
    assert {r.expected_days for r in coverage} == {"274"} and all(int(r.missing_days) in (24, 25) for r in coverage)
    assert spark.read.json(store["baselines"]).count() == 6


def test_models_and_forecast(spark, store):
    features = spark.read.parquet(store["features"])
    predictors = ["dayofweek", "daily_withdrawals_7p_lag", "daily_deposits_7p_lag", "daily_withdrawals_7p_rolling_mean", "daily_deposits_7p_rolling_mean"]
    models = {"linear_regression": regression.linear_regression, "ridge": regression.ridge}
    best = {r.target: r.model for r in jobs.select_models(features, predictors, models, folds=2, min_train=90).collect()}
    assert set(best) == set(panel.TARGETS) and set(best.values()) <= set(models)
    tested = {(r.target, r["name"]): r.mae for r in jobs.test_models(features, predictors, best).collect()}
    assert tested["daily_withdrawals", "model"] < tested["daily_withdrawals", "roll7_avg_baseline"]
    made, guidance = jobs.forecast(features, predictors, best, dt.date(2024, 9, 20), 3)
    assert made.count() == 6 and guidance.count() == 2
    origin = dt.date(2024, 9, 20)
    models, medians = jobs.fit_models(features, predictors, best, origin)
    assert set(medians) == set(predictors)
    models["daily_deposits"] = regression.random_forest(features.where("daily_deposits is not null").fillna(medians), predictors, "daily_deposits", trees=3, depth=3)
    folder = jobs.save_models(spark, models, medians, scratch_path(spark, "models"))
    again, same = jobs.load_models(spark, folder)
    assert same == medians and {t: m.features for t, m in again.items()} == {t: predictors for t in panel.TARGETS}
    rows = lambda m: sorted(map(tuple, jobs.forecast_with(m, medians, features, origin, 2)[0].collect()))
    assert rows(again) == rows(models)
    branch = features.select(panel.BRANCH).first()[0]
    one, _ = jobs.forecast_with(models, medians, features, origin, 2, branches=[branch])
    assert {r.branch_code for r in one.collect()} == {branch} and one.count() == 2
    for bad in ({"branches": [branch, -7]}, {"days": 0}, {"origin": dt.date(2030, 1, 1)}):
        with pytest.raises(ValueError):
            jobs.forecast_with(models, medians, features, **{"origin": origin, "days": 1, **bad})


def test_random_search_orders_parameters_by_error(spark, store):
    features = spark.read.parquet(store["features"])
    predictors = ["dayofweek", "daily_withdrawals_7p_lag"]
    data, _ = jobs.prepare(features, predictors)
    known = data.where("split <> 'test'")
    folds = panel.expanding_folds(known, folds=2, min_train=90)
    found = regression.random_search(known, folds, panel.DATE, predictors, "daily_withdrawals", regression.ridge, {"alpha": [0.1, 10.0, 1e6]}, 2)
    rows = found.collect()
    assert len(rows) == 2 and rows[0].mae <= rows[1].mae and all('"alpha"' in r.params and r.folds == 2 for r in rows)


def test_index_and_ask(spark):
    docs = readers.rows(spark, [("Annual leave needs approval.", "leave.txt", None), ("Rotate passwords often.", "security.txt", None), ("Rotate passwords often.", "security.txt", None)], "text string, source string, page int")
    first = jobs.index_documents(spark, docs, scratch_path(spark, "index"))
    second = jobs.index_documents(spark, docs, scratch_path(spark, "index"), stored=first)
    assert spark.read.parquet(second).count() == 2
    questions = readers.rows(spark, [(1, "Who approves annual leave?")], "question_id int, text string")
    answers, hits = jobs.ask(spark, second, questions)
    assert "leave.txt" in answers.first().answer and hits.where("rank = 1").first().source == "leave.txt"
    with pytest.raises(ValueError, match="empty"):
        jobs.ask(spark, second, readers.rows(spark, [(1, "  ")], "question_id int, text string"))


def test_clean_table(spark):
    rows = [("1", "03/01/2024", 10.0, 4, "a", -5.0)] * 2 + [("1", "04/01/2024", None, None, None, 7.0), ("2", "x", 1.0, 1, "b", 1.0), (None, "05/01/2024", 1.0, 1, "b", 1.0)]
    df = spark.createDataFrame(rows, "branch string, posting_date string, total_dr double, visits int, kind string, cash_balance double")
    out = sorted(jobs.clean_table(df).collect(), key=lambda r: r.posting_date)
    assert [r.posting_date for r in out] == [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]
    assert out[1].total_dr == 0.0 and out[1].kind == "Unknown" and out[1].visits is not None and out[0].cash_balance == 0.0
