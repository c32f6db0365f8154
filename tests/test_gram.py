"""Linear models from summed blocks against MLlib, numpy and the conditions of their optimum."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from harborline.operators import evaluation, gram, regression

X = ["year", "amount", "share", "twin", "flat"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    n = 900
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=int(k)) for k in rng.integers(0, 300, n)]
    x = np.column_stack([2000 + rng.integers(0, 9, n), 1e7 + rng.normal(0, 2e5, n), rng.random(n), np.zeros(n), np.full(n, 3.0)])
    x[:, 3] = 2 * x[:, 2] - 1
    pdf = pd.DataFrame(x, columns=X).assign(day=days, y=5 * x[:, 0] - 0.01 * x[:, 1] + 700 * x[:, 2] + rng.normal(0, 40, n), z=rng.normal(size=n))
    pdf.loc[::7, "z"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("z", F.when(~F.isnan("z"), F.col("z")))
    return pdf, df.repartition(9)


@pytest.mark.parametrize("alpha", [0.0, 3.0, 1e6])
def test_equal_to_mllib(table, alpha):
    pdf, df = table
    names = X[:3]
    mine = gram.blocks(df, names, ["y"]).ridge("y", alpha)
    theirs = regression.ridge(df, names, "y", alpha) if alpha else regression.linear_regression(df, names, "y")
    np.testing.assert_allclose(mine.weights, theirs.model.coefficients.toArray(), rtol=1e-6)
    assert mine.intercept == pytest.approx(theirs.model.intercept, rel=1e-6)


def test_prefixes_of_days_targets_and_gaps(table):
    pdf, df = table
    cuts = [dt.date(2020, 3, 1), dt.date(2020, 6, 1), dt.date(2020, 9, 9)]
    found = gram.blocks(df.withColumn("slice", F.lit("x")), X[:3], ["y", "z"], "day", cuts, spread=3)
    for target in ("y", "z"):
        for cut in [*cuts, None]:
            rows = pdf[(pdf.day <= cut) if cut else True] if cut else pdf
            rows = rows[rows[target].notna()]
            x, y = rows[X[:3]].to_numpy(), rows[target].to_numpy()
            block = found.upto(target, cut)
            assert block.n == len(rows)
            xc, yc = x - x.mean(0), y - y.mean()
            model = found.ridge(target, 2.0, cut)
            np.testing.assert_allclose(model.weights, np.linalg.solve(xc.T @ xc + 2 * np.eye(3), xc.T @ yc), rtol=1e-6)
            w = np.array(found.lasso(target, 0.05, cut).weights)
            gap = xc.T @ (yc - xc @ w) / len(y)
            assert np.all(np.abs(gap[w == 0]) <= 0.05 * (1 + 1e-6))
            np.testing.assert_allclose(gap[w != 0], 0.05 * np.sign(w[w != 0]), rtol=1e-3, atol=1e-6 * np.abs(xc).max() * yc.std())


def test_constant_and_repeated_predictors_get_no_weight(table):
    pdf, df = table
    model = gram.blocks(df, X, ["y"]).ridge("y")
    assert model.weights[3] == 0 and model.weights[4] == 0
    same = gram.blocks(df, X[:3], ["y"]).ridge("y")
    np.testing.assert_allclose(model.weights[:3], same.weights, rtol=1e-9)
    error = F.abs(F.col("y") - F.col("prediction"))
    assert model.predict(df).agg(F.avg(error)).first()[0] < 40


def test_refusals_and_empty_parts(spark, table):
    _, df = table
    with pytest.raises(ValueError, match="no rows"):
        gram.blocks(df.where("false"), X, ["y"]).upto("y")
    with pytest.raises(Exception, match="impute first"):
        gram.blocks(df.withColumn("share", F.when(F.col("share") > 0.5, F.col("share"))), X, ["y"])
    missing = gram.blocks(df.withColumn("share", F.when(F.col("z").isNotNull(), F.col("share"))), X, ["z"])
    assert missing.upto("z").n == df.where("z is not null").count()


def test_cross_validation_equals_one_fit_at_a_time(spark, table):
    pdf, df = table
    folds = spark.createDataFrame(
        [(1, dt.date(2020, 4, 1), dt.date(2020, 4, 2), dt.date(2020, 5, 1)), (2, dt.date(2020, 5, 1), dt.date(2020, 5, 2), dt.date(2020, 7, 1))],
        "fold int, train_end date, val_start date, val_end date",
    )
    names = X[:3]
    found = gram.expanding_cv(df, folds, "day", ["y", "z"], names, {"ols": ("ridge", 0.0), "ridge": ("ridge", 50.0)})
    for target in ("y", "z"):
        one = regression.expanding_cv(df, folds, "day", target, {"ols": lambda t: regression.linear_regression(t, names, target), "ridge": lambda t: regression.ridge(t, names, target, 50.0)})
        rows = lambda d: sorted((r.model, r.fold, r.mae, r.rmse, r.num_comparisons) for r in d.collect())
        for a, b in zip(rows(found.where(F.col("target") == target)), rows(one)):
            assert a[:2] == b[:2] and a[4] == b[4] and a[2:4] == pytest.approx(b[2:4], abs=0.011)


def test_saved_weights_come_back(spark, table, tmp_path):
    model = gram.blocks(table[1], X[:3], ["y"]).ridge("y", 1.0)
    again = regression.load(regression.save(model, str(tmp_path / "m")))
    assert (again.features, again.weights, again.intercept) == (model.features, model.weights, model.intercept)


def test_strategies_and_baselines(spark):
    rows = [(10.0, 4.0, -6.0, 6.0, 9.0, 5.0, -5.0, 3.0), (2.0, 8.0, 6.0, 0.0, 4.0, 6.0, 6.0, -2.0), (1.0, 1.0, None, None, 1.0, 1.0, 0.0, 0.0)]
    names = ["daily_withdrawals", "daily_deposits", "net_cash", "cash_requirement"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, *(f"p_{n}" for n in names)]))
    found = {(r.target, r.strategy): (r.mae, r.num_comparisons, r.best) for r in evaluation.direct_vs_derived(df).collect()}
    assert found == {
        ("net_cash", "direct"): (0.5, 2, True), ("net_cash", "derived"): (3.0, 2, False),
        ("cash_requirement", "direct"): (1.5, 2, False), ("cash_requirement", "derived"): (1.0, 2, True),
    }
    against = {r.name: r for r in evaluation.against_baseline(df.withColumn("b", F.lit(4.0)), "daily_withdrawals", "p_daily_withdrawals", "b").collect()}
    assert against["model"].mae == 1.0 and against["baseline"].mae == 3.67 and against["baseline"].improvement_pct == 0.0 and against["model"].improvement_pct == pytest.approx(72.75, abs=0.01)
