"""Trend and seasons per series against numpy's least squares."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from harborline.operators import regression

BEFORE = dt.date(2021, 6, 1)


def design(days):
    t = np.array([(d - dt.date(1970, 1, 1)).days for d in days], dtype=float)
    columns = [np.ones_like(t), t - t.min()]
    for period, order in ((7.0, 2), (365.25, 3)):
        for n in range(1, order + 1):
            columns += [np.sin(2 * np.pi * n * t / period), np.cos(2 * np.pi * n * t / period)]
    return np.column_stack(columns)


def test_trend_equals_numpy(spark):
    rng = np.random.default_rng(2)
    days = [dt.date(2019, 1, 1) + dt.timedelta(days=k) for k in range(1_000)]
    parts = []
    for branch in ("a", "b", None):
        use = sorted(rng.choice(len(days), 800, replace=False))
        y = [1e5 + 300 * k + 2e4 * np.sin(k / 3) + rng.normal(0, 1e3) for k in use]
        parts.append(pd.DataFrame({"k": branch, "d": [days[k] for k in use], "y": y}))
    pdf = pd.concat(parts, ignore_index=True)
    late = pd.DataFrame({"k": "late", "d": [BEFORE, BEFORE + dt.timedelta(days=1)], "y": [1.0, 2.0]})
    rows = [tuple(x) for x in pd.concat([pdf, late]).itertuples(index=False)] + [("a", days[3], None)]
    df = spark.createDataFrame(rows, "k string, d date, y double").withColumn("_m", F.lit(1)).repartition(6)
    found = regression.trend_seasonal(df, "k", "d", "y", BEFORE).collect()
    assert len(found) == len(rows)
    assert all(r.prediction is None for r in found if r.k == "late")
    for branch in ("a", "b", None):
        mine = sorted((r for r in found if r.k == branch), key=lambda r: (r.d, r.y is None))
        x, y = design([r.d for r in mine]), np.array([np.nan if r.y is None else r.y for r in mine])
        train = np.array([r.d < BEFORE and r.y is not None for r in mine])
        weights = np.linalg.lstsq(x[train], y[train], rcond=None)[0]
        np.testing.assert_allclose([r.prediction for r in mine], x @ weights, rtol=1e-6)


def test_solver_leaves_out_determined_unknowns(spark):
    a = np.array([[4.0, 2.0, 6.0], [2.0, 1.0, 3.0], [6.0, 3.0, 10.0]])
    m = np.column_stack([a, a @ [1.0, 0.0, 2.0]])
    row = spark.createDataFrame([(m.ravel().tolist(),)], "m array<double>").select(regression.solved(F.col("m"), 3).alias("w")).first()
    np.testing.assert_allclose(row.w, [1.0, 0.0, 2.0], atol=1e-9)


def test_trend_plan_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, k), float(k)) for k in range(1, 20)], "k string, d date, y double")
    plan = regression.trend_seasonal(df, "k", "d", "y", BEFORE)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "Python" not in plan
