"""Learners on data whose answer is known."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from harborline.functions import arrays, scalars
from harborline.operators import classification as cls
from harborline.operators import forest, metrics, regression


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3)) * [1, 5, 0.5] + [0, 3, -1]
    y = 4 + x @ [2.0, -1.0, 0.5]
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, noisy=y + rng.normal(size=300), k=range(300))
    return pdf, spark.createDataFrame(pdf)


def test_ols_recovers_an_exact_line(spark, linear):
    model = regression.linear_regression(linear[1], ["a", "b", "c"], "y")
    got = {r.feature: r.coefficient for r in model.coefficients(spark).collect()}
    assert got == pytest.approx({"a": 2.0, "b": -1.0, "c": 0.5, "intercept": 4.0}, abs=1e-8)
    assert model.predict(linear[1]).agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0] < 1e-8


@pytest.mark.parametrize("alpha", [0.001, 1.0, 50.0])
def test_ridge_equals_the_closed_form(spark, linear, alpha):
    pdf, df = linear
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf.noisy.to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    expected = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    model = regression.ridge(df, ["a", "b", "c"], "noisy", alpha)
    np.testing.assert_allclose(model.model.coefficients.toArray(), expected, rtol=1e-6)


def test_lasso_equals_coordinate_descent(linear):
    pdf, df = linear
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf.noisy.to_numpy()
    xc, yc, w, alpha = x - x.mean(0), y - y.mean(), np.zeros(3), 0.3
    for _ in range(2000):
        for j in range(3):
            rest = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ rest / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (xc[:, j] @ xc[:, j] / len(y))
    np.testing.assert_allclose(regression.lasso(df, ["a", "b", "c"], "noisy", alpha).model.coefficients.toArray(), w, atol=1e-4)


def test_polynomial_fits_a_parabola(spark):
    df = spark.createDataFrame([(float(i), 3.0 - 2.0 * i + 0.5 * i * i) for i in range(20)], "x double, y double")
    model = regression.polynomial_regression(df, ["x"], "y", 2)
    assert model.predict(df).agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0] < 1e-6


def test_trees_beat_the_mean(linear):
    for model in (
        regression.random_forest(linear[1], ["a", "b"], "y", trees=5, depth=5, leaf=5),
        regression.boosted_trees(linear[1], ["a", "b"], "y", rounds=5, depth=3),
    ):
        assert metrics.regression_metrics(model.predict(linear[1]), "y", "prediction").first().r2 > 0.5


def test_components_equal_numpy(spark, linear):
    pdf, df = linear
    found = regression.Components(df, ["a", "b", "c"], 3)
    x = pdf[["a", "b", "c"]].to_numpy()
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    np.testing.assert_allclose(found.variance, values / values.sum(), rtol=1e-8)
    scores = found.scores(df).select("pc1", "pc2", "pc3").toPandas()
    np.testing.assert_allclose(scores.var(ddof=1), values, rtol=1e-6)


def test_scalers_and_inverse(linear):
    pdf, df = linear
    scaled = regression.min_max_scale(df, ["a", "b"])
    back = regression.min_max_inverse(scaled, ["a", "b"], df).orderBy("k").toPandas()
    np.testing.assert_allclose(back[["a", "b"]], pdf[["a", "b"]], atol=1e-12)
    z = regression.standard_scale(df, ["a"]).toPandas().a
    assert z.mean() == pytest.approx(0, abs=1e-12) and z.std(ddof=0) == pytest.approx(1)


def test_permutation_importance_orders_features(linear):
    model = regression.linear_regression(linear[1], ["a", "b", "c"], "y")
    rise = {r.feature: r.mae_rise for r in regression.permutation_importance(linear[1], model, ["a", "b", "c"], "y", "k").collect()}
    assert rise["b"] > rise["a"] > rise["c"] > 0


def test_shuffle_keeps_the_values(linear):
    dealt = regression.shuffles(linear[1], ["a"], "k")["a"].toPandas()
    assert sorted(dealt.a) == sorted(linear[0].a) and (dealt.sort_values("k").a.to_numpy() != linear[0].a.to_numpy()).mean() > 0.9


def test_trend_and_week_are_learned(spark):
    days = pd.date_range("2023-01-01", periods=500)
    y = 10 + 0.05 * np.arange(500) + 3 * np.sin(2 * np.pi * days.dayofweek / 7)
    rows = [(b, d.date(), float(v) * b) for b in (1, 2) for d, v in zip(days, y)]
    df = spark.createDataFrame(rows, "b int, d date, y double")
    late = regression.trend_seasonal(df, "b", "d", "y", days[450].date()).where(F.col("d") >= F.lit(days[450].date()))
    assert late.agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0] < 1.0


@pytest.mark.parametrize("kind", ["decision_tree", "random_forest", "boosted", "logistic", "mlp"])
def test_classifiers_separate_two_clouds(spark, kind):
    rng = np.random.default_rng(2)
    label = rng.integers(0, 2, 200)
    pdf = pd.DataFrame({"k": range(200), "a": rng.normal(size=200) + 4 * label, "b": rng.normal(size=200), "y": label})
    df = spark.createDataFrame(pdf)
    params = {"random_forest": {"numTrees": 5}, "boosted": {"maxIter": 3}, "mlp": {"maxIter": 60}}.get(kind, {})
    scored = cls.fit_predict(kind, df, df, ["a", "b"], "y", ["k", "y"], **params)
    assert metrics.classification_metrics(scored, "y", "prediction").first().accuracy > 0.9
    assert metrics.roc_auc(scored, "y", "score").first().auc > 0.9


def test_auc_with_ties_equals_pair_counting(spark):
    rng = np.random.default_rng(4)
    y, s = rng.integers(0, 2, 150), np.round(rng.random(150), 1)
    pos, neg = s[y == 1], s[y == 0]
    expected = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    assert metrics.roc_auc(df, "y", "s").first().auc == pytest.approx(expected)


def test_smote_balances_and_stays_between(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"k": range(60), "a": rng.normal(size=60), "b": rng.normal(size=60), "y": [1] * 13 + [0] * 47})
    made = cls.smote(spark.createDataFrame(pdf), "k", ["a", "b"], "y", 1, k=3).toPandas()
    assert len(made) == 47 - 13
    for row in made.itertuples():
        p, q = pdf.loc[row.base_key, ["a", "b"]].to_numpy(float), pdf.loc[row.neighbour_key, ["a", "b"]].to_numpy(float)
        along = np.dot([row.a, row.b] - p, q - p) / np.dot(q - p, q - p)
        assert 0 <= along <= 1 and np.allclose(p + along * (q - p), [row.a, row.b])


def test_keyed_numbers_do_not_depend_on_partitions(spark):
    df = spark.range(2000)
    draw = lambda d: d.select("id", scalars.keyed_uniform(3, F.col("id")).alias("u"), scalars.keyed_normal(3, F.col("id")).alias("z")).orderBy("id").toPandas()
    one, two = draw(df.repartition(1)), draw(df.repartition(7))
    pd.testing.assert_frame_equal(one, two)
    assert abs(one.u.mean() - 0.5) < 0.03 and abs(one.z.std() - 1) < 0.06


def test_matrix_product_over_tiles(spark):
    rng = np.random.default_rng(8)
    a, b = rng.integers(-3, 4, (11, 9)), rng.integers(-3, 4, (9, 5))
    entries = lambda m: spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))], "i int, j int, v double")
    got = np.zeros((11, 5))
    for r in arrays.multiply(entries(a), entries(b)).collect():
        got[r.i, r.j] = r.v
    np.testing.assert_array_equal(got, a @ b)


def test_boosting_grows_on_merged_rows(spark, monkeypatch):
    monkeypatch.setattr(regression, "SLICE", 1000)
    rows = [(float(i % 7), float(i % 3), float((i * 37) % 101)) for i in range(2100)]
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(2)
    few = regression.merged(df, ["a", "b"], "y")
    pdf = pd.DataFrame(rows, columns=["a", "b", "y"])
    expected = pdf.groupby(["a", "b"]).y.agg(["mean", "count"]).reset_index().to_numpy()
    np.testing.assert_allclose(few.orderBy("a", "b").toPandas()[["a", "b", "y", "_weight"]].to_numpy(), expected)
    assert regression.merged(df.withColumn("a", F.monotonically_increasing_id()), ["a", "b"], "y") is None
    assert regression.merged(df.limit(1000), ["a", "b"], "y") is None
    plain = GBTRegressor(featuresCol="v", labelCol="y", maxIter=4, maxDepth=3, stepSize=0.1, seed=42).fit(regression.assemble(df, ["a", "b"], "v"))
    model = regression.boosted_trees(df, ["a", "b"], "y", rounds=4, depth=3)
    cells = df.select("a", "b").distinct()
    whole = {(r.a, r.b): r.prediction for r in plain.transform(regression.assemble(cells, ["a", "b"], "v")).collect()}
    assert {(r.a, r.b): r.prediction for r in model.predict(cells).collect()} == pytest.approx(whole)


def test_trees_grow_on_slices(spark, monkeypatch):
    monkeypatch.setattr(regression, "SLICE", 100)
    df = spark.range(1050).coalesce(1)
    assert regression.sliced(df).rdd.getNumPartitions() == 11
    assert regression.sliced(df.repartition(20)).rdd.getNumPartitions() == 20


@pytest.fixture(scope="module")
def stepped(spark):
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({"a": rng.normal(size=4000), "b": rng.integers(0, 9, 4000) * 1.0})
    pdf["y"] = 3 * pdf.a + pdf.b**2 + rng.normal(size=4000)
    return pdf, spark.createDataFrame(pdf).repartition(3)


def test_a_tree_on_sums_of_cells_equals_one_on_rows(spark):
    rng = np.random.default_rng(11)
    a, b = rng.integers(0, 20, 2000) * 1.0, rng.integers(0, 9, 2000) * 1.0
    y = np.round(a * 3 + b**2 + rng.normal(size=2000) * 5, 3)
    points = [forest.points_between(*np.unique(x, return_counts=True)) for x in (a, b)]
    cell = (a * 9 + b).astype(int)
    sums = np.stack([np.bincount(cell, w, 180) for w in (np.ones(2000), y, y * y)], axis=1)
    cells = np.flatnonzero(sums[:, 0])
    nodes = forest.grow(cells, sums[cells], points, 7, 5, 2, rng)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "y": y}))
    plain = DecisionTreeRegressor(featuresCol="v", labelCol="y", maxDepth=7, minInstancesPerNode=5).fit(regression.assemble(df, ["a", "b"], "v"))
    assert plain.numNodes == len(nodes)

    def walk(row):
        node = nodes[0]
        while node[7] >= 0:
            node = nodes[node[7] if row[node[9]] <= node[10] else node[8]]
        return node[1]

    scored = plain.transform(regression.assemble(df, ["a", "b"], "v")).collect()
    np.testing.assert_allclose([walk((r.a, r.b)) for r in scored], [r.prediction for r in scored])


def test_points_part_values_evenly(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"one": 5, "few": rng.integers(0, 4, 20_000) ** 2, "many": rng.random(20_000)})
    found = forest.split_points(spark.createDataFrame(pdf).repartition(2), ["one", "few", "many"])
    assert found[0].tolist() == [] and found[1].tolist() == [0.5, 2.5, 6.5]
    assert len(found[2]) == 31 and np.allclose(found[2], pdf.many.quantile(np.arange(1, 32) / 32), atol=0.005)
    kinds = np.arange(50.0)  # 50 even kinds make 32 bins of one or two
    assert set(np.diff(forest.points_between(kinds, np.full(50, 7)))) == {1.0, 2.0}


def test_draws_are_poisson():
    times = forest.drawn(np.random.default_rng(0), 4000, 200).ravel()
    shares = np.bincount(times)[:5] / times.size
    assert shares == pytest.approx(np.exp(-1) / np.array([1, 1, 2, 6, 24]), abs=2e-3)
    assert times.mean() == pytest.approx(1, abs=5e-3) and times.max() < 20


def test_a_long_table_is_not_kept_with_its_samples(spark, monkeypatch, stepped, tmp_path):
    pdf, df = stepped
    few = regression.random_forest(df, ["a", "b"], "y", trees=30, depth=8)
    monkeypatch.setattr(regression, "SLICE", 1000)
    with monkeypatch.context() as m:
        m.setattr(regression, "_fit", None)  # MLlib's learner holds rows times trees
        model = regression.random_forest(df.unionByName(df.limit(50).withColumn("y", F.lit(None).cast("double"))), ["a", "b"], "y", trees=30, depth=8)
    score = lambda fitted: metrics.regression_metrics(fitted.predict(df), "y", "prediction").first().r2
    assert score(few) > 0.98 and score(model) == pytest.approx(score(few), abs=0.01)
    assert model.model.getNumTrees == 30 and model.model.getMaxDepth() == 8
    assert model.model.totalNumNodes == pytest.approx(few.model.totalNumNodes, rel=0.2)
    np.testing.assert_allclose(model.model.featureImportances.toArray(), few.model.featureImportances.toArray(), atol=0.03)
    rooted = [tree.toDebugString.count("If") for tree in model.model.trees]
    assert len(set(rooted)) > 1  # samples and features differ by tree
    loaded = regression.load(regression.save(model, str(tmp_path / "m")))  # walks the trees
    both = loaded.predict(model.predict(df).withColumnRenamed("prediction", "cells"))
    assert both.where("cells = prediction").count() == 4000
    for name in ("a", "b"):
        bad = df.withColumn(name, F.when(F.col("y") > 0, F.col(name)))
        with pytest.raises(Exception, match="null or NaN in feature"):
            regression.random_forest(bad, ["a", "b"], "y", trees=2)
        with pytest.raises(Exception, match="null or NaN in feature"):
            model.predict(bad).agg(F.sum("prediction")).collect()


def test_a_long_table_of_many_cells_takes_a_few_trees_at_once(monkeypatch, stepped, tmp_path):
    pdf, df = stepped
    monkeypatch.setattr(forest, "CELLS", 100)
    monkeypatch.setattr(regression, "SLICE", 1000)
    monkeypatch.setattr(regression, "HELD", 4000 * 4)
    sizes, fit = [], regression._fit
    monkeypatch.setattr(regression, "_fit", lambda e, *rest: sizes.append(e.getNumTrees()) or fit(e, *rest))
    model = regression.random_forest(df, ["a", "b"], "y", trees=10, depth=8)
    assert sizes == [4, 4, 2] and model.model.getNumTrees == len(model.model.trees) == 10
    assert metrics.regression_metrics(model.predict(df), "y", "prediction").first().r2 > 0.95
    assert regression.load(regression.save(model, str(tmp_path / "m"))).model.getNumTrees == 10
