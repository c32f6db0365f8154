"""Regression, scaling and model selection on MLlib."""

from __future__ import annotations

import datetime as dt
import functools
import itertools
import json
import math
import random
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import PCA, PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel, RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions.scalars import keyed_uniform
from harborline.operators import forest
from harborline.operators.gram import Linear
from harborline.operators.metrics import flow_metrics, union_named
from harborline.operators.ordering import global_position
from harborline.session import cut

FEATURES = "_features"
SLICE = 1 << 16  # about as many rows, at most, make a partition of a table that trees are grown on
HELD = 1 << 28  # rows times trees, at most, that one fit of MLlib's forest keeps: some 8 bytes each


def assemble(df: DataFrame, features: Sequence[str], output: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error").transform(df)


class Fitted:
    """A fitted model with the features it reads; ``predict`` adds the column ``prediction``.

    A model that splits features at few ``points`` only is looked up by cell: the model itself gives the value of each.
    """

    def __init__(
        self, model: Model, features: Sequence[str], prepare: Callable[[DataFrame], DataFrame] | None = None, points: Sequence[np.ndarray] | None = None
    ):
        self.model, self.features, self.prepare, self.points = model, list(features), prepare, points

    def predict(self, df: DataFrame) -> DataFrame:
        if isinstance(self.model, LinearRegressionModel) and self.prepare is None:
            return df.withColumn("prediction", self.weighted_sum())
        if self.points is not None:
            return df.withColumn("prediction", forest.looked_up(self.features, self.points, self.cell_values))
        vectors = assemble(df, self.features)
        vectors = self.prepare(vectors) if self.prepare else vectors
        return self.model.transform(vectors).select(*df.columns, "prediction")

    @functools.cached_property
    def cell_values(self) -> list[float]:
        spark, names = SparkSession.active(), [f"x{k}" for k in range(len(self.features))]
        cells = spark.createDataFrame(list(enumerate(forest.corners(self.points))), f"cell int, x struct<{', '.join(f'{n}: double' for n in names)}>")
        scored = self.model.transform(assemble(cells.select("cell", "x.*"), names))
        return [r.prediction for r in scored.select("cell", "prediction").orderBy("cell").collect()]

    def weighted_sum(self) -> Column:
        """A linear model as a column expression, which stays inside code generation."""
        terms = (F.col(f).cast("double") * F.lit(float(c)) for f, c in zip(self.features, self.model.coefficients))
        return sum(terms, F.lit(float(self.model.intercept)))

    def coefficients(self, spark) -> DataFrame:
        """(feature, coefficient), with the intercept as its own row."""
        pairs = [*zip(self.features, [float(c) for c in self.model.coefficients]), ("intercept", float(self.model.intercept))]
        return spark.createDataFrame(pairs, "feature string, coefficient double")

    def importance(self, spark) -> DataFrame:
        """(feature, importance): tree importances, or absolute coefficients."""
        values = self.model.featureImportances.toArray() if hasattr(self.model, "featureImportances") else np.abs(self.model.coefficients.toArray())
        return spark.createDataFrame(list(zip(self.features, [float(v) for v in values])), "feature string, importance double")


def save(fitted: Fitted | Linear, path: str) -> str:
    """Write a fitted model and its feature list below ``path``, a folder that executors reach."""
    if isinstance(fitted, Linear):
        rows = [*enumerate(zip(fitted.features, fitted.weights)), (-1, ("", fitted.intercept))]
        rows = SparkSession.active().createDataFrame([(k, f, w) for k, (f, w) in rows], "place int, feature string, weight double")
        rows.coalesce(1).write.mode("overwrite").json(f"{path}/features")
        return path
    if fitted.prepare is not None:
        raise ValueError("a model with a preparation step can't be saved")
    fitted.model.write().overwrite().save(f"{path}/model")
    rows = list(enumerate(fitted.features))
    SparkSession.active().createDataFrame(rows, "place int, feature string").coalesce(1).write.mode("overwrite").json(f"{path}/features")
    return path


def load(path: str) -> Fitted | Linear:
    """The model that ``save`` wrote, whatever kind it is."""
    spark = SparkSession.active()
    rows = spark.read.schema("place int, feature string, weight double").json(f"{path}/features").orderBy("place").collect()
    if rows and rows[0].place < 0:
        return Linear([r.feature for r in rows[1:]], [r.weight for r in rows[1:]], rows[0].weight)
    return Fitted(DefaultParamsReader.loadParamsInstance(f"{path}/model", spark.sparkContext), [r.feature for r in rows])


def sliced(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` in partitions of at most about ``SLICE`` rows: a small file would be one task in every pass of a tree learner."""
    n = -(-(df.count() if rows is None else rows) // SLICE)
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def merged(df: DataFrame, features: Sequence[str], label: str) -> DataFrame | None:
    """Rows with equal features as one row (features, label, ``_weight``): their mean label and their number.

    Sums of weights and labels, and so the splits by squared error and the means of leaves, stay what they are. Points to split
    at come from all values, where MLlib draws some 10,000 rows. None for one slice of rows, and where this would not halve them.
    """
    rows = df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("_label"))
    n, kinds = rows.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*features))).first()
    if n <= SLICE or 2 * kinds > n:
        return None
    found = rows.groupBy(*features).agg(F.avg("_label").alias(label), F.count(F.lit(1)).cast("double").alias("_weight"))
    return cut(found)


def _fit(estimator: Estimator, df: DataFrame, features: Sequence[str], label: str) -> Fitted:
    weights = ["_weight"] if estimator.hasParam("weightCol") and estimator.isDefined("weightCol") else []
    train = assemble(df.where(F.col(label).isNotNull()), features).select(FEATURES, F.col(label).cast("double").alias("_label"), *weights)
    estimator = estimator.copy()
    estimator.setFeaturesCol(FEATURES)
    estimator.setLabelCol("_label")
    return Fitted(estimator.fit(train), features)


def linear_regression(df: DataFrame, features: Sequence[str], label: str) -> Fitted:
    """Ordinary least squares; the normal equations are summed on the executors."""
    return _fit(LinearRegression(solver="normal"), df, features, label)


def ridge(df: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0) -> Fitted:
    """Least squares plus ``alpha`` times the squared coefficients.

    MLlib averages the loss over rows and scales by the label's deviation, hence the factor.
    """
    known = df.where(F.col(label).isNotNull())
    n, spread = known.agg(F.count(F.lit(1)), F.stddev_pop(label)).first()
    reg = alpha * float(spread) / n
    return _fit(LinearRegression(solver="normal", regParam=reg, elasticNetParam=0.0, standardization=False), df, features, label)


def lasso(df: DataFrame, features: Sequence[str], label: str, alpha: float = 0.1) -> Fitted:
    """Half the mean squared error plus ``alpha`` times the absolute coefficients."""
    estimator = LinearRegression(regParam=alpha, elasticNetParam=1.0, standardization=False, maxIter=500, tol=1e-10)
    return _fit(estimator, df, features, label)


def polynomial_regression(df: DataFrame, features: Sequence[str], label: str, degree: int = 2) -> Fitted:
    expand = PolynomialExpansion(degree=degree, inputCol=FEATURES, outputCol="_powers")
    train = expand.transform(assemble(df.where(F.col(label).isNotNull()), features))
    model = LinearRegression(solver="normal", featuresCol="_powers", labelCol="_label").fit(
        train.select("_powers", F.col(label).cast("double").alias("_label"))
    )
    return Fitted(model, features, expand.transform)


def random_forest(df: DataFrame, features: Sequence[str], label: str, trees: int = 200, depth: int = 15, leaf: int = 5, seed: int = 42) -> Fitted:
    """Above one slice of rows, a forest over few cells of bins grows on their sums; over more of them, as many trees at once as ``HELD`` allows.

    MLlib keeps a count and a node for each row and tree, which no disk holds for a long table.
    """
    # a row keeps its node in every tree: without that each level walks all trees from the root, row by row
    estimator = RandomForestRegressor(numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, seed=seed, cacheNodeIds=True)
    n, rows = df.agg(F.count(label), F.count(F.lit(1))).first()
    known = df.where(F.col(label).isNotNull())
    points = forest.split_points(known, features) if n > SLICE else None
    if points is not None:
        estimator.setFeaturesCol(FEATURES)
        estimator.setLabelCol("_label")
        return Fitted(forest.fit(known, features, label, points, estimator, n), features, points=points)
    at_once = max(1, HELD // max(n, 1))
    if at_once >= trees:
        return _fit(estimator, sliced(df, rows), features, label)
    dealt, draw = cut(sliced(known.select(*dict.fromkeys([*features, label])), n)), random.Random(seed)
    estimator.setFeatureSubsetStrategy("onethird")  # as MLlib has it for more than one tree
    sizes = [min(at_once, trees - k) for k in range(0, trees, at_once)]
    parts = [_fit(estimator.copy({estimator.numTrees: k, estimator.seed: draw.getrandbits(31)}), dealt, features, label).model for k in sizes]
    return Fitted(joined(parts, estimator), features)


def joined(models: Sequence[RandomForestRegressionModel], estimator: RandomForestRegressor) -> RandomForestRegressionModel:
    """One forest of the trees of all, with the parameters of ``estimator``."""
    sc = SparkSession.active().sparkContext
    kinds = sc._jvm.org.apache.spark.ml.regression
    found = [tree for m in models for tree in m._java_obj.trees()]
    trees = sc._gateway.new_array(kinds.DecisionTreeRegressionModel, len(found))
    for k, tree in enumerate(found):
        trees[k] = tree
    whole = kinds.RandomForestRegressionModel(estimator.uid, trees, models[0].numFeatures)
    estimator = estimator.copy({estimator.featuresCol: FEATURES, estimator.labelCol: "_label"})
    estimator._transfer_params_to_java()
    return RandomForestRegressionModel(estimator._java_obj.copyValues(whole, estimator._java_obj.extractParamMap()))


def boosted_trees(df: DataFrame, features: Sequence[str], label: str, rounds: int = 200, depth: int = 5, step: float = 0.1, seed: int = 42) -> Fitted:
    """Boosting by squared error; no round samples rows, so equal ones are grown on as one."""
    estimator = GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed)
    known = df.where(F.col(label).isNotNull())
    fewer = merged(known, features, label)
    if fewer is None:
        return _fit(estimator, sliced(known), features, label)
    return _fit(estimator.setWeightCol("_weight"), sliced(fewer), features, label)


def _waves(date: Column, origin: dt.date, yearly: int, weekly: int) -> list[Column]:
    """A constant, years since ``origin``, and waves of a week and of a year."""
    t = F.unix_date(date).cast("double")
    columns = [F.lit(1.0), F.datediff(date, F.lit(origin)) / F.lit(365.25)]
    for period, order in ((7.0, weekly), (365.25, yearly)):
        for n in range(1, order + 1):
            angle = t * F.lit(2 * math.pi * n / period)
            columns += [F.sin(angle), F.cos(angle)]
    return columns


def solved(matrix: Column, n: int) -> Column:
    """The solution of ``n`` linear equations, from an array of their n x (n + 1) coefficients and right sides by row.

    Meant for sums of squares and products. An unknown that earlier ones determine becomes 0.
    """
    width = n + 1
    size = F.array(*[matrix[k * width + k] for k in range(n)])

    def eliminated(m: Column, k: Column) -> Column:
        pivot = F.get(m, k * width + k)
        free = pivot <= F.get(size, k) * 1e-10

        def cell(v: Column, i: Column) -> Column:
            row, column = F.floor(i / width).cast("int"), i % width
            other = v - F.get(m, row * width + k) * F.get(m, k * width + column) / pivot
            return F.when(row == k, F.when(free, 0.0).otherwise(v / pivot)).otherwise(F.when(free, v).otherwise(other))

        return F.transform(m, cell)

    left = F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), matrix, eliminated)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.get(left, k * width + n))


def trend_seasonal(
    df: DataFrame, by: str, date: str, label: str, train_before: dt.date, yearly: int = 3, weekly: int = 2
) -> DataFrame:
    """(by, date, label, prediction): per series a straight trend with weekly and yearly waves.

    Rows before ``train_before`` with a value are fitted, all rows are predicted; a series without such rows gets no
    prediction. The normal equations of a series are sums, combined before the shuffle and solved in one row.
    """
    n = 2 + 2 * (yearly + weekly)
    x, y = [f"_x{k}" for k in range(n)], F.col(label).cast("double")
    rows = df.select(by, date, y.alias(label))
    waved = rows.withColumns(dict(zip(x, _waves(F.col(date), train_before, yearly, weekly))))
    known = waved.where((F.col(date) < F.lit(train_before)) & F.col(label).isNotNull() & ~F.isnan(label))
    products = [F.sum(F.col(x[i]) * F.col(x[j])).alias(f"_s{i}_{j}") for i in range(n) for j in range(i, n)]
    sums = known.groupBy(F.col(by).alias("_by")).agg(*products, *[F.sum(F.col(c) * F.col(label)).alias(f"_y{i}") for i, c in enumerate(x)])
    cells = [F.col(f"_s{min(i, j)}_{max(i, j)}") if j < n else F.col(f"_y{i}") for i in range(n) for j in range(n + 1)]
    fitted = sums.select("_by", F.array(*cells).alias("_m")).select("_by", solved(F.col("_m"), n).alias("_w"))
    found = waved.join(fitted, F.col(by).eqNullSafe(F.col("_by")), "left")
    prediction = sum((F.col(c) * F.col("_w")[k] for k, c in enumerate(x)), F.lit(0.0))
    return found.select(by, date, label, prediction.alias("prediction"))


def train_test_mark(df: DataFrame, keys: Sequence[str], test_share: float = 0.2, seed: int = 42, name: str = "is_test") -> DataFrame:
    """Mark rows as test by their key; the same key falls on the same side in every run."""
    return df.withColumn(name, keyed_uniform(seed, *[F.col(k) for k in keys]) < test_share)


def min_max_scale(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Columns mapped to [0, 1] by the minimum and maximum of ``fitted_on``."""
    base = fitted_on if fitted_on is not None else df
    ends = base.agg(*[F.min(c).alias(f"{c}_lo") for c in columns], *[F.max(c).alias(f"{c}_hi") for c in columns])
    low, high = (lambda c: ends.select(f"{c}_lo").scalar()), (lambda c: ends.select(f"{c}_hi").scalar())
    return df.withColumns({c: F.coalesce((F.col(c) - low(c)) / F.nullif(high(c) - low(c), F.lit(0)), F.lit(0.0)) for c in columns})


def min_max_inverse(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame) -> DataFrame:
    ends = fitted_on.agg(*[F.min(c).alias(f"{c}_lo") for c in columns], *[F.max(c).alias(f"{c}_hi") for c in columns])
    low, high = (lambda c: ends.select(f"{c}_lo").scalar()), (lambda c: ends.select(f"{c}_hi").scalar())
    return df.withColumns({c: F.col(c) * (high(c) - low(c)) + low(c) for c in columns})


def standard_scale(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Columns minus mean over population deviation of ``fitted_on``."""
    base = fitted_on if fitted_on is not None else df
    stats = base.agg(*[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_pop(c).alias(f"{c}_s") for c in columns])
    mean, spread = (lambda c: stats.select(f"{c}_m").scalar()), (lambda c: stats.select(f"{c}_s").scalar())
    return df.withColumns({c: (F.col(c) - mean(c)) / F.coalesce(F.nullif(spread(c), F.lit(0.0)), F.lit(1.0)) for c in columns})


class Components:
    """Principal components of centred columns, each with its largest loading positive."""

    def __init__(self, df: DataFrame, columns: Sequence[str], k: int):
        self.columns, self.k = list(columns), k
        means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
        self.means = {c: float(means[c]) for c in columns}
        model = PCA(k=k, inputCol=FEATURES, outputCol="_scores").fit(assemble(self._centred(df), columns))
        loadings = model.pc.toArray()
        signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), range(k)])
        self.loadings, self.variance = loadings * signs, model.explainedVariance.toArray()

    def _centred(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c) - F.lit(self.means[c]) for c in self.columns})

    def scores(self, df: DataFrame) -> DataFrame:
        """Columns pc1..pck: one expression per component, no Python on the rows."""
        weigh = lambda j: sum(
            ((F.col(c) - F.lit(self.means[c])) * F.lit(float(self.loadings[i, j])) for i, c in enumerate(self.columns)), F.lit(0.0)
        )
        return df.withColumns({f"pc{j + 1}": weigh(j) for j in range(self.k)})

    def table(self, spark) -> DataFrame:
        """(component, explained, cumulative, column, loading)."""
        total = np.cumsum(self.variance)
        rows = [
            (j + 1, float(self.variance[j]), float(total[j]), c, float(self.loadings[i, j]))
            for j in range(self.k)
            for i, c in enumerate(self.columns)
        ]
        return spark.createDataFrame(rows, "component int, explained double, cumulative double, column string, loading double")


Fit = Callable[[DataFrame], "Fitted"]


def expanding_cv(df: DataFrame, folds: DataFrame, date: str, label: str, models: Mapping[str, Fit]) -> DataFrame:
    """(model, fold, metrics): each model fitted on the days up to ``train_end`` and scored on the fold.

    ``df`` should be a written or cut table, since every fit reads it. The handful of fold
    boundaries comes to the driver; the fits and the scoring are Spark jobs.
    """
    scored = None
    for fold in folds.orderBy("fold").collect():
        train = df.where(F.col(date) <= F.lit(fold["train_end"]))
        held = df.where(F.col(date).between(F.lit(fold["val_start"]), F.lit(fold["val_end"])))
        for name, fit in models.items():
            part = fit(train).predict(held).select(
                F.lit(name).alias("model"), F.lit(fold["fold"]).alias("fold"), F.col(label).alias("actual"), F.col("prediction").alias("predicted")
            )
            scored = part if scored is None else scored.unionByName(part)
    return flow_metrics(scored, "actual", "predicted", ["model", "fold"], shortfalls=True)


def random_search(
    df: DataFrame,
    folds: DataFrame,
    date: str,
    features: Sequence[str],
    label: str,
    fit: Callable[..., Fitted],
    space: Mapping[str, Sequence],
    n: int,
    seed: int = 42,
) -> DataFrame:
    """(params, mae, rmse, wape, underforecasting_rate, folds): ``n`` parameter sets drawn from ``space`` and fitted by
    ``fit(df, features, label, **params)`` over time-ordered folds, best first; ``params`` is JSON."""
    combos = {json.dumps(p, sort_keys=True): p for p in sampled_grid(space, n, seed)}
    models = {name: (lambda train, p=p: fit(train, features, label, **p)) for name, p in combos.items()}
    return mean_scores(expanding_cv(df, folds, date, label, models)).withColumnRenamed("model", "params").orderBy("mae", "params")


def mean_scores(cv: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Fold metrics averaged per model, and per value of the columns ``by``."""
    names = ("mae", "rmse", "wape", "underforecasting_rate")
    return cv.groupBy(*by, "model").agg(*[F.avg(n).alias(n) for n in names], F.count(F.lit(1)).alias("folds"))


def sampled_grid(space: Mapping[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """``n`` distinct parameter combinations drawn from the space, in a fixed order."""
    combos = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return combos if n >= len(combos) else random.Random(seed).sample(combos, n)


def shuffles(df: DataFrame, columns: Sequence[str], key: str, seed: int = 42) -> dict[str, DataFrame]:
    """Per column, ``df`` with its values dealt out again over the rows in an order fixed by the seed.

    Rows are numbered once by key and once in the seed's order, for all columns together.
    """
    rows = global_position(df.withColumn("_key", F.col(key)), ["_key"], "_at")
    deal = df.select(*[F.col(c).alias(f"_dealt_{c}") for c in columns], keyed_uniform(seed, F.col(key)).alias("_u"), F.col(key).alias("_tie"))
    dealt = global_position(deal, ["_u", "_tie"], "_at")
    one = lambda c: rows.join(dealt.select("_at", f"_dealt_{c}"), "_at").withColumn(c, F.col(f"_dealt_{c}")).select(*df.columns)
    return {c: one(c) for c in columns}


def permutation_importance(df: DataFrame, model: Fitted, features: Sequence[str], label: str, key: str, seed: int = 42) -> DataFrame:
    """(feature, mae_rise): how much the error grows when one column is shuffled."""
    base = F.avg(F.abs(F.col(label) - F.col("prediction")))
    frames = {f: model.predict(frame) for f, frame in shuffles(df, features, key, seed).items()}
    scored = union_named({"": model.predict(df), **frames}, "feature").groupBy("feature").agg(base.alias("mae"))
    plain = scored.where(F.col("feature") == "").agg(F.max("mae")).scalar()
    return scored.where(F.col("feature") != "").select("feature", (F.col("mae") - plain).alias("mae_rise"))
