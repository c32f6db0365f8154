"""Classifiers on MLlib, nearest-neighbour voting and minority oversampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.functions.scalars import keyed_uniform
from harborline.operators.nearest import nearest
from harborline.operators.ordering import global_position
from harborline.operators.regression import FEATURES, assemble
from harborline.session import cut


def label_encode(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_code``, the alphabetical number of the category from 0 (null for null).

    Categories are numbered as a table and joined, however many there are.
    """
    known = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_category")).distinct()
    codes = global_position(known, ["_category"], "_place").select("_category", (F.col("_place") - 1).cast("int").alias(f"{column}_code"))
    return df.join(codes, df[column] == codes["_category"], "left").drop("_category")


def encode(df: DataFrame, column: str, most: int = 1000) -> tuple[DataFrame, list[str]]:
    """Add ``<column>_code`` (alphabetical) and ``<column>_onehot`` (no category dropped).

    A row gets one number per category, so more than ``most`` categories are refused.
    """
    if (n := df.agg(F.count_distinct(column)).first()[0]) > most:
        raise ValueError(f"{column} has {n} categories, more than {most}")
    indexer = StringIndexer(inputCol=column, outputCol="_i", stringOrderType="alphabetAsc").fit(df)
    coded = indexer.transform(df)
    onehot = OneHotEncoder(inputCols=["_i"], outputCols=["_v"], dropLast=False).fit(coded).transform(coded)
    names = list(indexer.labels)
    return onehot.withColumns({f"{column}_code": F.col("_i").cast("int"), f"{column}_onehot": vector_to_array("_v")}).drop("_i", "_v"), names


def labelled(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return assemble(df, features).withColumn("_label", F.col(label).cast("double"))


def _probabilities(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    scored = model.transform(df)
    score = vector_to_array("probability")[1] if "probability" in scored.columns else F.col("prediction")
    return scored.select(*keep, F.col("prediction").cast("int").alias("prediction"), score.alias("score"))


ESTIMATORS = {
    "decision_tree": lambda: DecisionTreeClassifier(impurity="gini", seed=42),
    "decision_tree_entropy": lambda: DecisionTreeClassifier(impurity="entropy", maxDepth=5, seed=42),
    "random_forest": lambda: RandomForestClassifier(numTrees=100, seed=42),
    "boosted": lambda: GBTClassifier(maxIter=20, seed=42),
    "logistic": lambda: LogisticRegression(regParam=0.0, maxIter=100),
    "naive_bayes": lambda: NaiveBayes(modelType="gaussian", smoothing=0.0),
    "mlp": lambda: MultilayerPerceptronClassifier(layers=[2, 8, 4, 2], maxIter=100, seed=42),
}


def fit_predict(kind: str, train: DataFrame, test: DataFrame, features: Sequence[str], label: str, keep: Sequence[str], **params) -> DataFrame:
    """(keep..., prediction, score of class 1) on ``test`` of a classifier fitted on ``train``."""
    estimator = ESTIMATORS[kind]()
    estimator.setParams(featuresCol=FEATURES, labelCol="_label", **params)
    model = estimator.fit(labelled(train, features, label).select(FEATURES, "_label"))
    return _probabilities(model, labelled(test, features, label), keep)


def gaussian_nb(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, keep: Sequence[str], smoothing: float = 1e-9) -> DataFrame:
    """Gaussian naive Bayes from one aggregate of class means, variances and shares.

    The class table has one row per class and feature set, so the class score is a projection
    over an array of class rows held as a scalar.
    """
    stats = train.groupBy(F.col(label).cast("int").alias("c")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f).alias(f"m_{f}") for f in features],
        *[F.var_pop(f).alias(f"v_{f}") for f in features],
    )
    biggest = train.agg(F.greatest(*[F.var_pop(f) for f in features])).scalar()
    total = train.agg(F.count(F.lit(1))).scalar()
    rows = stats.withColumn("prior", F.log(F.col("n") / total)).withColumn("eps", biggest * smoothing)
    classes = rows.agg(F.sort_array(F.collect_list(F.struct("c", "prior", "eps", *[f"m_{f}" for f in features], *[f"v_{f}" for f in features]))))

    def joint(k):
        parts = k["prior"]
        for f in features:
            var = k[f"v_{f}"] + k["eps"]
            parts = parts - F.log(2 * F.pi() * var) / 2 - F.pow(F.col(f) - k[f"m_{f}"], 2) / (2 * var)
        return F.struct(parts.alias("logp"), (-k["c"]).alias("less"))

    scored = test.withColumn("_classes", classes.scalar()).withColumn("_joint", F.transform("_classes", joint))
    best = F.array_max("_joint")
    shares = F.transform("_joint", lambda j: F.exp(j["logp"] - best["logp"]))
    one = F.exists("_joint", lambda j: j["less"] == -1)
    share_of_one = F.aggregate(F.filter("_joint", lambda j: j["less"] == -1), F.lit(0.0), lambda a, j: a + F.exp(j["logp"] - best["logp"]))
    whole = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    return scored.select(*keep, (-best["less"]).alias("prediction"), F.when(one, share_of_one / whole).otherwise(0.0).alias("score"))


def vectors(df: DataFrame, key: str, features: Sequence[str], name: str) -> DataFrame:
    return df.select(F.col(key).alias(name), F.array(*[F.col(f).cast("double") for f in features]).alias("vector"))


def neighbour_votes(train: DataFrame, test: DataFrame, key: str, features: Sequence[str], label: str, k: int) -> DataFrame:
    """(key, rank, label) of each test row's ``k`` nearest training rows."""
    found = nearest(vectors(test, key, features, "query_id"), vectors(train, key, features, "item_id"), k, metric="l2")
    names = train.select(F.col(key).alias("item_id"), F.col(label).alias("_vote"))
    return found.join(names, "item_id").select(F.col("query_id").alias(key), "rank", F.col("_vote").alias("vote"))


def knn_classify(train: DataFrame, test: DataFrame, key: str, features: Sequence[str], label: str, k: int = 3) -> DataFrame:
    """(key, prediction): majority among the ``k`` nearest, the smallest label on a tie."""
    counts = neighbour_votes(train, test, key, features, label, k).groupBy(key, "vote").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("less"), "vote")).alias("_b")).select(key, F.col("_b.vote").alias("prediction"))


def knn_curve(train: DataFrame, test: DataFrame, key: str, features: Sequence[str], label: str, largest: int = 30) -> DataFrame:
    """(k, accuracy) for k = 1..largest from one neighbour search."""
    votes = neighbour_votes(train, test, key, features, label, largest)
    per_k = votes.select(key, "vote", F.explode(F.sequence(F.col("rank"), F.lit(largest))).alias("k"))
    counts = per_k.groupBy("k", key, "vote").agg(F.count(F.lit(1)).alias("n"))
    picked = counts.groupBy("k", key).agg(F.min(F.struct((-F.col("n")).alias("less"), "vote")).alias("_b"))
    truth = test.select(key, F.col(label).alias("_truth"))
    return picked.join(truth, key).groupBy("k").agg(F.avg((F.col("_b.vote") == F.col("_truth")).cast("double")).alias("accuracy"))


def smote(df: DataFrame, key: str, features: Sequence[str], label: str, minority, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic minority rows (base_key, copy, features..., label) until both classes are equal in number.

    A row lies between a minority row and one of its ``k`` nearest minority rows; neighbour and
    place are fixed by key and seed.
    """
    small = cut(df.where(F.col(label) == minority).select(key, *features))
    n_small = small.agg(F.count(F.lit(1))).scalar()
    n_large = df.where(F.col(label) != minority).agg(F.count(F.lit(1))).scalar()
    near = nearest(
        vectors(small, key, features, "query_id"), vectors(small, key, features, "item_id"), k, metric="l2", other_only=True
    )
    # Bounded by k rows per base row.
    around = near.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "item_id"))).alias("near"))
    placed = global_position(small.select(F.col(key).alias("query_id")), ["query_id"], "_at")
    counted = placed.withColumns({"_need": n_large - n_small, "_have": n_small}).where(F.col("_need") >= F.col("_at"))
    copies = counted.select("query_id", F.explode(F.sequence(F.lit(0), F.floor((F.col("_need") - F.col("_at")) / F.col("_have")))).alias("copy"))
    pick = F.floor(keyed_uniform(seed, F.col("query_id"), F.col("copy"), F.lit("pick")) * F.size("near")).cast("int")
    chosen = copies.join(around, "query_id").select("query_id", "copy", F.get("near", pick)["item_id"].alias("item_id"))
    here = small.select(F.col(key).alias("query_id"), *[F.col(f).cast("double").alias(f"_a_{f}") for f in features])
    there = small.select(F.col(key).alias("item_id"), *[F.col(f).cast("double").alias(f"_b_{f}") for f in features])
    along = keyed_uniform(seed, F.col("query_id"), F.col("copy"), F.lit("along"))
    return chosen.join(here, "query_id").join(there, "item_id").select(
        F.col("query_id").alias("base_key"),
        "copy",
        F.col("item_id").alias("neighbour_key"),
        *[(F.col(f"_a_{f}") + along * (F.col(f"_b_{f}") - F.col(f"_a_{f}"))).alias(f) for f in features],
        F.lit(minority).alias(label),
    )


def cross_validated(kind: str, df: DataFrame, features: Sequence[str], label: str, key: str, grid: Mapping[str, Sequence] | None = None, folds: int = 5, seed: int = 42):
    """(model, scores): ``CrossValidator`` on folds fixed by the key, one row per parameter setting."""
    estimator = ESTIMATORS[kind]()
    estimator.setParams(featuresCol=FEATURES, labelCol="_label")
    builder = ParamGridBuilder()
    for name, values in (grid or {}).items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    settings = builder.build()
    data = labelled(df, features, label).withColumn("_fold", F.floor(keyed_uniform(seed, F.col(key)) * folds).cast("int"))
    cv = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=settings,
        evaluator=BinaryClassificationEvaluator(labelCol="_label", metricName="areaUnderROC"),
        numFolds=folds,
        foldCol="_fold",
        parallelism=2,
    )
    model = cv.fit(data.select(FEATURES, "_label", "_fold"))
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in setting.items()) or "default", float(mean), float(std))
        for setting, mean, std in zip(settings, model.avgMetrics, model.stdMetrics)
    ]
    return model.bestModel, df.sparkSession.createDataFrame(rows, "setting string, mean_auc double, std_auc double")
