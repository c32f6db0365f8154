"""Linear models from sums that one scan collects.

A block holds the number of rows, the means and the centred cross products of predictors and a target: all
that least squares, ridge and lasso need to know of those rows. Blocks of disjoint rows merge, so one
scan sums a block per target and slice of days, and every expanding fold, penalty and target is then solved
from merged blocks without reading a row again. Means are taken out before products are summed and blocks merge by
the pairwise update, so large amounts lose no digits.

A task keeps one block per target and slice; blocks merge in two shuffled steps, and what reaches the driver is
(targets x slices) blocks of (predictors + 1)^2 / 2 numbers, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.operators.metrics import flow_metrics

_SCHEMA = "target string, slice int, n long, mean array<double>, upper array<double>"


class Block(NamedTuple):
    """Rows, means and centred cross products of the predictors and, last, the target."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray

    @staticmethod
    def of(rows: np.ndarray) -> Block:
        mean = rows.mean(axis=0)
        centred = rows - mean
        return Block(len(rows), mean, centred.T @ centred)

    def merged(self, other: Block) -> Block:
        n, gap = self.n + other.n, other.mean - self.mean
        return Block(n, self.mean + gap * (other.n / n), self.scatter + other.scatter + np.outer(gap, gap) * (self.n / n * other.n))


class Linear:
    """A linear model as a column expression, which stays inside code generation."""

    def __init__(self, features: Sequence[str], weights: Sequence[float], intercept: float):
        self.features, self.weights, self.intercept = list(features), [float(w) for w in weights], float(intercept)

    def weighted_sum(self) -> Column:
        return sum((F.col(f).cast("double") * F.lit(w) for f, w in zip(self.features, self.weights)), F.lit(self.intercept))

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.weighted_sum())

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """(feature, coefficient), with the intercept as its own row."""
        return spark.createDataFrame([*zip(self.features, self.weights), ("intercept", self.intercept)], "feature string, coefficient double")

    def importance(self, spark: SparkSession) -> DataFrame:
        """(feature, importance): absolute coefficients."""
        return spark.createDataFrame([(f, abs(w)) for f, w in zip(self.features, self.weights)], "feature string, importance double")


class Blocks:
    """Blocks by target and slice; slice k holds the days after cut k - 1 up to cut k."""

    def __init__(self, features: Sequence[str], cuts: Sequence, parts: Mapping[tuple[str, int], Block]):
        self.features, self.cuts, self.parts = list(features), list(cuts), dict(parts)

    def upto(self, target: str, cut=None) -> Block:
        """All rows with a value of ``target`` on days up to a cut, or on any day."""
        last = len(self.cuts) if cut is None else self.cuts.index(cut)
        found = [self.parts[target, k] for k in range(last + 1) if (target, k) in self.parts]
        if not found:
            raise ValueError(f"no rows with a value of {target} up to {cut}")
        total = found[0]
        for part in found[1:]:
            total = total.merged(part)
        return total

    def ridge(self, target: str, alpha: float = 0.0, cut=None) -> Linear:
        return ridge(self.upto(target, cut), self.features, alpha)

    def lasso(self, target: str, alpha: float = 0.1, cut=None) -> Linear:
        return lasso(self.upto(target, cut), self.features, alpha)


def ridge(block: Block, features: Sequence[str], alpha: float = 0.0) -> Linear:
    """Least squares plus ``alpha`` times the squared coefficients; the intercept is free.

    Predictors are eliminated in order. One that is constant, or that earlier ones determine (a share under
    1e-10 of it is left), gets no weight, which without a penalty makes the solution unique.
    """
    p = len(features)
    size = np.diag(block.scatter)[:p] + alpha
    noise = 1e-12 * (size + block.n * block.mean[:p] ** 2)
    left = block.scatter[:p].copy()
    left[:, :p] += alpha * np.eye(p)
    for k in range(p):
        pivot = left[k, k]
        if pivot <= max(1e-10 * size[k], noise[k]):
            left[k] = 0.0
            continue
        row = left[k] / pivot
        left -= np.outer(left[:, k], row)
        left[k] = row
    weights = left[:, p]
    return Linear(features, weights, block.mean[p] - weights @ block.mean[:p])


def lasso(block: Block, features: Sequence[str], alpha: float = 0.1, rounds: int = 10_000) -> Linear:
    """Half the mean squared error plus ``alpha`` times the absolute coefficients, by coordinate descent."""
    p = len(features)
    scatter, towards = block.scatter[:p, :p], block.scatter[:p, p]
    size = np.diag(scatter).copy()
    weights, left = np.zeros(p), towards.copy()  # left: the cross products of predictors and residuals
    tolerance = 1e-12 * max(block.scatter[p, p], 1e-300)
    for _ in range(rounds):
        moved = 0.0
        for j in np.flatnonzero(size > 0):
            pull = left[j] + size[j] * weights[j]
            new = np.sign(pull) * max(abs(pull) - block.n * alpha, 0.0) / size[j]
            step = new - weights[j]
            if step:
                left -= scatter[:, j] * step
                weights[j] = new
                moved = max(moved, size[j] * step * step)
        if moved <= tolerance:
            break
    return Linear(features, weights, block.mean[p] - weights @ block.mean[:p])


def _packed(parts: Mapping[tuple[str, int], Block]) -> pa.RecordBatch:
    upper = lambda b: b.scatter[np.triu_indices(len(b.mean))].tolist()
    rows = [(t, k, b.n, b.mean.tolist(), upper(b)) for (t, k), b in parts.items()]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["target", "slice", "n", "mean", "upper"])


def _unpacked(n: int, mean: Sequence[float], upper: Sequence[float]) -> Block:
    scatter = np.zeros((len(mean), len(mean)))
    scatter[np.triu_indices(len(mean))] = upper
    return Block(n, np.array(mean), scatter + np.triu(scatter, 1).T)


def _merge(parts: dict[tuple[str, int], Block], key: tuple[str, int], block: Block) -> None:
    parts[key] = parts[key].merged(block) if key in parts else block


def _collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[tuple[str, int], Block] = {}
    for batch in batches:
        for target, at, n, mean, upper in zip(*(batch.column(c).to_pylist() for c in ("target", "slice", "n", "mean", "upper"))):
            _merge(parts, (target, at), _unpacked(n, mean, upper))
    yield _packed(parts)


def blocks(df: DataFrame, features: Sequence[str], targets: Sequence[str], date: str | None = None, cuts: Sequence = (), spread: int = 64) -> Blocks:
    """One scan of ``df``: a block per target and slice of days. Rows without a value of a target don't count for it.

    ``cuts`` are dates (or other values of ``date``); rows without a date come in no slice. A predictor that is
    missing in a row that counts is refused.
    """
    features, targets, cuts = list(features), list(targets), sorted(set(cuts))
    at = sum(((F.col(date) > F.lit(c)).cast("int") for c in cuts), F.lit(0)) if cuts else F.lit(0)
    rows = df.where(F.col(date).isNotNull()) if cuts else df
    number = lambda c, name: F.col(c).cast("double").alias(name)
    rows = rows.select(
        at.alias("slice"), *[number(c, f"x{k}") for k, c in enumerate(features)], *[number(c, f"y{k}") for k, c in enumerate(targets)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[tuple[str, int], Block] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            slices, x = columns[0], np.column_stack(columns[1 : len(features) + 1]) if features else np.empty((batch.num_rows, 0))
            for target, y in zip(targets, columns[len(features) + 1 :]):
                for k in np.unique(slices):
                    use = (slices == k) & ~np.isnan(y)
                    if use.any():
                        if np.isnan(x[use]).any():
                            raise ValueError("a predictor is missing: impute first")
                        _merge(parts, (target, int(k)), Block.of(np.column_stack([x[use], y[use]])))
        yield _packed(parts)

    sums = rows.mapInArrow(run, _SCHEMA).withColumn("part", F.spark_partition_id() % spread)
    sums = sums.repartition("target", "slice", "part").drop("part").mapInArrow(_collected, _SCHEMA)
    sums = sums.repartition("target", "slice").mapInArrow(_collected, _SCHEMA)
    parts = {(r["target"], r["slice"]): _unpacked(r["n"], r["mean"], r["upper"]) for r in sums.collect()}
    return Blocks(features, cuts, parts)


def predictions(df: DataFrame, features: Sequence[str], models: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``df`` once per row of ``models`` with the same ``by``: its other columns, and ``prediction``.

    ``models`` (by, intercept, weights in the order of ``features``, ...) has one row per fitted model and is broadcast.
    """
    x = F.array(*[F.col(c).cast("double") for c in features])
    found = df.withColumn("_x", x)
    found = found.join(F.broadcast(models), list(by)) if by else found.crossJoin(F.broadcast(models))
    total = F.aggregate(F.zip_with("_x", "weights", lambda a, w: a * w), F.lit(0.0), lambda s, v: s + v)
    return found.withColumn("prediction", total + F.col("intercept")).drop("_x", "weights", "intercept")


def expanding_cv(df: DataFrame, folds: DataFrame, date: str, targets: Sequence[str], features: Sequence[str], models: Mapping[str, tuple[str, float]]) -> DataFrame:
    """(target, model, fold, metrics): models fitted on the days up to ``train_end`` and scored on the fold.

    ``models`` gives a kind (``ridge``, with penalty 0 for least squares, or ``lasso``) and a penalty per name. One scan
    of ``df`` sums the blocks, whatever the number of folds, targets and models; a second one scores all of them.
    The handful of fold bounds comes to the driver.
    """
    spark = df.sparkSession
    bounds = folds.orderBy("fold").collect()
    summed = blocks(df, features, targets, date, [b["train_end"] for b in bounds])
    rows = []
    for b in bounds:
        for target in targets:
            block = summed.upto(target, b["train_end"])
            for name, (kind, alpha) in models.items():
                model = {"ridge": ridge, "lasso": lasso}[kind](block, features, alpha)
                rows.append((b["fold"], target, name, model.intercept, model.weights))
    fitted = spark.createDataFrame(rows, "fold int, target string, model string, intercept double, weights array<double>")
    ranges = spark.createDataFrame([(b["fold"], b["val_start"], b["val_end"]) for b in bounds], f"fold int, _first {_type(df, date)}, _last {_type(df, date)}")
    held = df.join(F.broadcast(ranges), F.col(date).between(F.col("_first"), F.col("_last")))
    actual = F.coalesce(*[F.when(F.col("target") == t, F.col(t).cast("double")) for t in targets])
    scored = predictions(held, features, fitted, ["fold"]).select("target", "model", "fold", actual.alias("actual"), F.col("prediction").alias("predicted"))
    return flow_metrics(scored, "actual", "predicted", ["target", "model", "fold"], shortfalls=True)


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()
