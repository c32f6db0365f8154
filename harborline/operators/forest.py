"""Forests of regression trees, grown on sums over cells of binned features.

Splits see a feature by its bin only, so the counts, sums and sums of squares of a sample's labels per cell (one bin of every
feature) decide a whole tree. One scan draws the samples of all trees and sums them; no row is kept with its counts, which would take
rows times trees of memory and disk. The trees are MLlib's: same draws per row (Poisson of mean 1), points, gains and stops.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.util import DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from harborline.session import drop_at_end, scratch_path

BINS = 32  # of a feature, as MLlib has them by default
CELLS = 1 << 12  # at most; a task holds three sums for each cell and tree
PROBES = 1 << 10  # values, at most, that stand for up to ROWS rows of a feature where points are placed
DRAWN = 1 << 18  # draws at once
ROWS = 1 << 20  # about as many rows, at least, share one table of sums on its way through the shuffle, and as many one of values

SUMS = "tree int, cell int, n double, s double, q double"
NODES = "tree int, id int, prediction double, impurity double, n double, s double, q double, gain double, left int, right int, feature int, point double"
_LIMITS = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
_GUIDE = np.searchsorted(_LIMITS, np.arange(1 << 16) / 65536, side="right").astype(np.uint8)
_GUIDE[np.unique((_LIMITS * 65536).astype(int).clip(max=65535))] = 255  # a limit lies inside: 16 bits don't tell


def number(name: str) -> Column:
    """A feature as a double; a null or NaN is an error, as in MLlib's assembler."""
    value = F.col(name).cast("double")
    return F.when(value.isNull() | F.isnan(value), F.raise_error(F.lit(f"null or NaN in feature {name}"))).otherwise(value)


def points_between(kinds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Up to about ``BINS`` - 1 midpoints of neighbouring ``kinds``, in order, that part their rows evenly: all of them where they are as few."""
    with np.errstate(invalid="ignore"):
        middle = (kinds[:-1] + kinds[1:]) / 2
    if len(middle) >= BINS:
        stride, kept, seen = counts.sum() / BINS, [], np.cumsum(counts)
        for i in range(1, len(kinds)):
            target = stride * (len(kept) + 1)
            if abs(seen[i - 1] - target) < abs(seen[i] - target):
                kept.append(i - 1)
        middle = middle[kept]
    return np.unique(middle[~np.isnan(middle)])


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, value, times): the values of each column and their numbers, or quantiles for them where values are many."""

    def found(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, column in enumerate(pa.Table.from_batches(parts).columns):
            x = np.sort(column.to_numpy() + 0.0)
            kinds, times = np.unique(x, return_counts=True)
            if len(kinds) > PROBES:
                ends = np.arange(PROBES + 1) * len(x) // PROBES
                kinds, times = x[(ends[:-1] + ends[1:]) // 2], np.diff(ends)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kinds), k, np.int32)), pa.array(kinds), pa.array(times)], ["feature", "value", "times"])

    held, n = [], 0
    for batch in batches:
        held, n = [*held, batch], n + batch.num_rows
        if n >= ROWS:
            yield from found(held)
            held, n = [], 0
    if n:
        yield from found(held)


def split_points(df: DataFrame, features: Sequence[str]) -> list[np.ndarray] | None:
    """Per feature the points to split at, placed over all rows (MLlib draws some 10,000 of them): exactly for up to ``PROBES`` values,
    for more to a thousandth of the rows. None where cells would be too many, or features no numbers."""
    if 1 << len(features) > CELLS or not all(isinstance(f.dataType, NumericType) for f in df.select(*features).schema):
        return None
    rows = df.select(*[number(f).alias(f"x{k}") for k, f in enumerate(features)])
    values = rows.mapInArrow(_probed, "feature int, value double, times long").groupBy("feature", "value").agg(F.sum("times").alias("times"))
    found = {c: v.to_numpy() for c, v in zip(("feature", "value", "times"), values.orderBy("feature", "value").toArrow().columns)}
    of = [found["feature"] == k for k in range(len(features))]
    points = [points_between(found["value"][at], found["times"][at]) for at in of]
    return points if n_cells(points) <= CELLS else None


def n_cells(points: Sequence[np.ndarray]) -> int:
    return math.prod(len(p) + 1 for p in points)


def bins_of(cells: np.ndarray, points: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The bin of each feature in cells numbered row by row."""
    return list(np.unravel_index(cells, [len(p) + 1 for p in points]))


def drawn(rng: np.random.Generator, rows: int, trees: int) -> np.ndarray:
    """How often each row is in the sample of each tree: Poisson of mean 1, by a table of its limits."""
    bits = rng.integers(0, 1 << 16, (rows, trees), dtype=np.uint16)
    times = _GUIDE[bits]
    near = np.nonzero(times == 255)
    times[near] = np.searchsorted(_LIMITS, (bits[near] + rng.random(len(near[0]))) / 65536, side="right")
    return times


def _sampled(points: Sequence[np.ndarray], trees: int, seed: int) -> Callable:
    """Sums per tree and cell over the rows of one partition: count, label and squared label, each as often as it was drawn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, 0, TaskContext.get().partitionId()])
        sums = np.zeros((n_cells(points), 3, trees))
        for batch in batches:
            *xs, y = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cell = np.ravel_multi_index([np.searchsorted(p, x) for p, x in zip(points, xs)], [len(p) + 1 for p in points])
            order = np.argsort(cell, kind="stable")
            step = max(1, DRAWN // trees)
            for at in range(0, len(order), step):
                part = order[at : at + step]
                times = drawn(rng, len(part), trees).astype(float)
                here, terms = cell[part], np.stack([np.ones(len(part)), y[part], y[part] ** 2])
                ends = [*(np.flatnonzero(np.diff(here)) + 1), len(part)]
                for low, high in zip([0, *ends], ends):
                    sums[here[low]] += terms[:, low:high] @ times[low:high]
        for tree in range(trees):
            cells = np.flatnonzero(sums[:, 0, tree])
            columns = [np.full(len(cells), tree, np.int32), cells.astype(np.int32), *sums[cells, :, tree].T]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["tree", "cell", "n", "s", "q"])

    return run


def _impurity(n: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (q - s * s / n) / n


def grow(cells: np.ndarray, sums: np.ndarray, points: Sequence[np.ndarray], depth: int, leaf: int, each: int, rng: np.random.Generator) -> list[tuple]:
    """The nodes (id, prediction, impurity, n, s, q, gain, left, right, feature, point) of one tree, parents before children.

    ``sums`` has a row (n, s, q) for each of ``cells``. A node splits one of ``each`` features drawn for it, so that both sides
    keep ``leaf`` rows, where variance falls most; leaves have gain, children and feature -1.
    """
    bins = bins_of(cells, points)
    nodes: list[tuple] = []
    todo, made = [(np.arange(len(cells)), 0)], 1
    for at, level in todo:  # grows while nodes split
        n, s, q = total = sums[at].sum(axis=0)
        impurity = float(_impurity(n, s, q))
        best, feature, place = 0.0, -1, -1
        if level < depth and abs(impurity) >= np.finfo(float).eps:
            for f in rng.choice(len(points), each, replace=False):
                if not len(points[f]):
                    continue
                left = np.stack([np.bincount(bins[f][at], sums[at, k], len(points[f]) + 1) for k in range(3)]).cumsum(axis=1)[:, :-1]
                right = total[:, None] - left
                kept = np.minimum(left[0], right[0]) >= max(leaf, 1)
                with np.errstate(divide="ignore", invalid="ignore"):  # sides without rows aren't kept
                    gains = np.where(kept, impurity - left[0] / n * _impurity(*left) - right[0] / n * _impurity(*right), -1.0)
                p = int(gains.argmax())
                if gains[p] > best:
                    best, feature, place = float(gains[p]), int(f), p
        if feature < 0:
            nodes.append((len(nodes), s / n, impurity, n, s, q, -1.0, -1, -1, -1, 0.0))
            continue
        nodes.append((len(nodes), s / n, impurity, n, s, q, best, made, made + 1, feature, float(points[feature][place])))
        goes = bins[feature][at] <= place
        todo += [(at[goes], level + 1), (at[~goes], level + 1)]
        made += 2
    return nodes


def _grown(points: Sequence[np.ndarray], depth: int, leaf: int, each: int, seed: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("cell")
        tree = table["tree"][0].as_py()
        sums = np.stack([table[c].to_numpy() for c in "nsq"], axis=1)
        nodes = grow(table["cell"].to_numpy(), sums, points, depth, leaf, each, np.random.default_rng([seed, 1, tree]))
        columns = [c.strip().split()[0] for c in NODES.split(",")]
        kinds = {"int": pa.int32(), "double": pa.float64()}
        types = [kinds[c.strip().split()[1]] for c in NODES.split(",")]
        values = [[tree] * len(nodes), *zip(*nodes)]
        return pa.table([pa.array([*v], t) for v, t in zip(values, types)], names=columns)

    return run


def fit(
    df: DataFrame, features: Sequence[str], label: str, points: Sequence[np.ndarray], estimator: RandomForestRegressor, n: int
) -> RandomForestRegressionModel:
    """What ``estimator``, with its default choice of features at a node, would fit on the ``n`` rows with a label."""
    spark, trees, seed = df.sparkSession, estimator.getNumTrees(), estimator.getSeed() & (2**63 - 1)
    each = len(features) if trees == 1 else -(-len(features) // 3)
    y = F.col(label).cast("double")
    rows = df.where(F.col(label).isNotNull()).select(
        *[number(f).alias(f"x{k}") for k, f in enumerate(features)],
        F.when(F.isnan(y), F.raise_error(F.lit(f"NaN in label {label}"))).otherwise(y).alias("y"),
    )
    cores = spark.sparkContext.defaultParallelism
    sampled = rows.coalesce(max(cores, n // ROWS)).mapInArrow(_sampled(points, trees, seed), SUMS)
    sums = sampled.groupBy("tree", "cell").agg(*[F.sum(c).alias(c) for c in "nsq"])
    nodes = sums.repartition(min(cores, trees), "tree").groupBy("tree").applyInArrow(_grown(points, estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), each, seed), NODES)
    return _loaded(nodes, estimator, len(features))


def _loaded(nodes: DataFrame, estimator: RandomForestRegressor, n_features: int) -> RandomForestRegressionModel:
    """The model of ``nodes``, by way of MLlib's own format in the shared folder."""
    spark, trees = nodes.sparkSession, estimator.getNumTrees()
    path = scratch_path(spark, "forest")
    kind = "org.apache.spark.ml.regression.{}".format
    common = json.loads(DefaultParamsWriter._get_metadata_to_save(estimator, spark.sparkContext))
    whole = common | {"class": kind("RandomForestRegressionModel"), "numFeatures": n_features, "numTrees": trees}
    of_tree = ("cacheNodeIds", "featuresCol", "labelCol", "maxDepth", "minInstancesPerNode", "seed")
    params = {k: v for k, v in common["paramMap"].items() if k in of_tree}
    single = lambda: common | {"class": kind("DecisionTreeRegressionModel"), "uid": f"dtr_{uuid.uuid4().hex[:12]}", "paramMap": params, "defaultParamMap": {}}
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    listed = [(k, json.dumps(single()), 1.0) for k in range(trees)]
    spark.createDataFrame(listed, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    points = F.when(F.col("feature") >= 0, F.array("point")).otherwise(F.array().cast("array<double>"))
    split = F.struct(F.col("feature").alias("featureIndex"), points.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    stats = F.array("n", "s", "q").alias("impurityStats")
    row = F.struct(
        "id", "prediction", "impurity", stats, F.col("n").cast("long").alias("rawCount"), "gain", F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split")
    )
    nodes.select(F.col("tree").alias("treeID"), row.alias("nodeData")).write.parquet(f"{path}/data")
    drop_at_end(spark, path)
    return RandomForestRegressionModel.load(path)


def corners(points: Sequence[np.ndarray]) -> list[tuple[float, ...]]:
    """A point of every cell, in their order: the upper ends of its bins."""
    at = bins_of(np.arange(n_cells(points)), points)
    ends = [np.append(p, np.inf)[b].tolist() for p, b in zip(points, at)]
    return list(zip(*ends))


def _bin(value: Column, points: Sequence[float], low: int = 0) -> Column:
    if not len(points):
        return F.lit(low)
    middle = len(points) // 2
    return F.when(value <= F.lit(float(points[middle])), _bin(value, points[:middle], low)).otherwise(_bin(value, points[middle + 1 :], low + middle + 1))


def looked_up(features: Sequence[str], points: Sequence[np.ndarray], values: Sequence[float]) -> Column:
    """The value of the cell that a row lies in: comparisons with the points, no walk through the trees."""
    cell = F.lit(0)
    for f, p in zip(features, points):
        cell = cell * F.lit(len(p) + 1) + _bin(F.col(f).cast("double"), p)
    checks = [number(f).isNull() for f in features]  # raise, are never true
    invalid = checks[0]
    for check in checks[1:]:
        invalid = invalid | check
    table = F.expr("array(" + ", ".join(f"{v!r}D" for v in values) + ")")
    return F.when(invalid, F.lit(None).cast("double")).otherwise(F.get(table, cell))
