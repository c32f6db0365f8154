"""Array columns and matrices kept as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))


def add_vector(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") + y.cast("double"))


def linspace(low: Column, high: Column, points: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: low + (high - low) * i / (points - 1))


def logspace(low: Column, high: Column, points: int) -> Column:
    return F.transform(linspace(low, high, points), lambda e: F.pow(F.lit(10.0), e))


def repeat_each(a: Column, times: int) -> Column:
    return F.flatten(F.transform(a, lambda x: F.array_repeat(x, times)))


def tile(a: Column, times: int) -> Column:
    return F.flatten(F.array_repeat(a, times))


def split_equal(a: Column, parts: int, length: int) -> Column:
    """Array of ``parts`` equal slices of an array of known length."""
    size = length // parts
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.slice(a, i * size + 1, F.lit(size)))


def mesh(df: DataFrame, xs: str, ys: str) -> DataFrame:
    """One row per pair of a row's own two arrays, as x and y."""
    rest = [c for c in df.columns if c not in (xs, ys)]
    return df.select(*rest, ys, F.explode(xs).alias("x")).select(*rest, "x", F.explode(ys).alias("y"))


def transpose(entries: DataFrame) -> DataFrame:
    """(i, j, v) with the indices exchanged."""
    return entries.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def multiply(a: DataFrame, b: DataFrame) -> DataFrame:
    """Product of two matrices of entries (i, j, v): a join on the inner index, summed by cell.

    Cells whose products cancel stay, as zeros. The sum is combined before it is shuffled; a hot inner
    index is split by AQE's skew join.
    """
    left = a.select("i", F.col("j").alias("_k"), F.col("v").cast("double").alias("_x"))
    right = b.select(F.col("i").alias("_k"), "j", F.col("v").cast("double").alias("_y"))
    return left.join(right, "_k").groupBy("i", "j").agg(F.sum(F.col("_x") * F.col("_y")).alias("v"))
