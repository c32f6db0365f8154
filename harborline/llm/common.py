"""Helpers the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.session import cut

__all__ = ["WORD", "components", "cut", "fresh", "row_key", "table", "words"]

# Fixed value: a word is a run of characters other than space, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """All words of a text as an array; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, whatever its extra columns are called."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def row_key(df: DataFrame) -> Column:
    """64 bits that tell rows of one id apart: every column counts, and so does where nulls stand.

    Equal rows have equal keys. Different rows of the same id share one with odds of 2^-64 a pair.
    """
    parts = []
    for field in df.schema.fields:
        simple = not isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
        parts += [F.col(field.name).isNull(), F.col(field.name) if simple else F.col(field.name).cast("string")]
    return F.xxhash64(*parts)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (id, component) per id in an edge.

    Alternates large-star and small-star steps: every step points ids at the smallest id they know,
    and a hub keeps one edge per neighbour, so no step makes more edges than it got. Each round is
    written to the shared folder; only its row count and checksum reach the driver.
    """
    pairs = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    pairs = cut(pairs)
    seen = None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
        )
        pairs = cut(small.distinct())
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == tuple(now):
            break
        seen = tuple(now)
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    linked = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return linked.unionByName(linked.select(F.col("component").alias("id"), "component").distinct())
