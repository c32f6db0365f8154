"""Writing CSV tables, JSON reports and the chunk store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def json_report(df: DataFrame, key: str) -> DataFrame:
    """One JSON document per row: (key, report), the nested shape of a metric report."""
    body = [name for name in df.columns if name != key]
    return df.select(key, F.to_json(F.struct(*body)).alias("report"))


def write_json_report(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def upsert(stored: DataFrame, incoming: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Insert or replace by ``key``: an incoming row replaces the stored row of the same key.

    Of incoming rows with one key the last by ``order`` counts, or the largest row where no order is given.
    The stored side is streamed through one anti join, so a rewrite costs one shuffle of keys and no
    sort of whole rows.
    """
    row = F.struct(*[F.col(c) for c in incoming.columns])
    by = F.struct(F.col(order), row) if order else row
    last = incoming.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, by).alias("_row")).select("_row.*")
    kept = stored.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(last)


def write_store(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def upsert_store(spark: SparkSession, current: str, incoming: DataFrame, key: str, target: str) -> str:
    """Write the merged store to a new path; readers keep the old one until it is complete."""
    return write_store(upsert(spark.read.parquet(current), incoming, key), target)


def store_count(spark: SparkSession, path: str) -> DataFrame:
    """Number of stored chunks, from the Parquet footers."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("chunks"))
