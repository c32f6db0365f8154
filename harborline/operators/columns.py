"""Projection, filtering and column editing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.operators.ordering import global_position


def null_counts(df: DataFrame) -> dict[str, int]:
    """Null count per column: one pass, one row to the driver."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return row.asDict()


def drop_null_columns(df: DataFrame) -> DataFrame:
    counts = null_counts(df)
    return df.select(*[c for c in df.columns if counts[c] == 0])


def columns_by_type(df: DataFrame) -> dict[str, list[str]]:
    """Column names as numeric, datetime, boolean and categorical lists, from the schema alone."""
    groups: dict[str, list[str]] = {"numeric": [], "datetime": [], "boolean": [], "categorical": []}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.NumericType):
            groups["numeric"].append(field.name)
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            groups["datetime"].append(field.name)
        elif isinstance(field.dataType, T.BooleanType):
            groups["boolean"].append(field.name)
        else:
            groups["categorical"].append(field.name)
    return groups


def rows_by_label(df: DataFrame, key: str, labels: Sequence, columns: Sequence[str]) -> DataFrame:
    return df.where(F.col(key).isin(*labels)).select(key, *columns)


def rows_by_position(df: DataFrame, order: Sequence[Column], start: int, stop: int) -> DataFrame:
    """Rows ``start``..``stop - 1`` of the ordering. Each task keeps at most ``stop`` rows."""
    return df.orderBy(*order).limit(stop).offset(start)


def head(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, reverse_order: Sequence[Column], n: int) -> DataFrame:
    """Last ``n`` rows: the first ``n`` of the reversed ordering."""
    return df.orderBy(*reverse_order).limit(n)


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def right_closed_bins(value: Column, edges: Sequence[float]) -> Column:
    """Label ``low-high`` of the bin ``(low, high]`` that holds the value, null outside."""
    label = F.lit(None).cast("string")
    for low, high in reversed(list(zip(edges, edges[1:]))):
        label = F.when((value > low) & (value <= high), F.lit(f"{low:g}-{high:g}")).otherwise(label)
    return label


def first_appearance_codes(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """(column, code): categories numbered from 0 in the order in which they first appear.

    The category list is what gets ordered, not the rows; ``order`` must identify a row.
    """
    seen = df.groupBy(column).agg(F.min(F.struct(*order)).alias("_first"))
    return global_position(seen, ["_first"], "code").select(column, (F.col("code") - 1).alias("code"))


def add_codes(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    return df.join(first_appearance_codes(df, column, order), column, "left")
