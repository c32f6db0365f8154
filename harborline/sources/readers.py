"""Reading CSV, JSON and text folders, and building small or derived tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and a declared schema: no inference pass over the data."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """JSON records. Line-delimited files stay splittable; ``multi_line`` reads a file per task."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_text_documents(
    spark: SparkSession, path: str, extensions: Sequence[str] = ("txt", "md"), separator: str | None = None
) -> DataFrame:
    """Text files below ``path`` as (text, source, page); blank ones are left out.

    A file is one document, or as many as ``separator`` (one character) parts: large corpora are kept in few
    large files, which Spark splits.
    """
    either_case = ",".join("".join(f"[{c.lower()}{c.upper()}]" for c in ext) for ext in extensions)
    return (
        spark.read.text(
            path,
            wholetext=separator is None,
            lineSep=separator,
            recursiveFileLookup=True,
            pathGlobFilter=f"*.{{{either_case}}}",
        )
        .select(
            F.regexp_replace("value", r"^\s+|\s+$", "").alias("text"),
            F.col("_metadata.file_name").alias("source"),
            F.lit(None).cast("int").alias("page"),
        )
        .where(F.length("text") > 0)
    )


def rows(spark: SparkSession, records: Iterable, schema: T.StructType | str) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(list(records), schema)


_STEPS = {"day": "interval 1 day", "month": "interval 1 month", "year": "interval 1 year"}


def date_series(start: Column, end: Column, step: str = "day", at_end: bool = False) -> Column:
    """Array of dates from ``start`` to ``end``; ``at_end`` moves month and year steps to their last day.

    With ``at_end`` only period ends inside [start, end] are kept.
    """
    if step not in _STEPS:
        raise ValueError(f"step must be one of {sorted(_STEPS)}")
    if not at_end:
        return F.sequence(start, end, F.expr(_STEPS[step]))
    first = F.to_date(F.date_trunc("month" if step == "month" else "year", start))
    closes = (lambda d: F.last_day(d)) if step == "month" else (lambda d: F.last_day(F.add_months(d, 11)))
    points = F.transform(F.sequence(first, end, F.expr(_STEPS[step])), closes)
    return F.filter(points, lambda d: d.between(start, end))


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df
