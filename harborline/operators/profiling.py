"""Table profiles: nulls, distinct values, descriptions and dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators.columns import columns_by_type
from harborline.operators.quantiles import quantile_columns


def null_profile(df: DataFrame, digits: int = 2) -> DataFrame:
    """(column, nulls, null_pct, rows) for every column, from one pass."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col("_rows") - F.col(c)).alias("nulls"),
            F.bround((F.col("_rows") - F.col(c)) / F.nullif("_rows", F.lit(0)) * 100, digits).alias("null_pct"),
            F.col("_rows").alias("rows"),
        )
        for c in df.columns
    ]
    return counted.select(F.inline(F.array(*cells)))


def text_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long form (column, value) of all columns as text, nulls left out."""
    columns = list(columns or df.columns)
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .where(F.col("value").isNotNull())
    )


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, distinct): different not-null values of every column.

    Cells travel as 128-bit digests that each task reduces first, so no text is shuffled; two values of a column share
    a digest with odds of 2^-128 a pair.
    """
    columns = list(columns or df.columns)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, distinct long")
    types = dict(df.dtypes)
    plain = lambda c: F.to_json(F.struct(c)) if "map<" in types[c] else F.col(c)  # maps have no hash of their own
    digest = lambda k, c: F.struct(F.lit(k).alias("at"), F.xxhash64(plain(c)).alias("a"), F.xxhash64(F.lit(1), plain(c)).alias("b"))
    cells = df.select(F.inline(F.filter(F.array(*[F.when(F.col(f"`{c}`").isNotNull(), digest(k, c)) for k, c in enumerate(columns)]), lambda x: x.isNotNull())))
    counted = cells.distinct().groupBy("at").agg(F.count(F.lit(1)).alias("distinct"))
    return counted.select(F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("at") + 1).alias("column"), "distinct")


def first_values(df: DataFrame, order: Sequence[str], samples: int = 3) -> DataFrame:
    """(column, samples): values of the first rows by ``order``, as one text a column."""
    first = df.orderBy(*order).limit(samples).select(
        *[F.col(c).cast("string").alias(c) for c in df.columns], F.struct(*order).alias("_at")
    )
    return (
        first.unpivot(["_at"], df.columns, "column", "value")
        .groupBy("column")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "value"))), lambda s: s["value"]), ", ", "null").alias("samples"))
    )


def data_dictionary(df: DataFrame, order: Sequence[str], samples: int = 3) -> DataFrame:
    """(column, type, distinct, missing, samples): samples come from the first rows by ``order``."""
    types = [F.struct(F.lit(n).alias("column"), F.lit(t).alias("type")) for n, t in df.dtypes]
    base = null_profile(df).select("column", F.col("nulls").alias("missing"))
    return (
        df.sparkSession.range(1)
        .select(F.inline(F.array(*types)))
        .join(base, "column", "left")
        .join(distinct_counts(df), "column", "left")
        .join(first_values(df, order, samples), "column", "left")
        .withColumn("distinct", F.coalesce("distinct", F.lit(0)))
    )


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, exact quartiles and maximum per column."""
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.groupBy(*by).agg(*[f(v).alias(f"{c}__{n}") for c, v in known.items() for n, f in stats.items()])
    cells = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{n}").alias(n) for n in stats]) for c in columns]
    moments = wide.select(*by, F.inline(F.array(*cells)))
    quartiles = quantile_columns(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by)
    return moments.join(quartiles, [*by, "column"], "left")


def feature_category(name: str) -> tuple[str, str]:
    """Category and description of a feature from its name."""
    if name.endswith("_lag"):
        return "lag", "Value some periods back"
    if "_rolling_" in name:
        return "rolling", "Statistic over the preceding periods"
    if name.endswith("_baseline"):
        return "baseline", "Baseline prediction"
    if name.endswith(("_sin", "_cos")):
        return "cyclical", "Position on the yearly or weekly circle"
    if name in ("year", "month", "day", "dayofweek", "dayofyear", "weekofyear", "quarter"):
        return "calendar", "Part of the date"
    if name.startswith("is_"):
        return "flag", "Calendar flag"
    if name in ("tran_br_code", "start_date"):
        return "key", "Branch or date"
    return "measure", "Observed amount or count"


def feature_dictionary(df: DataFrame, order: Sequence[str], samples: int = 3) -> DataFrame:
    """Every column, keys and dates included, with what it is and what it holds.

    (column, category, description, type, non_null, missing, missing_pct, distinct, min, max, mean, samples): ``min``,
    ``max`` and ``mean`` are null for columns that aren't numbers, ``missing_pct`` is null for an empty table, and samples
    come from the first rows by ``order``. One aggregate makes the statistics, another the distinct counts.
    """
    numeric = set(columns_by_type(df)["numeric"])
    stats = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"{c}__n") for c in df.columns],
        *[f(c).cast("double").alias(f"{c}__{n}") for c in df.columns if c in numeric for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))],
    )
    number = lambda c, n: F.col(f"{c}__{n}") if c in numeric else F.lit(None).cast("double")
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(feature_category(c)[0]).alias("category"),
            F.lit(feature_category(c)[1]).alias("description"),
            F.lit(t).alias("type"),
            F.col(f"{c}__n").alias("non_null"),
            (F.col("_rows") - F.col(f"{c}__n")).alias("missing"),
            F.bround((F.col("_rows") - F.col(f"{c}__n")) / F.nullif("_rows", F.lit(0)) * 100, 2).alias("missing_pct"),
            number(c, "min").alias("min"),
            number(c, "max").alias("max"),
            number(c, "avg").alias("mean"),
        )
        for c, t in df.dtypes
    ]
    return (
        stats.select(F.inline(F.array(*cells)))
        .join(distinct_counts(df), "column", "left")
        .join(first_values(df, order, samples), "column", "left")
        .withColumn("distinct", F.coalesce("distinct", F.lit(0)))
    )


def low_cardinality_counts(df: DataFrame, limit: int = 20) -> DataFrame:
    """(column, value, n) of the columns that hold at most ``limit`` distinct values."""
    counts = text_cells(df).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    few = counts.groupBy("column").agg(F.count(F.lit(1)).alias("_d")).where(F.col("_d") <= limit)
    return counts.join(few.select("column"), "column", "left_semi")


def cleaning_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """(measure, value): rows before, after and removed."""
    n = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    return (
        n(before).select(F.col("n").alias("before"), n(after).scalar().alias("after"))
        .select(
            F.inline(
                F.array(
                    F.struct(F.lit("rows_before").alias("measure"), F.col("before").alias("value")),
                    F.struct(F.lit("rows_after").alias("measure"), F.col("after").alias("value")),
                    F.struct(F.lit("rows_removed").alias("measure"), (F.col("before") - F.col("after")).alias("value")),
                )
            )
        )
    )
