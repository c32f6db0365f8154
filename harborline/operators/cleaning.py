"""Coercion, filling, duplicate removal and outlier handling.

Statistics that a cleaning step needs (median, mean, bounds) enter the plan as scalar
subqueries: one aggregate row, no join against the data and no driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.operators.columns import columns_by_type
from harborline.operators.quantiles import medians, one_row, quantile_columns

# Words that mark a column as cash or date related, and characters to delete.
CASH_WORDS = ("cash", "deposit", "withdrawal", "balance", "amount", "total_dr", "total_cr", "dr", "cr")
OUTLIER_WORDS = (*CASH_WORDS, "debit", "credit")
DATE_WORDS = ("date", "datetime", "timestamp", "time")
SPECIAL_CHARACTERS = "!@#$%^&*()\\"
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd-MM-yyyy", "dd.MM.yyyy")


def named_like(name: str, words: Sequence[str], substrings: bool = False) -> bool:
    """Whether a column name contains one of the words as whole tokens (or anywhere)."""
    lowered = name.lower()
    if substrings:
        return any(word in lowered for word in words)
    return any(f"_{word}_" in f"_{lowered}_" or f"_{word}s_" in f"_{lowered}_" for word in words)


def cash_columns(df: DataFrame, words: Sequence[str] = CASH_WORDS, substrings: bool = False) -> list[str]:
    return [c for c in columns_by_type(df)["numeric"] if named_like(c, words, substrings)]


def coerce_number(value: Column, to: str = "double") -> Column:
    """Number, or null for text that is none."""
    return value.try_cast(to)


def coerce_date(value: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that parses, day before month; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in formats])


def date_columns(df: DataFrame, keys: Sequence[str] = (), share: float = 0.6) -> list[str]:
    """Columns named like dates; without any, text columns of whose values over ``share`` parse.

    All values of all text columns are tried, in one aggregate.
    """
    named = [c for c in df.columns if c not in keys and any(w in c.lower() for w in DATE_WORDS)]
    if named:
        return named
    texts = [name for name, kind in df.dtypes if kind == "string" and name not in keys]
    if not texts:
        return []
    parsed = [F.count(coerce_date(F.col(c))).alias(f"p{k}") for k, c in enumerate(texts)]
    counts = df.agg(*parsed, *[F.count(F.col(c)).alias(f"n{k}") for k, c in enumerate(texts)]).first()
    return [c for k, c in enumerate(texts) if counts[f"p{k}"] > share * counts[f"n{k}"]]


def fill_zero_cash(df: DataFrame, substrings: bool = False) -> DataFrame:
    return df.fillna(0, subset=cash_columns(df, substrings=substrings))


def _with_scalars(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Each statistic of a one-row frame as a scalar subquery."""
    return {c: stats.select(c).scalar() for c in columns}


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = _with_scalars(df, medians(df, columns), columns)
    return df.withColumns({c: F.coalesce(F.col(c), values[c]) for c in columns})


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = _with_scalars(df, df.agg(*[F.avg(c).alias(c) for c in columns]), columns)
    return df.withColumns({c: F.coalesce(F.col(c), values[c]) for c in columns})


def fill_latest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = _with_scalars(df, df.agg(*[F.max(c).alias(c) for c in columns]), columns)
    return df.withColumns({c: F.coalesce(F.col(c), values[c]) for c in columns})


def fill_from(target: str, source: str, condition: Column) -> Column:
    """Value of ``source`` where ``target`` is null and the condition holds."""
    return F.when(F.col(target).isNull() & condition, F.col(source)).otherwise(F.col(target))


def keep_unrepeated(df: DataFrame) -> DataFrame:
    """Only rows that occur once: every copy of a repeated row goes."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each distinct row."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return per_row.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def iqr_bounds(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), width: float = 1.5) -> DataFrame:
    """(by..., column, q1, q3, lower, upper)."""
    spread = F.col("q3") - F.col("q1")
    return quantile_columns(df, columns, {"q1": 0.25, "q3": 0.75}, by).withColumns(
        {"lower": F.col("q1") - width * spread, "upper": F.col("q3") + width * spread}
    )


def _bound_scalars(df: DataFrame, columns: Sequence[str], width: float) -> dict[str, tuple[Column, Column]]:
    row = one_row(iqr_bounds(df, columns, width=width), columns, ["lower", "upper"])
    return {c: (row.select(f"{c}_lower").scalar(), row.select(f"{c}_upper").scalar()) for c in columns}


def iqr_clip(df: DataFrame, columns: Sequence[str] | None = None, width: float = 1.5) -> DataFrame:
    """Cap values at the bounds; ``<column>_capped`` tells which rows changed."""
    columns = list(columns) if columns is not None else cash_columns(df, OUTLIER_WORDS)
    bounds = _bound_scalars(df, columns, width)
    capped = {c: F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c), hi), lo)) for c, (lo, hi) in bounds.items()}
    flags = {f"{c}_capped": F.coalesce(capped[c] != F.col(c), F.lit(False)) for c in columns}
    return df.withColumns({**flags, **capped})


def iqr_filter(df: DataFrame, columns: Sequence[str], width: float = 1.5) -> DataFrame:
    """Rows whose values all lie within the bounds."""
    for column, (low, high) in _bound_scalars(df, columns, width).items():
        df = df.where(F.col(column).between(low, high))
    return df


def clip_nonnegative(value: Column) -> Column:
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def strip_special(value: Column, characters: str = SPECIAL_CHARACTERS) -> Column:
    return F.translate(value, characters, "")


def clean_numeric_text(value: Column, placeholder: str = "-") -> Column:
    """Number from text with thousands separators; the placeholder alone means 0."""
    bare = F.trim(F.regexp_replace(value, ",", ""))
    return F.when(bare == placeholder, F.lit("0")).otherwise(bare).try_cast("double")
