"""Calendar features of a date column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_columns(date: Column) -> dict[str, Column]:
    """Date parts (Monday = 0, ISO week), flags as 0/1 and sine/cosine encodings."""
    flag = lambda condition: condition.cast("int")
    month, weekday, day = F.month(date), F.weekday(date), F.dayofmonth(date)
    first, last = day == 1, date == F.last_day(date)
    angle = lambda part, period: 2 * F.pi() * part / period
    return {
        "year": F.year(date),
        "month": month,
        "day": day,
        "dayofweek": weekday,
        "dayofyear": F.dayofyear(date),
        "weekofyear": F.weekofyear(date),
        "quarter": F.quarter(date),
        "is_weekend": flag(weekday >= 5),
        "is_month_start": flag(first),
        "is_month_end": flag(last),
        "is_quarter_start": flag(first & (month % 3 == 1)),
        "is_quarter_end": flag(last & (month % 3 == 0)),
        "month_sin": F.sin(angle(month, 12)),
        "month_cos": F.cos(angle(month, 12)),
        "dayofweek_sin": F.sin(angle(weekday, 7)),
        "dayofweek_cos": F.cos(angle(weekday, 7)),
    }


def calendar_features(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(date)))


def is_weekend(date: Column, first_day: int = 5) -> Column:
    """Weekend test, Monday = 0; ``first_day=6`` counts Sunday only."""
    return F.weekday(date) >= first_day
