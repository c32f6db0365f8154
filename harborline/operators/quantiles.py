"""Exact quantiles (linear interpolation) by radix selection, without holding a group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation buffer. Here rows are
counted by the leading bits of their value, which combines before the shuffle to a few thousand numbers per
column; that locates the slots in which a wanted rank falls. Only rows in those slots, about a thousandth each, are counted by
value in a second scan, parted by further bits and ordered inside the one part that holds the rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.operators.windows import value_slots


def unpivot(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form (by..., column, value, coarse, fine) of numeric columns, nulls and NaNs left out.

    ``inline`` gives every output column a new identity, without which Spark would not see that
    the two uses of the counts below share one exchange.
    """
    cells = [
        F.struct(*[F.col(k).alias(k) for k in by], F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    rows = df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull() & ~F.isnan("value"))
    coarse, fine = value_slots(F.col("value"))
    return rows.withColumns({"coarse": coarse, "fine": fine})


def _same(keys: Sequence[str], prefix: str) -> Column:
    match = F.lit(True)
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"{prefix}{key}"))
    return match


def _quantile_groups(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(by..., column, q0, q1, ...): one quantile column per entry of ``probs``."""
    keys = [*by, "column"]
    rows = unpivot(df, by, columns)
    few = (lambda t: t) if by else F.broadcast  # without groups: at most two rows per column and probability

    # The two ranks that a linear quantile interpolates between.
    def rank(i: int, p: float) -> Column:
        position = F.lit(float(p)) * (F.col("total") - 1)
        return F.struct(
            F.lit(i).alias("i"), position.alias("position"), F.floor(position).alias("low"), F.ceil(position).alias("high")
        )

    falls = lambda r: (r["high"] >= F.col("before")) & (r["low"] < F.col("before") + F.col("slot_n"))
    up_to = lambda keys, slot: Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda window: F.coalesce(F.sum("slot_n").over(window), F.lit(0))
    slots = (
        rows.groupBy(*keys, "coarse")
        .agg(F.count(F.lit(1)).alias("slot_n"))
        .withColumn("before", earlier(up_to(keys, "coarse")))
        .withColumn("total", F.sum("slot_n").over(Window.partitionBy(*keys)))
        .withColumn("ranks", F.array(*[rank(i, p) for i, p in enumerate(probs)]))
        .withColumn("wanted", F.filter("ranks", falls))
        .where(F.size("wanted") > 0)
        .select(*[F.col(k).alias(f"_s_{k}") for k in (*keys, "coarse")], "before", "wanted")
    )
    inner = [*keys, "coarse"]
    counts = (
        rows.join(few(slots), _same(inner, "_s_"))
        .groupBy(*inner, "fine", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.first("before").alias("base"), F.first("wanted").alias("ranks"))
    )
    parts = (
        counts.groupBy(*inner, "fine")
        .agg(F.sum("n").alias("slot_n"), F.first("base").alias("base"), F.first("ranks").alias("ranks"))
        .withColumn("before", F.col("base") + earlier(up_to(inner, "fine")))
        .withColumn("wanted", F.filter("ranks", falls))
        .where(F.size("wanted") > 0)
        .select(*[F.col(k).alias(f"_t_{k}") for k in (*inner, "fine")], "before", "wanted")
    )
    inside = Window.partitionBy(*inner, "fine").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        counts.join(few(parts), _same([*inner, "fine"], "_t_"))
        .withColumn("last", F.sum("n").over(inside) + F.col("before") - 1)
        .withColumn("first", F.col("last") - F.col("n") + 1)
        .withColumn("w", F.explode("wanted"))
        .where((F.col("w.high") >= F.col("first")) & (F.col("w.low") <= F.col("last")))
    )
    holds = lambda r: F.col(f"w.{r}").between(F.col("first"), F.col("last"))

    def quantile(i: int) -> Column:
        mine = F.col("w.i") == i
        low = F.max(F.when(mine & holds("low"), F.col("value")))
        high = F.max(F.when(mine & holds("high"), F.col("value")))
        part = F.max(F.when(mine, F.col("w.position") - F.col("w.low")))
        return low + (high - low) * part

    return placed.groupBy(*keys).agg(*[quantile(i).alias(f"q{i}") for i in range(len(probs))])


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., column, prob, quantile) with the quantile rule of numpy and pandas."""
    rows = [F.struct(F.lit(float(p)).alias("prob"), F.col(f"q{i}").alias("quantile")) for i, p in enumerate(probs)]
    return _quantile_groups(df, columns, probs, list(by)).select(*by, "column", F.inline(F.array(*rows)))


def quantile_columns(
    df: DataFrame, columns: Sequence[str], probs: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """(by..., column, one column per entry of ``probs``)."""
    found = _quantile_groups(df, columns, list(probs.values()), list(by))
    return found.select(*by, "column", *[F.col(f"q{i}").alias(n) for i, n in enumerate(probs)])


def one_row(quantiles: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Ungrouped quantiles as a single row with columns ``<column>_<name>``."""
    return quantiles.agg(
        *[
            F.max(F.when(F.col("column") == c, F.col(n))).alias(f"{c}_{n}")
            for c in columns
            for n in names
        ]
    )


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Single row with the exact median of each column under the column's own name."""
    found = one_row(quantile_columns(df, columns, {"median": 0.5}), columns, ["median"])
    return found.select(*[F.col(f"{c}_median").alias(c) for c in columns])
