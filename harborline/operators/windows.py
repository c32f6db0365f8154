"""Ordered computations that stay parallel when one group is very large.

A plain window sends each group to one task. ``running_total`` splits a group at the values of a
bucket column that is monotone in the ordering: totals per bucket are summed with map-side
combine, the running sum over those few totals gives each bucket its starting offset, and the
window proper runs inside (group, bucket).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


COARSE, FINE = 10, 16  # leading bits of the fraction that part values into slots, and further bits inside a slot


def value_slots(value: Column) -> tuple[Column, Column]:
    """Two whole numbers in whose order values stand: a coarse slot, and a fine one inside it.

    They are the leading bits of a double: sign, exponent and ``COARSE`` bits of the fraction, then ``FINE`` more. So
    slots are as narrow beside zero as far from it, whatever else a column holds, and no pass over the
    data is needed to place them. NaN comes last; nulls have no slot.
    """
    value = value.cast("double")
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    at = F.greatest(F.lit(0.0), size / F.pow(F.lit(2.0), exponent.cast("double")) - 1) * float(1 << COARSE)
    whole = F.floor(at)
    slot = (exponent + 1_100) * (1 << COARSE) + F.least(whole, F.lit((1 << COARSE) - 1))
    part = F.floor((at - whole) * float(1 << FINE))
    endless = size == F.lit(float("inf"))
    signed = lambda x: F.when(value < 0, -x).otherwise(x).cast("long")
    coarse = F.when(endless, F.lit(1 << 40)).when(F.isnan(value), F.lit(1 << 41)).when(size > 0, slot).otherwise(0)
    fine = F.when((size > 0) & ~endless & ~F.isnan(value), part).otherwise(0)
    return F.when(value.isNotNull(), signed(coarse)), F.when(value.isNotNull(), signed(fine))


def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    bucket: Column | Sequence[Column],
    measures: Mapping[str, str],
) -> DataFrame:
    """Add running sums (first row to current row) named by ``measures`` (new name -> column).

    ``order`` must be unique within ``by``, and ``bucket`` must not decrease along it. Several bucket columns
    nest: each orders the rows that share the ones before it.
    """
    nested = [bucket] if isinstance(bucket, Column) else list(bucket)
    names = [f"_bucket{k}" for k in range(len(nested))]
    marked = df.withColumns(dict(zip(names, nested)))
    totals = marked.groupBy(*by, *names).agg(*[F.sum(source).alias(f"_sum_{name}") for name, source in measures.items()])
    # what comes before a bucket: earlier buckets that share all but the last name, and what comes before those
    offsets = None
    for depth in range(1, len(names) + 1):
        keys = [*by, *names[:depth]]
        sums = totals if depth == len(names) else totals.groupBy(*keys).agg(*[F.sum(f"_sum_{n}").alias(f"_sum_{n}") for n in measures])
        earlier = Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
        found = sums.select(
            *[F.col(k).alias(f"_{depth}_{k}") for k in keys], *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_{depth}_before_{n}") for n in measures]
        )
        if offsets is None:
            offsets = found.select(*[F.col(f"_1_{k}").alias(f"_k_{k}") for k in keys], *[F.col(f"_1_before_{n}").alias(f"_before_{n}") for n in measures])
            continue
        same = F.lit(True)
        for k in keys[:-1]:
            same = same & F.col(f"_k_{k}").eqNullSafe(F.col(f"_{depth}_{k}"))
        offsets = found.join(offsets, same).select(
            *[F.col(f"_{depth}_{k}").alias(f"_k_{k}") for k in keys], *[(F.col(f"_before_{n}") + F.col(f"_{depth}_before_{n}")).alias(f"_before_{n}") for n in measures]
        )
    same = F.lit(True)
    for key in (*by, *names):
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    inside = Window.partitionBy(*by, *names).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        marked.join(offsets, same)
        .withColumns({n: F.sum(c).over(inside) + F.col(f"_before_{n}") for n, c in measures.items()})
        .select(*df.columns, *measures)
    )


def rolling_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    source: str,
    size: int,
    name: str,
    bucket: Column | Sequence[Column] | None = None,
) -> DataFrame:
    """Sum of the current and the ``size - 1`` earlier rows of the group; null where all of them are null.

    Without ``bucket`` a group is one window: meant for groups of one row per period, whose length the calendar
    bounds. With it, a group is cut into slices of equal bucket values, which must not decrease along ``order``; each
    slice is a window of its own and gets the last ``size - 1`` rows before it. ``order`` must be unique
    within ``by`` for a defined result.
    """
    frame = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(size - 1), 0)
    if bucket is None or size < 2:
        return df.withColumn(name, F.sum(source).over(frame))
    nested = [bucket] if isinstance(bucket, Column) else list(bucket)
    marked = df.withColumn("_slice", F.struct(*[b.alias(f"b{k}") for k, b in enumerate(nested)]))
    # the last rows of every slice, taken before the shuffle; each slice has one at least, so those of the
    # size - 1 slices before hold whatever a slice can need
    ends = top_n(marked, [*by, "_slice"], [F.col(c).desc() for c in order], size - 1, "_from_end")
    tails = ends.groupBy(*by, "_slice").agg(
        F.transform(F.sort_array(F.collect_list(F.struct((-F.col("_from_end")).alias("at"), F.col(source).alias("value")))), lambda x: x["value"]).alias("_tail")
    )
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(-(size - 1), -1)
    carried = F.coalesce(F.flatten(F.collect_list("_tail").over(earlier)), F.array().cast(tails.schema["_tail"].dataType))
    halos = tails.withColumn("_halo", carried).select(*[F.col(k).alias(f"_k_{k}") for k in (*by, "_slice")], "_halo")
    same = F.lit(True)
    for key in (*by, "_slice"):
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    inside = Window.partitionBy(*by, "_slice").orderBy(*order)
    missing = F.least(F.greatest(F.lit(size) - F.col("_place"), F.lit(0)), F.size("_halo"))
    before = F.filter(F.slice("_halo", F.size("_halo") - missing + 1, missing), lambda x: x.isNotNull())
    wide = df.select(F.sum(source)).schema[0].dataType
    zero = F.lit(0).cast(wide)
    carry = F.aggregate("_before", zero, lambda total, x: (total + x).cast(wide))
    return (
        marked.join(halos, same)
        .withColumns({"_place": F.row_number().over(inside), "_sum": F.sum(source).over(inside.rowsBetween(-(size - 1), 0))})
        .withColumn("_before", F.when(missing > 0, before))
        .withColumn(name, F.when(F.coalesce(F.size("_before"), F.lit(0)) > 0, F.coalesce("_sum", zero) + carry).otherwise(F.col("_sum")))
        .select(*df.columns, name)
    )


def previous_growth(df: DataFrame, by: Sequence[str], order: str, source: str) -> DataFrame:
    """Value of the preceding period and the growth over it in percent, 0 where there is none."""
    window = Window.partitionBy(*by).orderBy(order)
    before = F.lag(source).over(window)
    return df.withColumn("previous", before).withColumn(
        "growth_pct",
        F.coalesce((F.col(source) - F.col("previous")) / F.nullif(F.col("previous"), F.lit(0.0)) * 100, F.lit(0.0)),
    )


def increase_flag(df: DataFrame, by: Sequence[str], order: str, source: str) -> DataFrame:
    """True where the value is above that of the preceding period; false where there is none."""
    before = F.lag(source).over(Window.partitionBy(*by).orderBy(order))
    return df.withColumn("increased", F.coalesce(F.col(source) > before, F.lit(False)))


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group. Spark keeps at most ``n`` rows per group and task before the
    shuffle, so a hot group costs n rows per upstream task."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def recent_n(df: DataFrame, by: Sequence[str], date: str, n: int) -> DataFrame:
    """Last ``n`` rows of each group by date."""
    return top_n(df, by, [F.col(date).desc()], n, "_recent").drop("_recent")
