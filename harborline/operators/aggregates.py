"""Grouped and whole-table summaries. All of them combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.operators.joins import join_groups
from harborline.operators.quantiles import quantile_columns

DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def rows_of_groups(df: DataFrame, by: Sequence[str], test: Column) -> DataFrame:
    """Rows of the groups whose aggregate passes ``test``.

    The test runs on combined groups and the rows are kept by a semi join, which AQE splits for a
    hot group; a window over the group would hold that group in one task.
    """
    passing = df.groupBy(*by).agg(test.alias("_pass")).where("_pass").select(*by)
    return df.join(passing, list(by), "left_semi")


def in_millions(total: Column) -> Column:
    return F.bround(total / 1e6, 2)


def daily_totals(df: DataFrame) -> DataFrame:
    """Per branch and day: withdrawals, deposits, rows and distinct active hours."""
    return df.groupBy("tran_br_code", "start_date").agg(
        F.round(F.sum("TOTAL_DR"), 2).alias("daily_withdrawals"),
        F.round(F.sum("TOTAL_CR"), 2).alias("daily_deposits"),
        F.count("txn_hour").alias("transaction_count"),
        F.countDistinct("txn_hour").alias("active_hour_count"),
    )


def network_daily(df: DataFrame) -> DataFrame:
    """Per day over all branches."""
    return df.groupBy("start_date").agg(
        F.round(F.sum("TOTAL_DR"), 2).alias("daily_withdrawals"),
        F.round(F.sum("TOTAL_CR"), 2).alias("daily_deposits"),
        F.countDistinct("tran_br_code").alias("active_branches"),
        F.round(F.sum("TOTAL_CR") - F.sum("TOTAL_DR"), 2).alias("net_cash"),
    )


def weekday_profile(df: DataFrame, date: str, measures: Sequence[str]) -> DataFrame:
    """Mean of each measure per weekday, Monday first."""
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    return (
        df.groupBy(F.weekday(date).alias("day_number"))
        .agg(*[F.avg(m).alias(m) for m in measures])
        .withColumn("day_name", F.element_at(names, F.col("day_number") + 1))
        .orderBy("day_number")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)


def pivot_sum(df: DataFrame, rows: Sequence[str], column: str, value: str, values: Sequence | None = None) -> DataFrame:
    """Sums with one column per value of ``column`` (found first when not given), 0 where empty."""
    grouped = df.groupBy(*rows)
    pivoted = (grouped.pivot(column, list(values)) if values else grouped.pivot(column)).agg(F.sum(value))
    return pivoted.fillna(0)


def share_of_total(df: DataFrame, within: Sequence[str], value: str, name: str, scale: float = 100.0) -> DataFrame:
    """``value`` as a share of its group's total. Group totals are combined first and joined back,
    so that a hot group is not gathered in one task."""
    totals = df.groupBy(*within).agg(F.sum(value).alias("_total"))
    return (
        join_groups(df, totals, within)
        .withColumn(name, F.col(value) / F.nullif(F.col("_total"), F.lit(0)) * scale)
        .drop("_total")
    )


def group_total(df: DataFrame, within: Sequence[str], value: str, name: str) -> DataFrame:
    """Each row with its group's total."""
    return join_groups(df, df.groupBy(*within).agg(F.sum(value).alias(name)), within)


def cell_counts(df: DataFrame, band: str, bands: Sequence[str], column: str) -> DataFrame:
    """Counts of band x column values with empty cells, and each band's total as parent.

    The grid is built by exploding the fixed band list on the distinct values of ``column``.
    """
    counts = df.where(F.col(band).isNotNull()).groupBy(band, column).agg(F.count(F.lit(1)).alias("n"))
    grid = df.select(column).distinct().select(F.explode(F.array(*[F.lit(b) for b in bands])).alias(band), column)
    cells = grid.join(counts, [band, column], "left").fillna(0, subset=["n"])
    parents = cells.groupBy(band).agg(F.sum("n").alias("parent_n"))
    return cells.join(parents, band)


def modal_value(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value, the smallest on a tie, with its count."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.groupBy(*by)
        .agg(F.min(F.struct((-F.col("n")).alias("less"), F.col(column).alias("value"))).alias("_m"))
        .select(*by, F.col("_m.value").alias("mode"), (-F.col("_m.less")).alias("n"))
    )


def moments(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Range, population variance, skewness and excess kurtosis."""
    return df.groupBy(*by).agg(
        (F.max(column) - F.min(column)).alias("range"),
        F.var_pop(column).alias("variance"),
        F.skewness(column).alias("skewness"),
        F.kurtosis(column).alias("kurtosis"),
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for all ordered pairs, from one aggregate over the pairs a < b."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cell = lambda a, b, r: F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r"))
    cells = [cell(c, c, F.lit(1.0)) for c in columns]
    for a, b in pairs:
        r = F.col(f"`{a}|{b}`")
        cells += [cell(a, b, r), cell(b, a, r)]
    return row.select(F.inline(F.array(*cells)))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, n) of equal-width bins from minimum to maximum, the last one closed."""
    ends = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    place = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1)))
    counts = (
        df.where(F.col(column).isNotNull()).groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    every = ends.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (
        every.withColumns({"low": F.col("lo") + F.col("bin") * step, "high": F.col("lo") + (F.col("bin") + 1) * step})
        .join(counts, "bin", "left")
        .select("bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))
    )


def box_stats(df: DataFrame, column: str, by: Sequence[str] = (), width: float = 1.5) -> DataFrame:
    """(by..., q1, median, q3, whisker_low, whisker_high, outliers)."""
    by = list(by)
    quartiles = quantile_columns(df, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75}, by).drop("column")
    spread = F.col("q3") - F.col("q1")
    fences = quartiles.withColumns({"_lo": F.col("q1") - width * spread, "_hi": F.col("q3") + width * spread})
    if by:
        marked = join_groups(df, fences, by)
    else:
        names = fences.columns
        marked = df.withColumns({c: fences.select(c).scalar() for c in names})
    inside = F.col(column).between(F.col("_lo"), F.col("_hi"))
    return marked.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(column))).alias("whisker_low"),
        F.max(F.when(inside, F.col(column))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def kde_curve(df: DataFrame, column: str, points: int = 50) -> DataFrame:
    """(x, density): Gaussian kernel density at evenly spaced points, Scott bandwidth.

    Rows are reduced to value counts, and every grid point is one sum over those counts, so rows
    are never multiplied by the grid.
    """
    base = df.where(F.col(column).isNotNull())
    stats = base.agg(
        F.min(column).cast("double").alias("lo"),
        F.max(column).cast("double").alias("hi"),
        F.count(F.lit(1)).alias("n"),
        (F.stddev_samp(column) * F.pow(F.count(F.lit(1)), F.lit(-0.2))).alias("h"),
    )
    lo, hi, n, h = (stats.select(c).scalar() for c in ("lo", "hi", "n", "h"))
    counts = base.groupBy(F.col(column).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    counts = counts.withColumns({"lo": lo, "hi": hi, "n": n, "h": h})
    x = lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * (i / (points - 1))
    kernel = lambda i: F.sum(F.col("c") * F.exp(-0.5 * F.pow((x(i) - F.col("v")) / F.col("h"), 2)))
    sums = counts.groupBy("lo", "hi", "n", "h").agg(*[kernel(i).alias(f"s{i}") for i in range(points)])
    scale = F.col("n") * F.col("h") * F.sqrt(2 * F.pi())
    return sums.select(
        F.inline(F.array(*[F.struct(x(i).alias("x"), (F.col(f"s{i}") / scale).alias("density")) for i in range(points)]))
    )
