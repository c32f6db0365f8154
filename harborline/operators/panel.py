"""Gap-free daily panels with lag, rolling, baseline and split columns.

A branch has at most one row per calendar day, so windows by branch are bounded by the calendar
whatever the number of transactions. Lags and rolling statistics share one window specification:
one exchange and one sort serve all of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions.calendar import calendar_features
from harborline.operators.quantiles import medians

BRANCH, DATE = "tran_br_code", "start_date"
TARGETS = ("daily_withdrawals", "daily_deposits")
LAGS = (1, 7, 14, 28)
ROLLING = (7, 14, 30)
CURRENT_DAY = ("daily_withdrawals", "daily_deposits", "net_cash", "cash_requirement", "transaction_count", "active_hour_count")


def cash_targets(df: DataFrame) -> DataFrame:
    """Net cash and the nonnegative cash requirement, in cents."""
    gap = F.col("daily_withdrawals") - F.col("daily_deposits")
    need = F.when(gap.isNotNull(), F.greatest(gap, F.lit(0.0)))
    return df.withColumns({"net_cash": F.round(-gap, 2), "cash_requirement": F.round(need, 2)})


def complete_grid(df: DataFrame, branch: str = BRANCH, date: str = DATE) -> DataFrame:
    """Every branch on every day between the first and the last; days without a row get nulls.

    The first and last day reach every branch as scalar subqueries and each branch is exploded
    over its own day sequence.
    """
    ends = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    days = F.sequence(ends.select("lo").scalar(), ends.select("hi").scalar(), F.expr("interval 1 day"))
    grid = df.select(branch).distinct().select(branch, F.explode(days).alias(date))
    return grid.join(df, [branch, date], "left")


def _history(branch: str = BRANCH, date: str = DATE):
    return Window.partitionBy(branch).orderBy(date)


def add_lags(df: DataFrame, targets: Sequence[str] = TARGETS, lags: Sequence[int] = LAGS) -> DataFrame:
    """Value exactly k days back; needs the complete grid."""
    w = _history()
    return df.withColumns({f"{t}_{k}p_lag": F.lag(t, k).over(w) for t in targets for k in lags})


def add_rolling(df: DataFrame, targets: Sequence[str] = TARGETS, windows: Sequence[int] = ROLLING) -> DataFrame:
    """Mean, standard deviation, minimum and maximum of the preceding days only."""
    columns: dict[str, Column] = {}
    for size in windows:
        w = _history().rowsBetween(-size, -1)
        for t in targets:
            name = f"{t}_{size}p_rolling"
            columns[f"{name}_mean"] = F.avg(t).over(w)
            columns[f"{name}_std"] = F.stddev_samp(t).over(w)
            columns[f"{name}_min"] = F.min(t).over(w)
            columns[f"{name}_max"] = F.max(t).over(w)
    return df.withColumns(columns)


def add_baselines(df: DataFrame, targets: Sequence[str] = TARGETS, week: int = 7) -> DataFrame:
    """Previous day, previous week and rolling mean as predictions.

    ``week`` is the period of the last two; 14 reproduces half-day rows counted two per day.
    """
    columns = {}
    for t in targets:
        columns[f"{t}_prev_period_baseline"] = F.col(f"{t}_1p_lag")
        columns[f"{t}_prev_week_baseline"] = F.col(f"{t}_{week}p_lag")
        columns[f"{t}_roll7_avg_baseline"] = F.col(f"{t}_{week}p_rolling_mean")
    return df.withColumns(columns)


def trim_incomplete(
    df: DataFrame, max_lag: int = max(LAGS), retain_through: Column | None = None, first: Column | None = None
) -> DataFrame:
    """Drop the first ``max_lag`` days, and days after ``retain_through`` when given.

    ``first`` is the first day, when it is known from a cheaper table than ``df``.
    """
    first = df.agg(F.min(DATE)).scalar() if first is None else first
    kept = df.where(F.col(DATE) >= F.date_add(first, max_lag))
    return kept if retain_through is None else kept.where(F.col(DATE) <= retain_through)


def chrono_split(df: DataFrame, validation_from: Column, test_from: Column) -> DataFrame:
    """``split`` column: train before the first date, test from the second on."""
    date = F.col(DATE)
    return df.withColumn("split", F.when(date < validation_from, "train").when(date < test_from, "val").otherwise("test"))


def feature_columns(columns: Sequence[str], drop_branch: bool = False) -> list[str]:
    """Predictors: no date, split, same-day measure or baseline, in table order."""
    left_out = {DATE, "split", *CURRENT_DAY, *((BRANCH,) if drop_branch else ())}
    return [c for c in columns if c not in left_out and not c.endswith("_baseline")]


def panel_features(daily: DataFrame, week: int = 7) -> DataFrame:
    """Daily rows to the feature table: targets, grid, calendar, lags, rolling statistics, baselines.

    ``daily`` is read for its ends, its branches and its rows: hand in a written table.
    """
    grid = calendar_features(complete_grid(cash_targets(daily)), DATE)
    features = add_baselines(add_rolling(add_lags(grid)), week=week)
    return trim_incomplete(features, first=daily.agg(F.min(DATE)).scalar())


def coverage_by_branch(grid: DataFrame) -> DataFrame:
    """Expected, observed and missing days per branch, with the observed date range."""
    seen = F.col("daily_withdrawals").isNotNull()
    return (
        grid.groupBy(BRANCH)
        .agg(
            F.count(F.lit(1)).alias("expected_days"),
            F.count_if(seen).alias("observed_days"),
            F.min(F.when(seen, F.col(DATE))).alias("first_day"),
            F.max(F.when(seen, F.col(DATE))).alias("last_day"),
        )
        .withColumn("missing_days", F.col("expected_days") - F.col("observed_days"))
        .withColumn("coverage_pct", F.bround(F.col("observed_days") / F.col("expected_days") * 100, 2))
    )


def missing_combinations(grid: DataFrame) -> DataFrame:
    """Grid cells without an observation."""
    return grid.where(F.col("daily_withdrawals").isNull()).select(BRANCH, F.col(DATE).alias("missing_date"))


def missing_breakdown(grid: DataFrame) -> DataFrame:
    """(slice, value, missing) by branch, day type and month in one pass over the missing cells."""
    missing = missing_combinations(grid)
    day = F.col("missing_date")
    cell = lambda name, value: F.struct(F.lit(name).alias("slice"), value.cast("string").alias("value"))
    slices = F.array(
        cell("branch", F.col(BRANCH)),
        cell("day_type", F.when(F.weekday(day) >= 5, "weekend").otherwise("weekday")),
        cell("month", F.date_format(day, "yyyy-MM")),
    )
    return missing.select(F.inline(slices)).groupBy("slice", "value").agg(F.count(F.lit(1)).alias("missing"))


def sets_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: whether both frames hold the same distinct keys (same column names)."""
    keys = a.columns
    sides = a.distinct().withColumn("_side", F.lit(1)).unionByName(b.distinct().withColumn("_side", F.lit(2)))
    return (
        sides.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.every(F.col("_n") == 2), F.lit(True)).alias("equal"))
    )


def train_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Single row of training medians, 0 where a column has no training value."""
    found = medians(df.where(F.col("split") == "train"), columns)
    return found.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in columns])


def impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Nulls replaced by the given value per column."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in medians.items()})


def impute_with_train_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls of all splits replaced by the medians of the training split.

    Fitting brings one number per column to the driver, as an ``Imputer`` does.
    """
    return impute(df, train_medians(df, columns).first().asDict())


def expanding_folds(df: DataFrame, date: str = DATE, folds: int = 5, min_train: int = 180) -> DataFrame:
    """(fold, train_end, val_start, val_end): expanding windows over the sorted unique dates.

    The dates of a panel are bounded by the calendar, so ranking them in one window is small.
    """
    days = df.select(date).distinct().select(date, (F.row_number().over(Window.orderBy(date)) - 1).alias("i"))
    n = days.agg(F.count(F.lit(1))).scalar()
    size = F.greatest(F.lit(30), F.floor((n - min_train) / folds))
    fold = days.select(date, "i", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold"), size.alias("size"), n.alias("n"))
    start = F.lit(min_train) + F.col("fold") * F.col("size")
    end = F.least(start + F.col("size"), F.col("n"))
    bounds = fold.withColumns({"start": start, "end": end}).where(F.col("start") < F.col("end"))
    at = lambda i: F.max(F.when(F.col("i") == i, F.col(date)))
    return bounds.groupBy((F.col("fold") + 1).alias("fold")).agg(
        at(F.col("start") - 1).alias("train_end"),
        at(F.col("start")).alias("val_start"),
        at(F.col("end") - 1).alias("val_end"),
    )
