"""Cash guidance: branch summaries, events, allocation, replenishment and redistribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.operators.quantiles import quantile_columns

# Recommendation texts.
PREPARE = "Monitor closely and prepare for potential replenishment"
REALLOCATE = "Consider reallocating excess cash to branches with shortage"
MAINTAIN = "Maintain current cash levels"
STATUSES = ("Balanced", "Shortage", "Surplus")


def guidance_by_branch(forecast: DataFrame) -> DataFrame:
    """Totals, days per status, modal status (first name on a tie) and a recommendation per branch."""
    days = {s: f"{s.lower()}_days" for s in STATUSES}
    need, net = F.col("total_predicted_cash_requirement"), F.col("total_predicted_net_cash")
    most = F.greatest(*[F.col(c) for c in days.values()])
    mode = F.when(F.col("balanced_days") == most, "Balanced").when(F.col("shortage_days") == most, "Shortage").otherwise("Surplus")
    return (
        forecast.groupBy("branch_code")
        .agg(
            F.count(F.lit(1)).alias("forecast_days"),
            F.round(F.sum("predicted_deposits"), 2).alias("total_predicted_inflow"),
            F.round(F.sum("predicted_withdrawals"), 2).alias("total_predicted_outflow"),
            F.round(F.sum("predicted_net_cash"), 2).alias("total_predicted_net_cash"),
            F.round(F.sum("predicted_cash_requirement"), 2).alias("total_predicted_cash_requirement"),
            F.avg("predicted_deposits").alias("_mean_deposits"),
            *[F.count_if(F.col("status") == s).alias(c) for s, c in days.items()],
        )
        .withColumn("primary_status", mode)
        .withColumn(
            "recommendation",
            F.when(need > 0, PREPARE).when(net > F.col("_mean_deposits") * 0.2, REALLOCATE).otherwise(MAINTAIN),
        )
        .drop("_mean_deposits")
    )


def forecast_kpis(forecast: DataFrame) -> DataFrame:
    total = lambda c: F.round(F.sum(c), 2)
    pct = lambda s: F.round(F.avg(F.when(F.col("status") == s, 100.0).otherwise(0.0)), 4)
    return forecast.agg(
        total("predicted_deposits").alias("total_inflow"),
        total("predicted_withdrawals").alias("total_outflow"),
        total("predicted_net_cash").alias("total_net"),
        total("predicted_cash_requirement").alias("total_requirement"),
        F.count(F.lit(1)).alias("rows"),
        *[pct(s).alias(f"{s.lower()}_pct") for s in STATUSES],
    )


def require_coverage(calendar: DataFrame, date: str, first, last) -> DataFrame:
    """The calendar, or an error when a day of [first, last] is missing from it."""
    wanted = (last - first).days + 1
    inside = calendar.where(F.col(date).between(F.lit(first), F.lit(last)))
    found = inside.agg(F.countDistinct(date)).first()[0]
    if found < wanted:
        raise ValueError(f"event calendar covers {found} of {wanted} days between {first} and {last}")
    return calendar


def event_flags(days: DataFrame, date: str, calendar: DataFrame, salary_days: Sequence[int]) -> DataFrame:
    """Holiday flag and name from an event calendar (unique by date), and salary-cycle flags."""
    day = F.dayofmonth(date)
    near = F.lit(False)
    for d in salary_days:
        near = near | day.between(d - 1, d + 1)
    return (
        days.join(calendar.withColumnRenamed("event_date", date), date, "left")
        .withColumn("is_holiday", F.col("event_name").isNotNull().cast("int"))
        .withColumn("is_salary_day", day.isin(*salary_days).cast("int"))
        .withColumn("is_salary_window", near.cast("int"))
    )


def spike_flag(grid: DataFrame, by: Sequence[str], date: str, source: str, size: int = 30, width: float = 2.0) -> DataFrame:
    """1 where the value exceeds mean + width x standard deviation of the preceding days."""
    w = Window.partitionBy(*by).orderBy(date).rowsBetween(-size, -1)
    limit = F.avg(source).over(w) + width * F.stddev_samp(source).over(w)
    return grid.withColumn("spike_limit", limit).withColumn(
        "is_spike", F.coalesce(F.col(source) > F.col("spike_limit"), F.lit(False)).cast("int")
    )


def morning_shares(history: DataFrame, by: Sequence[str], hour: str, amount: str) -> DataFrame:
    """Share of the amount before noon per group, one half where the group has no amount."""
    total = F.sum(amount)
    return history.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col(hour) < 12, F.col(amount)).otherwise(0.0)) / F.nullif(total, F.lit(0.0)), F.lit(0.5)).alias("am_share")
    )


def allocate_half_days(daily: DataFrame, shares: DataFrame, by: Sequence[str], amount: str) -> DataFrame:
    """AM and PM amounts; PM is the remainder, so both add up to the day exactly."""
    am = F.round(F.col(amount) * F.coalesce("am_share", F.lit(0.5)), 2)
    return (
        daily.join(shares, list(by), "left")
        .withColumn("am", am)
        .withColumn("pm", F.round(F.col(amount) - F.col("am"), 2))
    )


def residual_bounds(residuals: DataFrame, residual: str, low: float, high: float, by: Sequence[str] = ()) -> DataFrame:
    """(by..., low, high) quantiles of past residuals."""
    return quantile_columns(residuals, [residual], {"low": low, "high": high}, by).drop("column")


def prediction_interval(predicted: DataFrame, bounds: DataFrame, prediction: str, by: Sequence[str]) -> DataFrame:
    """Nonnegative lower and upper bound around each prediction."""
    floor = lambda c: F.greatest(c, F.lit(0.0))
    return predicted.join(bounds, list(by)).withColumns(
        {"lower": floor(F.col(prediction) + F.col("low")), "upper": floor(F.col(prediction) + F.col("high"))}
    ).drop("low", "high")


def replenishment(needs: DataFrame, operations: DataFrame, by: Sequence[str]) -> DataFrame:
    """Order per branch: fill opening cash up to upper demand plus reserve, within vault capacity.

    ``operations`` holds opening_cash, minimum_reserve, vault_capacity, lead_days and order_cost.
    """
    gap = F.col("upper_demand") * F.col("lead_days") + F.col("minimum_reserve") - F.col("opening_cash")
    room = F.greatest(F.col("vault_capacity") - F.col("opening_cash"), F.lit(0.0))
    order = F.round(F.greatest(F.least(gap, room), F.lit(0.0)), 2)
    return (
        needs.join(operations, list(by))
        .withColumn("order_amount", order)
        .withColumn("uncovered", F.round(F.greatest(gap - room, F.lit(0.0)), 2))
        .withColumn("cost", F.when(F.col("order_amount") > 0, F.col("order_cost")).otherwise(0.0))
    )


def risk_branches(per_branch: DataFrame, high: Column, idle: Column, short: Column) -> DataFrame:
    """Three flags per branch and their number."""
    flags = {"high_withdrawal": high, "idle_cash": idle, "shortage_risk": short}
    df = per_branch.withColumns({n: F.coalesce(c, F.lit(False)).cast("int") for n, c in flags.items()})
    return df.withColumn("risks", sum((F.col(n) for n in flags), F.lit(0)))


def redistribute(balances: DataFrame, by: Sequence[str], branch: str, amount: str) -> DataFrame:
    """Transfers from surplus to shortage branches, per group (such as a day).

    Surpluses and shortages are laid end to end as intervals in branch order; the overlap of a
    surplus interval with a shortage interval is a transfer. The overlaps follow from one sort of
    all interval ends: each piece between two ends belongs to the next surplus and the next
    shortage to end. No pair of branches is compared. A group holds one row per branch.
    """
    sides = balances.where(F.col(amount) != 0).select(
        *by, branch, F.when(F.col(amount) > 0, "from").otherwise("to").alias("side"), F.abs(amount).alias("size")
    )
    along = Window.partitionBy(*by, "side").orderBy(branch).rowsBetween(Window.unboundedPreceding, 0)
    ends = sides.withColumn("until", F.round(F.sum("size").over(along), 2))
    ordered = Window.partitionBy(*by).orderBy("until", "side", branch)
    ahead = ordered.rowsBetween(0, Window.unboundedFollowing)
    following = lambda side: F.first(F.when(F.col("side") == side, F.col(branch)), ignorenulls=True).over(ahead)
    pieces = ends.withColumns(
        {
            "from_branch": following("from"),
            "to_branch": following("to"),
            "start": F.coalesce(F.lag("until").over(ordered), F.lit(0.0)),
        }
    )
    return pieces.where(
        F.col("from_branch").isNotNull() & F.col("to_branch").isNotNull() & (F.col("until") > F.col("start"))
    ).select(*by, "from_branch", "to_branch", F.round(F.col("until") - F.col("start"), 2).alias("transfer"))


def seasonal_decompose(daily: DataFrame, date: str, value: str) -> DataFrame:
    """Centred seven-day trend, weekday effect (adding up to zero) and residual of one daily series.

    The series has at most one row per day; a day with a gap within three days of it has no trend.
    The series is cut by month, each month taking three days from its neighbours, so that no task
    orders the whole calendar.
    """
    month = lambda d: F.date_trunc("month", d)
    near = F.array_distinct(F.transform(F.array(*[F.lit(k) for k in (-3, 0, 3)]), lambda k: month(F.date_add(F.col(date), k))))
    spread = daily.select("*", F.explode(near).alias("_month"))
    w = Window.partitionBy("_month").orderBy(F.unix_date(F.col(date))).rangeBetween(-3, 3)
    centred = (
        spread.withColumn("trend", F.when(F.count(value).over(w) == 7, F.avg(value).over(w)))
        .where(F.col("_month") == month(F.col(date)))
        .drop("_month")
        .withColumn("_dow", F.weekday(date))
    )
    effect = centred.groupBy("_dow").agg(F.avg(F.col(value) - F.col("trend")).alias("_effect"))
    level = effect.agg(F.avg("_effect")).scalar()
    return (
        centred.join(effect, "_dow")
        .withColumn("seasonal", F.col("_effect") - level)
        .withColumn("residual", F.col(value) - F.col("trend") - F.col("seasonal"))
        .drop("_dow", "_effect")
    )
