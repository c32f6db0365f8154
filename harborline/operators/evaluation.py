"""Fitted models against baselines, strategies against each other, and forecasts against what came."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.operators.metrics import flow_metrics, improvement_pct
from harborline.operators.panel import BRANCH, DATE


def _named(**columns: Column) -> Column:
    return F.inline(F.array(*[F.struct(F.lit(name).alias("name"), column.alias("p")) for name, column in columns.items()]))


def against_baseline(df: DataFrame, actual: str, prediction: str, baseline: str) -> DataFrame:
    """Metrics of ``model`` and ``baseline`` on the rows that have a value and both predictions.

    ``improvement_pct`` is how much lower the error is than the baseline's, 0 for the baseline itself.
    """
    rows = df.where(F.col(actual).isNotNull() & F.col(prediction).isNotNull() & F.col(baseline).isNotNull())
    long = rows.select(F.col(actual).alias("y"), _named(model=F.col(prediction), baseline=F.col(baseline)))
    found = flow_metrics(long, "y", "p", ["name"], shortfalls=True)
    base = found.agg(F.max(F.when(F.col("name") == "baseline", F.col("mae")))).scalar()
    return found.withColumn("improvement_pct", improvement_pct(base, F.col("mae")))


def direct_vs_derived(df: DataFrame, pattern: str = "p_{}") -> DataFrame:
    """(target, strategy, metrics, best): net cash and requirement predicted directly, or derived from both flows.

    ``pattern`` names the prediction of each of the four measures. A requirement is never negative.
    ``best`` marks the lower error of a target, the first strategy on a tie.
    """
    p = lambda name: F.col(pattern.format(name))
    gap = p("daily_withdrawals") - p("daily_deposits")
    zero = F.lit(0.0)
    cell = lambda target, strategy, found: F.struct(
        F.lit(target).alias("target"), F.lit(strategy).alias("strategy"), F.col(target).alias("y"), found.alias("p")
    )
    cells = F.array(
        cell("net_cash", "direct", p("net_cash")),
        cell("net_cash", "derived", -gap),
        cell("cash_requirement", "direct", F.when(p("cash_requirement").isNotNull(), F.greatest(p("cash_requirement"), zero))),
        cell("cash_requirement", "derived", F.when(gap.isNotNull(), F.greatest(gap, zero))),
    )
    found = flow_metrics(df.select(F.inline(cells)), "y", "p", ["target", "strategy"], shortfalls=True)
    first = F.row_number().over(Window.partitionBy("target").orderBy(F.asc_nulls_last("mae"), "strategy")) == 1  # of two rows
    return found.withColumn("best", first)


def forecast_validate(
    made: DataFrame, history: DataFrame, baseline: str, actual: str = "daily_withdrawals", prediction: str = "predicted_withdrawals", keys: Sequence[str] = (BRANCH, DATE)
) -> DataFrame:
    """Metrics of a forecast and of a baseline over the days that came, with the number of negative amounts forecast.

    ``made`` is what ``recursive_forecast`` gives; a negative requirement would be an error, negative net cash is a deficit.
    """
    branch, date = keys
    came = history.select(F.col(branch).alias("branch_code"), F.col(date).alias("forecast_date"), F.col(actual).alias("y"), F.col(baseline).alias("_base"))
    scored = made.join(came, ["branch_code", "forecast_date"]).where(F.col("y").isNotNull() & F.col("_base").isNotNull())
    found = flow_metrics(scored.select("y", _named(model=F.col(prediction), baseline=F.col("_base"))), "y", "p", ["name"], shortfalls=True)
    signs = made.agg(
        F.count_if(F.col("predicted_cash_requirement") < 0).alias("requirement"), F.count_if(F.col("predicted_net_cash") < 0).alias("net")
    )
    return found.withColumns({"negative_cash_requirement": signs.select("requirement").scalar(), "negative_net_cash": signs.select("net").scalar()})
