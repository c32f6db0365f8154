"""Recursive multi-day forecasts with one row of state per branch.

The state of a branch is its last 30 days as arrays, newest first. A forecast step reads its
features from those arrays, predicts, and puts the predictions in front, so a step is a narrow
projection: after the one aggregation that builds the state nothing is shuffled, and all
branches move together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions import labels
from harborline.functions.calendar import calendar_columns
from harborline.operators.panel import BRANCH, DATE, LAGS, ROLLING, TARGETS


def rolling_at_origin(df: DataFrame, origin: Column, targets: Sequence[str], windows: Sequence[int]) -> DataFrame:
    """Statistics of the known days before ``origin`` per branch; a single day has deviation 0."""
    recent = df.where((F.col(DATE) < origin) & (F.col(DATE) >= F.date_sub(origin, max(windows))))
    columns = []
    for t in targets:
        for size in windows:
            v = F.when(F.col(DATE) >= F.date_sub(origin, size), F.col(t))
            spread = F.when(F.count(v) > 0, F.coalesce(F.stddev_samp(v), F.lit(0.0)))
            name = f"{t}_{size}p_rolling"
            columns += [F.avg(v).alias(f"{name}_mean"), spread.alias(f"{name}_std"), F.min(v).alias(f"{name}_min"), F.max(v).alias(f"{name}_max")]
    return recent.groupBy(BRANCH).agg(*columns)


def branch_state(df: DataFrame, origin: dt.date, days: int = max(ROLLING), targets: Sequence[str] = TARGETS) -> DataFrame:
    """(branch, <target>_hist): values of the ``days`` days before ``origin``, newest first, null for gaps."""
    recent = df.where((F.col(DATE) < F.lit(origin)) & (F.col(DATE) >= F.date_sub(F.lit(origin), days)))
    ago = F.datediff(F.lit(origin), F.col(DATE))
    value = lambda t, k: F.max(F.when(ago == k, F.col(t)))
    return recent.groupBy(BRANCH).agg(
        *[F.array(*[value(t, k) for k in range(1, days + 1)]).alias(f"{t}_hist") for t in targets]
    )


def _spread(values: Column) -> Column:
    """Sample standard deviation of an array, 0 for one value, null for none."""
    n = F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / n
    squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    return F.when(n > 1, F.sqrt(squares / (n - 1))).when(n == 1, F.lit(0.0))


def state_features(targets: Sequence[str], lags: Sequence[int], windows: Sequence[int]) -> dict[str, Column]:
    """Lag and rolling columns read from the state arrays, named as in the feature table."""
    columns: dict[str, Column] = {}
    for t in targets:
        past = F.col(f"{t}_hist")
        for k in lags:
            columns[f"{t}_{k}p_lag"] = F.get(past, F.lit(k - 1))
        for size in windows:
            known = F.filter(F.slice(past, 1, size), lambda x: x.isNotNull())
            n = F.size(known)
            name = f"{t}_{size}p_rolling"
            columns[f"{name}_mean"] = F.when(n > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / n)
            columns[f"{name}_std"] = _spread(known)
            columns[f"{name}_min"] = F.array_min(known)
            columns[f"{name}_max"] = F.array_max(known)
    return columns


def recursive_forecast(
    history: DataFrame,
    origin: dt.date,
    days: int,
    predict: Mapping[str, Callable[[DataFrame], DataFrame]],
    medians: Mapping[str, float],
    salary_days: Sequence[int] = (),
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = ROLLING,
) -> DataFrame:
    """Forecast ``days`` days from ``origin`` for every branch with history.

    ``predict`` maps each target to a function adding the column ``prediction`` to a frame with
    the feature columns; ``medians`` fills features that the history cannot give. Each day's state stands
    behind a generator, so a day reads the values of the day before and the plan grows by one step a day.
    """
    targets = list(predict)
    state = branch_state(history, origin, max(max(windows), max(lags)), targets).withColumn(
        "made", F.array().cast("array<struct<forecast_date:date,predicted_withdrawals:double,predicted_deposits:double,explanation:string>>")
    )
    features = state_features(targets, lags, windows)
    filled = lambda name, column: F.coalesce(column.cast("double"), F.lit(float(medians[name]))) if name in medians else column
    inputs = {name: filled(name, column) for name, column in features.items()}
    inputs |= {f"_mean_{t}": features[f"{t}_{windows[0]}p_rolling_mean"] for t in targets}
    for step in range(days):
        day = F.lit(origin + dt.timedelta(days=step))
        frame = state.withColumns({**calendar_columns(day), **inputs})
        for t in targets:
            frame = predict[t](frame).withColumnRenamed("prediction", f"_pred_{t}")
        wd, dep = F.col("_pred_daily_withdrawals"), F.col("_pred_daily_deposits")
        text = labels.forecast_explanation(
            F.dayofmonth(day).isin(*salary_days) if salary_days else F.lit(False),
            F.dayofmonth(day) == 1,
            day == F.last_day(day),
            F.weekday(day),
            wd,
            dep,
            F.col("_mean_daily_withdrawals"),
            F.col("_mean_daily_deposits"),
        )
        record = F.struct(
            day.alias("forecast_date"), wd.alias("predicted_withdrawals"), dep.alias("predicted_deposits"), text.alias("explanation")
        )
        keep = max(max(windows), max(lags))
        # one row from a generator: the next day reads this day's values, not their expressions
        after = F.struct(
            *[F.slice(F.concat(F.array(f"_pred_{t}"), f"{t}_hist"), 1, keep).alias(f"{t}_hist") for t in targets],
            F.concat("made", F.array(record)).alias("made"),
        )
        state = frame.select(BRANCH, F.inline(F.array(after)))
    wd, dep = F.col("predicted_withdrawals"), F.col("predicted_deposits")
    return state.select(F.col(BRANCH).alias("branch_code"), F.inline("made")).select(
        "branch_code",
        "forecast_date",
        "predicted_deposits",
        "predicted_withdrawals",
        (dep - wd).alias("predicted_net_cash"),
        F.greatest(wd - dep, F.lit(0.0)).alias("predicted_cash_requirement"),
        labels.status_label(wd, dep).alias("status"),
        "explanation",
    )
