"""Integrity reports and audits as rows (check, ok, detail)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.operators.metrics import weekday_frame
from harborline.operators.panel import BRANCH, CURRENT_DAY, DATE, LAGS, sets_equal


def check_rows(facts: DataFrame, checks: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Turn one row of facts into a row per check."""
    cells = [
        F.struct(F.lit(name).alias("check"), F.coalesce(ok, F.lit(False)).alias("ok"), detail.cast("string").alias("detail"))
        for name, (ok, detail) in checks.items()
    ]
    return facts.select(F.inline(F.array(*cells)))


def _keys_in(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split).select(BRANCH)


def integrity_report(features: DataFrame, predictors: Sequence[str]) -> DataFrame:
    """Feature order, leakage, branch sets, chronology, nonnegative requirement and weekday coverage."""
    leaked = [c for c in CURRENT_DAY if c in predictors]
    at = lambda s: F.col("split") == s
    facts = features.agg(
        F.max(F.when(at("train"), F.col(DATE))).alias("t_max"),
        F.min(F.when(at("val"), F.col(DATE))).alias("v_min"),
        F.max(F.when(at("val"), F.col(DATE))).alias("v_max"),
        F.min(F.when(at("test"), F.col(DATE))).alias("e_min"),
        F.count_if(F.col("cash_requirement") < -0.01).alias("negative"),
        F.countDistinct(F.when(at("test"), F.weekday(DATE))).alias("weekdays"),
    ).withColumns(
        {
            "same_val": sets_equal(_keys_in(features, "train"), _keys_in(features, "val")).scalar(),
            "same_test": sets_equal(_keys_in(features, "train"), _keys_in(features, "test")).scalar(),
        }
    )
    order = [c for c in features.columns if c in predictors] == list(predictors)
    col = F.col
    return check_rows(
        facts,
        {
            "feature_order_consistent": (F.lit(order), F.lit(len(predictors))),
            "no_target_leakage": (F.lit(not leaked), F.lit(",".join(leaked))),
            "branch_encoding_consistent": (col("same_val") & col("same_test"), F.lit("")),
            "chronological_splits": ((col("t_max") < col("v_min")) & (col("v_max") < col("e_min")), F.concat_ws(" ", "t_max", "v_min", "v_max", "e_min")),
            "nonnegative_cash_requirement": (col("negative") == 0, col("negative")),
            "weekday_coverage": (col("weekdays") == 7, col("weekdays")),
        },
    )


def stage_assertions(raw: DataFrame, daily: DataFrame, grid: DataFrame, lagged: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Conserved totals, unique keys, complete grid, lags equal to the value that many days back, gaps left null.

    ``raw`` has tran_br_code, start_date, wd and dep; ``lagged`` holds the grid with lag columns.
    """
    r = raw.agg(F.sum("wd").alias("raw_wd"), F.sum("dep").alias("raw_dep"))
    d = daily.agg(F.sum("daily_withdrawals").alias("day_wd"), F.sum("daily_deposits").alias("day_dep"), F.count(F.lit(1)).alias("day_rows"))
    keys = daily.select(BRANCH, DATE).distinct().agg(F.count(F.lit(1)).alias("day_keys"))
    g = grid.agg(
        F.count(F.lit(1)).alias("cells"),
        F.count("daily_withdrawals").alias("seen"),
        F.countDistinct(BRANCH).alias("branches"),
        (F.datediff(F.max(DATE), F.min(DATE)) + 1).alias("days"),
    )
    facts = r.withColumns(
        {
            **{c: d.select(c).scalar() for c in d.columns},
            "day_keys": keys.scalar(),
            **{c: g.select(c).scalar() for c in g.columns},
            "day_seen": daily.agg(F.count("daily_withdrawals")).scalar(),
        }
    )
    wrong = None
    for k in lags:
        back = grid.select(BRANCH, F.date_add(DATE, k).alias(DATE), F.col("daily_withdrawals").alias("_then"))
        differs = lagged.join(back, [BRANCH, DATE], "left").where(~F.col(f"daily_withdrawals_{k}p_lag").eqNullSafe(F.col("_then")))
        count = differs.agg(F.count(F.lit(1))).scalar()
        wrong = count if wrong is None else wrong + count
    facts = facts.withColumn("wrong_lags", wrong)
    col = F.col
    cents = lambda total: F.round(total * 100).cast("long")
    near = lambda a, b: F.abs(a - b) < 0.01 * F.greatest(F.col("day_rows"), F.lit(1))
    return check_rows(
        facts,
        {
            "withdrawals_conserved": (near(col("raw_wd"), col("day_wd")), cents(col("day_wd"))),
            "deposits_conserved": (near(col("raw_dep"), col("day_dep")), cents(col("day_dep"))),
            "unique_branch_days": (col("day_rows") == col("day_keys"), col("day_rows")),
            "grid_complete": (col("cells") == col("branches") * col("days"), col("cells")),
            "lags_exact": (col("wrong_lags") == 0, col("wrong_lags")),
            "gaps_stay_null": (col("seen") == col("day_seen"), col("cells") - col("seen")),
        },
    )


def output_verification(features: DataFrame, max_missing_pct: float = 30.0, min_rows: int = 1000) -> DataFrame:
    """Row count, share of missing values and non-empty splits."""
    cells = len(features.columns)
    missing = sum((F.count_if(F.col(c).isNull()) for c in features.columns), F.lit(0))
    facts = features.agg(
        F.count(F.lit(1)).alias("rows"), missing.alias("missing"), *[F.count_if(F.col("split") == s).alias(s) for s in ("train", "val", "test")]
    ).withColumn("pct", F.bround(F.col("missing") / F.nullif(F.col("rows") * cells, F.lit(0)) * 100, 2))
    col = F.col
    return check_rows(
        facts,
        {
            "missing_within_limit": (col("pct") <= max_missing_pct, col("missing")),
            "enough_rows": (col("rows") >= min_rows, col("rows")),
            "splits_not_empty": ((col("train") > 0) & (col("val") > 0) & (col("test") > 0), F.concat_ws("/", "train", "val", "test")),
        },
    )


def readiness_audit(test: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per weekday: rows, valid pairs and missing actuals, and whether the counts add up."""
    valid = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    per_day = test.groupBy(F.weekday(DATE).alias("dayofweek")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(valid).alias("valid"),
        F.count_if(F.col(actual).isNull()).alias("missing_actual"),
        F.count_if(F.col(actual).isNotNull() & F.col(predicted).isNull()).alias("missing_prediction"),
    )
    counts = ("rows", "valid", "missing_actual", "missing_prediction")
    return (
        weekday_frame(test)
        .join(per_day, "dayofweek", "left")
        .fillna(0, subset=list(counts))
        .withColumn("reconciles", F.col("rows") == F.col("valid") + F.col("missing_actual") + F.col("missing_prediction"))
        .drop("dayofweek")
    )
