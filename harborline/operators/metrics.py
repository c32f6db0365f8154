"""Forecast error metrics, classification metrics and their slices: one aggregate each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.operators.windows import running_total, value_slots

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _pairs(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Error columns, null unless both sides are present."""
    both = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    error = F.when(both, F.col(actual) - F.col(predicted))
    return df.withColumns({"_error": error, "_actual": F.when(both, F.col(actual))})


def flow_metric_columns() -> list[Column]:
    error, actual = F.col("_error"), F.col("_actual")
    return [
        F.bround(F.avg(F.abs(error)), 2).alias("mae"),
        F.bround(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
        F.bround(F.sum(F.abs(error)) / F.nullif(F.sum(F.abs(actual)), F.lit(0.0)), 4).alias("wape"),
        F.bround(F.avg(F.when(error > 0, 1.0).when(error.isNotNull(), 0.0)), 4).alias("underforecasting_rate"),
        F.count(error).alias("num_comparisons"),
    ]


def shortfall_columns() -> list[Column]:
    short = F.greatest(F.col("_error"), F.when(F.col("_error").isNotNull(), F.lit(0.0)))
    return [
        F.bround(F.max(short), 2).alias("max_shortfall"),
        F.bround(F.sum(short), 2).alias("total_shortfall"),
    ]


def flow_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = (), shortfalls: bool = False
) -> DataFrame:
    """MAE, RMSE, WAPE, underforecasting rate and count over pairs with both sides present."""
    columns = flow_metric_columns() + (shortfall_columns() if shortfalls else [])
    return _pairs(df, actual, predicted).groupBy(*by).agg(*columns)


def slice_counts(df: DataFrame, actual: str, predicted: str, by: Sequence[str]) -> DataFrame:
    """Metrics and shortfalls per slice, with the number of rows of the slice."""
    return (
        _pairs(df, actual, predicted)
        .groupBy(*by)
        .agg(*flow_metric_columns(), *shortfall_columns(), F.count(F.lit(1)).alias("count"))
    )


def weekday_frame(df: DataFrame) -> DataFrame:
    """The seven weekdays as (dayofweek, weekday), Monday = 0."""
    days = F.array(*[F.struct(F.lit(i).alias("dayofweek"), F.lit(d).alias("weekday")) for i, d in enumerate(WEEKDAYS)])
    return df.sparkSession.range(1).select(F.inline(days))


def metrics_by_weekday(df: DataFrame, actual: str, predicted: str, dayofweek: str = "dayofweek") -> DataFrame:
    """Metrics per weekday; a weekday without rows is reported with count 0."""
    found = slice_counts(df.withColumnRenamed(dayofweek, "dayofweek"), actual, predicted, ["dayofweek"])
    return (
        weekday_frame(df)
        .join(found, "dayofweek", "left")
        .withColumn("count", F.coalesce("count", F.lit(0)))
        .drop("dayofweek")
    )


def metrics_by_deficit(df: DataFrame, actual: str, predicted: str, requirement: str = "cash_requirement") -> DataFrame:
    """Metrics for days with and without a cash requirement; unknown counts as none."""
    label = F.when(F.coalesce(F.col(requirement) > 0, F.lit(False)), "deficit_days").otherwise("non_deficit_days")
    return slice_counts(df.withColumn("slice", label), actual, predicted, ["slice"])


def long_predictions(df: DataFrame, targets: Sequence[str], names: Sequence[str], pattern: str, keep=()) -> DataFrame:
    """One row per (row, target, name): (keep..., target, name, actual, predicted).

    ``pattern`` turns target and name into the prediction's column, such as ``{target}_{name}``.
    """
    cells = [
        F.struct(
            F.lit(t).alias("target"),
            F.lit(n).alias("name"),
            F.col(t).alias("actual"),
            F.col(pattern.format(target=t, name=n)).alias("predicted"),
        )
        for t in targets
        for n in names
    ]
    return df.select(*keep, F.inline(F.array(*cells)))


def best_by(df: DataFrame, by: Sequence[str], name: str, score: str) -> DataFrame:
    """Per group the name with the lowest score, the first name on a tie."""
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*by)
        .agg(F.min(F.struct(score, name)).alias("_best"))
        .select(*by, F.col(f"_best.{name}").alias(name), F.col(f"_best.{score}").alias(score))
    )


def improvement_pct(base: Column, model: Column) -> Column:
    """(base - model) / base in percent, 0 where the base is not positive."""
    return F.when(base > 0, (base - model) / base * 100).otherwise(F.lit(0.0))


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE and R2."""
    error = F.col(actual) - F.col(predicted)
    return (
        df.groupBy(*by)
        .agg(
            F.avg(error * error).alias("mse"),
            F.sum(error * error).alias("_sse"),
            (F.var_pop(actual) * F.count(actual)).alias("_sst"),
        )
        .select(*by, "mse", F.sqrt("mse").alias("rmse"), (1 - F.col("_sse") / F.nullif("_sst", F.lit(0.0))).alias("r2"))
    )


def classification_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, and precision, recall, F1 and support of the positive class (label 1)."""
    cell = lambda a, p: F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).cast("double")
    zero = lambda top, bottom: F.coalesce(top / F.nullif(bottom, F.lit(0.0)), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("_tp", "_fp", "_fn", "_tn"))
    return (
        df.groupBy(*by)
        .agg(cell(1, 1).alias("_tp"), cell(0, 1).alias("_fp"), cell(1, 0).alias("_fn"), cell(0, 0).alias("_tn"))
        .select(
            *by,
            zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
            zero(tp, tp + fp).alias("precision"),
            zero(tp, tp + fn).alias("recall"),
            zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
            (tp + fn).cast("long").alias("support"),
        )
    )


def per_class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support of every class."""
    pairs = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed"),
                         F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("claimed"),
                         F.lit(0).cast("long").alias("hit")),
            )
        )
    )
    ratio = lambda top, bottom: F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hit")])
    return sums.select(
        "class",
        ratio(F.col("hit"), F.col("claimed")).alias("precision"),
        ratio(F.col("hit"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hit"), F.col("claimed") + F.col("support")).alias("f1"),
        "support",
    )


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve as the share of ordered pairs, ties counting one half.

    Scores are counted per distinct value first; the running count of negatives below each
    value comes from the bucketed running total, so one model's scores spread over many tasks.
    """
    counts = (
        df.groupBy(*by, F.col(score).cast("double").alias("_score"))
        .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    )
    below = running_total(counts, by, ["_score"], value_slots(F.col("_score")), {"_neg_upto": "_neg"})
    pair = F.col("_pos") * (F.col("_neg_upto") - F.col("_neg") / 2)
    return (
        below.groupBy(*by)
        .agg(F.sum(pair).alias("_pairs"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
        .select(*by, (F.col("_pairs") / F.nullif(F.col("_p") * F.col("_n"), F.lit(0))).alias("auc"))
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str, classes: Sequence) -> DataFrame:
    """One row per actual class, one count column ``predicted_<class>`` per class."""
    return (
        df.groupBy(F.col(actual).alias("actual"))
        .agg(*[F.count_if(F.col(predicted) == F.lit(c)).alias(f"predicted_{c}") for c in classes])
    )


def union_named(frames: Mapping[str, DataFrame], column: str = "model") -> DataFrame:
    """Stack frames of one shape with the mapping's key as a column."""
    stacked = None
    for name, frame in frames.items():
        named = frame.withColumn(column, F.lit(name))
        stacked = named if stacked is None else stacked.unionByName(named)
    return stacked
