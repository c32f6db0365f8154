"""Whole jobs: clean a table, build the feature store, compare models, forecast, index and ask.

Every job reads files and writes tables; what comes back is paths and small reports.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.operators import aggregates, cash, checks, cleaning, evaluation, forecasting, gram, metrics, panel, profiling, regression, retrieval
from harborline.operators.columns import columns_by_type
from harborline.session import cut
from harborline.sources import readers, writers
from harborline.sources.store import Store

TRANSACTIONS = "tran_br_code string, start_date string, txn_hour string, TOTAL_DR string, TOTAL_CR string"


def clean_table(df: DataFrame) -> DataFrame:
    """Dates parsed, gaps filled, rows without branch or date dropped, duplicates dropped, outliers capped.

    Cash columns get 0 for a gap, other numbers their median, text 'Unknown'; columns named like a
    balance do not go below 0.
    """
    kinds = dict(df.dtypes)
    dates = [c for c in cleaning.date_columns(df) if kinds[c] == "string"]
    df = df.withColumns({c: F.to_date(cleaning.coerce_date(F.col(c))) for c in dates})
    groups = columns_by_type(df)
    cash_names = cleaning.cash_columns(df)
    critical = [c for c in df.columns if "branch" in c.lower() or "br_code" in c.lower() or "date" in c.lower()]
    others = [c for c in groups["numeric"] if c not in cash_names and c not in critical]
    df = df.fillna(0, subset=cash_names).fillna("Unknown", subset=[c for c in groups["categorical"] if c not in critical])
    if others:
        df = cleaning.fill_median(df, others)
    df = df.dropna(subset=critical).dropDuplicates()
    outliers = cleaning.cash_columns(df, cleaning.OUTLIER_WORDS)
    if outliers:
        df = cleaning.iqr_clip(df, outliers).drop(*[f"{c}_capped" for c in outliers])
    balances = [c for c in groups["numeric"] if "balance" in c.lower()]
    return df.withColumns({c: cleaning.clip_nonnegative(F.col(c)) for c in balances})


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Hourly rows from CSV: numbers and dates coerced, rows without branch or date dropped."""
    raw = readers.require_columns(readers.read_csv(spark, path, TRANSACTIONS), ["tran_br_code", "start_date", "txn_hour", "TOTAL_DR", "TOTAL_CR"])
    return raw.select(
        cleaning.coerce_number(F.col("tran_br_code"), "int").alias("tran_br_code"),
        F.to_date(cleaning.coerce_date(F.col("start_date"))).alias("start_date"),
        cleaning.coerce_number(F.col("txn_hour"), "int").alias("txn_hour"),
        cleaning.coerce_number(F.col("TOTAL_DR")).alias("TOTAL_DR"),
        cleaning.coerce_number(F.col("TOTAL_CR")).alias("TOTAL_CR"),
    ).dropna(subset=["tran_br_code", "start_date"])


def build_feature_store(
    spark: SparkSession,
    transactions: DataFrame,
    target: str,
    validation_from: dt.date,
    test_from: dt.date,
    retain_through: dt.date | None = None,
    week: int = 7,
) -> dict[str, str]:
    """Hourly rows to the split feature table and its reports, below ``target``.

    The transactions are scanned once for the daily table; everything after it starts from the
    daily table or from the written features.
    """
    daily = cut(aggregates.daily_totals(transactions))
    features = panel.panel_features(daily, week)
    if retain_through is not None:
        features = features.where(F.col(panel.DATE) <= F.lit(retain_through))
    paths = {n: f"{target}/{n}" for n in ("features", "coverage", "missing", "dictionary", "nulls", "baselines", "checks")}
    split = panel.chrono_split(features, F.lit(validation_from), F.lit(test_from))
    split.write.mode("overwrite").partitionBy("split").parquet(paths["features"])
    features = spark.read.parquet(paths["features"])
    grid = panel.complete_grid(daily)
    long = metrics.long_predictions(
        features.where("split = 'val'"), panel.TARGETS, ("prev_period_baseline", "prev_week_baseline", "roll7_avg_baseline"), "{target}_{name}"
    )
    predictors = panel.feature_columns(features.columns)
    report = checks.integrity_report(features, predictors).unionByName(checks.output_verification(features))
    writers.write_csv(panel.coverage_by_branch(grid), paths["coverage"])
    writers.write_csv(panel.missing_combinations(grid), paths["missing"])
    writers.write_json_report(profiling.feature_dictionary(features, ["tran_br_code", "start_date"]), paths["dictionary"])
    writers.write_json_report(profiling.null_profile(features), paths["nulls"])
    writers.write_json_report(metrics.flow_metrics(long, "actual", "predicted", ["target", "name"]), paths["baselines"])
    writers.write_json_report(report, paths["checks"])
    return paths


Fitter = Callable[[DataFrame, Sequence[str], str], regression.Fitted]

MODELS: dict[str, Fitter] = {
    "linear_regression": regression.linear_regression,
    "ridge": regression.ridge,
    "lasso": regression.lasso,
    "random_forest": regression.random_forest,
    "boosted_trees": regression.boosted_trees,
}


def prepare(features: DataFrame, predictors: Sequence[str]) -> tuple[DataFrame, dict[str, float]]:
    """Features imputed with training medians, and those medians.

    Every predictor has one, also where history is complete: a future day may be the first with a gap.
    """
    found = panel.train_medians(features, list(predictors)).first().asDict()
    medians = {c: v for c, v in found.items() if v is not None}
    return panel.impute(features, medians), medians


# Models that summed blocks solve: kind and penalty, as the functions above have them by default.
LINEAR = {"linear_regression": ("ridge", 0.0), "ridge": ("ridge", 1.0), "lasso": ("lasso", 0.1)}


def score_models(features: DataFrame, predictors: Sequence[str], models: Mapping[str, Fitter] = MODELS, folds: int = 5, min_train: int = 180) -> DataFrame:
    """(target, model, mean fold metrics, folds) over expanding folds of training and validation rows.

    All linear models, folds and targets take two scans together; other models are fitted one by one.
    """
    data, _ = prepare(features, predictors)
    known = cut(data.where("split <> 'test'"))
    bounds = panel.expanding_folds(known, folds=folds, min_train=min_train)
    linear = {n: LINEAR[n] for n, f in models.items() if n in LINEAR and f is MODELS[n]}
    others = {n: f for n, f in models.items() if n not in linear}
    scores = None
    if linear:
        scores = gram.expanding_cv(known, bounds, panel.DATE, panel.TARGETS, predictors, linear)
    if others:
        found = {}
        for target in panel.TARGETS:
            fits = {n: (lambda train, f=f, t=target: f(train, predictors, t)) for n, f in others.items()}
            found[target] = regression.expanding_cv(known, bounds, panel.DATE, target, fits)
        more = metrics.union_named(found, "target")
        scores = more if scores is None else scores.unionByName(more)
    return regression.mean_scores(scores, ["target"])


def select_models(features: DataFrame, predictors: Sequence[str], models: Mapping[str, Fitter] = MODELS, folds: int = 5, min_train: int = 180) -> DataFrame:
    """(target, model, mae): per target the model with the lowest mean error over expanding folds."""
    return metrics.best_by(score_models(features, predictors, models, folds, min_train), ["target"], "model", "mae")


SPACES: dict[str, dict[str, Sequence]] = {
    "ridge": {"alpha": [0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]},
    "lasso": {"alpha": [0.01, 0.1, 1.0, 10.0, 100.0]},
    "random_forest": {"trees": [100, 200, 300], "depth": [8, 10, 15], "leaf": [2, 5, 10]},
    "boosted_trees": {"rounds": [100, 200, 300], "depth": [3, 5, 7], "step": [0.05, 0.1]},
}


def tune_models(
    features: DataFrame, predictors: Sequence[str], shortlist: Mapping[str, Sequence[str]], spaces: Mapping[str, Mapping[str, Sequence]] = SPACES, n: int = 5, folds: int = 3, min_train: int = 180
) -> DataFrame:
    """(target, model, params, mae, rmse, wape, underforecasting_rate, folds) of ``n`` parameter sets drawn for each
    model on the short list of a target, best first. Penalties of linear models take two scans together."""
    data, _ = prepare(features, predictors)
    known = cut(data.where("split <> 'test'"))
    bounds = panel.expanding_folds(known, folds=folds, min_train=min_train)
    found = None
    for target, names in shortlist.items():
        for name in names:
            if name in LINEAR and set(spaces.get(name, {})) <= {"alpha"}:
                tried = {json.dumps(p, sort_keys=True): (LINEAR[name][0], float(p.get("alpha", LINEAR[name][1]))) for p in regression.sampled_grid(spaces.get(name, {}), n)}
                part = regression.mean_scores(gram.expanding_cv(known, bounds, panel.DATE, [target], predictors, tried)).withColumnRenamed("model", "params")
            else:
                part = regression.random_search(known, bounds, panel.DATE, predictors, target, MODELS[name], spaces.get(name, {}), n)
            part = part.select(F.lit(target).alias("target"), F.lit(name).alias("model"), "params", "mae", "rmse", "wape", "underforecasting_rate", "folds")
            found = part if found is None else found.unionByName(part)
    return found.orderBy("target", "mae", "model", "params")


def compare_strategies(features: DataFrame, predictors: Sequence[str], alpha: float = 1.0) -> DataFrame:
    """Net cash and requirement on the test rows: predicted directly, or derived from both flows. One scan fits all four."""
    data, _ = prepare(features, predictors)
    labels = ("daily_withdrawals", "daily_deposits", "net_cash", "cash_requirement")
    summed = gram.blocks(data.where("split <> 'test'"), predictors, labels)
    test = data.where("split = 'test'").withColumns({f"p_{y}": summed.ridge(y, alpha).weighted_sum() for y in labels})
    return evaluation.direct_vs_derived(test)


def save_reports(reports: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Every report as a JSON table below ``folder``; the paths by name."""
    paths = {name: f"{folder}/{name}" for name in reports}
    for name, report in reports.items():
        writers.write_json_report(report, paths[name])
    return paths


def test_models(features: DataFrame, predictors: Sequence[str], chosen: Mapping[str, str], baseline: str = "roll7_avg_baseline") -> DataFrame:
    """(target, name, metrics) on the test split of the chosen models, refitted, and of a baseline on the same rows."""
    data, _ = prepare(features, predictors)
    frames = {}
    for target, model in chosen.items():
        fitted = MODELS[model](data.where("split <> 'test'"), predictors, target)
        rows = fitted.predict(data.where("split = 'test'")).withColumnRenamed("prediction", f"{target}_model")
        rows = rows.where(F.col(f"{target}_{baseline}").isNotNull())
        long = metrics.long_predictions(rows, [target], ["model", baseline], "{target}_{name}")
        frames[target] = metrics.flow_metrics(long, "actual", "predicted", ["name"], shortfalls=True)
    return metrics.union_named(frames, "target")


def fit_models(features: DataFrame, predictors: Sequence[str], chosen: Mapping[str, str], origin: dt.date) -> tuple[dict[str, regression.Fitted], dict[str, float]]:
    """The chosen model per target, fitted on all rows before the origin, and the medians that fill gaps."""
    data, medians = prepare(features, predictors)
    history = data.where(F.col(panel.DATE) < F.lit(origin))
    return {t: MODELS[m](history, predictors, t) for t, m in chosen.items()}, medians


def save_models(spark: SparkSession, models: Mapping[str, regression.Fitted], medians: Mapping[str, float], folder: str) -> str:
    """Write fitted models with their feature lists, and the medians, below ``folder``."""
    for target, model in models.items():
        regression.save(model, f"{folder}/{target}")
    rows = [*((t, None) for t in models), *((c, float(v)) for c, v in medians.items())]
    spark.createDataFrame(rows, "name string, median double").coalesce(1).write.mode("overwrite").json(f"{folder}/index")
    return folder


def load_models(spark: SparkSession, folder: str) -> tuple[dict[str, regression.Fitted], dict[str, float]]:
    index = spark.read.schema("name string, median double").json(f"{folder}/index").collect()
    models = {r["name"]: regression.load(f"{folder}/{r['name']}") for r in index if r["median"] is None}
    return models, {r["name"]: r["median"] for r in index if r["median"] is not None}


def forecast_with(
    models: Mapping[str, regression.Fitted],
    medians: Mapping[str, float],
    features: DataFrame,
    origin: dt.date,
    days: int = 7,
    salary_days: Sequence[int] = (),
    branches: Sequence | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Forecasts and guidance from fitted models, for all branches or the requested ones.

    A requested branch without history, an origin after a gap of history, or no days are refused.
    """
    if days < 1:
        raise ValueError("at least one day must be forecast")
    if branches is not None:
        features = features.where(F.col(panel.BRANCH).isin(list(branches)))
        known = {r[0] for r in features.where(F.col(panel.DATE) < F.lit(origin)).select(panel.BRANCH).distinct().collect()}
        if missing := sorted(set(branches) - known):
            raise ValueError(f"no history before {origin} for branches {missing}")
    last = features.where(F.col(panel.DATE) < F.lit(origin)).agg(F.max(panel.DATE)).first()[0]
    if last is None or last != origin - dt.timedelta(days=1):
        raise ValueError(f"history ends on {last}, the forecast starts on {origin}")
    predict = {t: m.predict for t, m in models.items()}
    made = forecasting.recursive_forecast(features, origin, days, predict, dict(medians), salary_days)
    return made, cash.guidance_by_branch(made)


def forecast(features: DataFrame, predictors: Sequence[str], chosen: Mapping[str, str], origin: dt.date, days: int = 7, salary_days: Sequence[int] = (), branches: Sequence | None = None) -> tuple[DataFrame, DataFrame]:
    """Branch forecasts for ``days`` days from ``origin`` and the guidance per branch.

    Models see all rows before the origin. Predictors must be what a future day has: calendar,
    lag and rolling columns.
    """
    models, medians = fit_models(features, predictors, chosen, origin)
    return forecast_with(models, medians, features, origin, days, salary_days, branches)


def index_documents(spark: SparkSession, docs: DataFrame, target: str, stored: str | None = None, size: int = 120, overlap: int = 25) -> str:
    """Chunk and embed documents and write the store; ``stored`` is an earlier store to update."""
    # Copies of a document give equal chunk ids; the store keeps one row per id.
    chunks = retrieval.embed(retrieval.chunk_documents(docs, size, overlap).dropDuplicates(["id"]))
    if stored is None:
        return writers.write_store(chunks, target)
    return writers.upsert_store(spark, stored, cut(chunks), "id", target)


def update_index(spark: SparkSession, docs: DataFrame, path: str, size: int = 120, overlap: int = 25, parts: int = 64) -> int:
    """Chunk and embed documents into the store at ``path``, which is made if there is none; the version committed.

    Only the parts of the store that the chunks fall into are rewritten.
    """
    chunks = cut(retrieval.embed(retrieval.chunk_documents(docs, size, overlap).dropDuplicates(["id"])))
    store = Store(spark, path)
    return store.upsert(chunks) if store.exists() else store.create(chunks, "id", parts)


def ask(spark: SparkSession, store: str, questions: DataFrame, k: int = retrieval.TOP_K, min_score: float = retrieval.MIN_SCORE) -> tuple[DataFrame, DataFrame]:
    """(answers, hits) for a batch of (question_id, text); blank questions are refused."""
    if not questions.where(F.trim("text") == "").isEmpty():
        raise ValueError("question cannot be empty")
    asked = retrieval.embed(questions)
    versioned = Store(spark, store)
    chunks = versioned.read() if versioned.exists() else spark.read.parquet(store)
    hits = cut(retrieval.search(asked, chunks, k, min_score))
    return retrieval.answer(questions, hits), hits
