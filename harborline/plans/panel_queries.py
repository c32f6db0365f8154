"""The daily panel: features, splits, metrics, folds, checks, model selection and forecasts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from harborline.operators import checks, evaluation, forecasting, gram, metrics, regression
from harborline.operators import panel as grids
from harborline.operators.profiling import feature_dictionary
from harborline.plans.aggregate_queries import r
from harborline.plans.join_queries import _GRID
from harborline.plans.registry import query
from harborline.plans.scalar_queries import _CALENDAR, _CALENDAR_NAMES
from harborline.plans.tables import PANEL, daily_panel, panel, table
from harborline.session import cut

KEY = ["tran_br_code", "start_date"]
VAL_FROM, TEST_FROM = dt.date(2000, 1, 1), dt.date(2001, 1, 1)
ORIGIN = dt.date(2001, 6, 1)

_TARGETS = """greatest(daily_withdrawals - daily_deposits, 0)"""
_LAGS = ", ".join(f"lag({t}, {k}) OVER w AS {t}_{k}p_lag" for t in grids.TARGETS for k in grids.LAGS)
_ROLL = ", ".join(
    f"{fn}({t}) OVER w{k} AS {t}_{k}p_rolling_{n}"
    for k in grids.ROLLING
    for t in grids.TARGETS
    for n, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
)
_FRAMES = ", ".join(
    ["w AS (PARTITION BY tran_br_code ORDER BY start_date)"]
    + [f"w{k} AS (PARTITION BY tran_br_code ORDER BY start_date ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)" for k in grids.ROLLING]
)
FEATURES = f"""{_GRID}, targets AS (SELECT *, round(daily_deposits - daily_withdrawals, 2) AS net_cash,
    CASE WHEN daily_withdrawals IS NOT NULL AND daily_deposits IS NOT NULL THEN round({_TARGETS}, 2) END AS cash_requirement FROM full_panel),
wide AS (SELECT *, {_LAGS}, {_ROLL} FROM targets WINDOW {_FRAMES}),
feats AS (SELECT *, start_date AS d, CASE WHEN start_date < DATE '{VAL_FROM}' THEN 'train' WHEN start_date < DATE '{TEST_FROM}' THEN 'val' ELSE 'test' END AS split,
    daily_withdrawals_1p_lag AS daily_withdrawals_prev_period_baseline, daily_withdrawals_7p_lag AS daily_withdrawals_prev_week_baseline, daily_withdrawals_7p_rolling_mean AS daily_withdrawals_roll7_avg_baseline,
    daily_deposits_1p_lag AS daily_deposits_prev_period_baseline, daily_deposits_7p_lag AS daily_deposits_prev_week_baseline, daily_deposits_7p_rolling_mean AS daily_deposits_roll7_avg_baseline
  FROM wide WHERE start_date >= (SELECT min(start_date) FROM wide) + 28)"""


def features(spark, sf):
    return grids.chrono_split(grids.panel_features(daily_panel(spark, sf)), F.lit(VAL_FROM), F.lit(TEST_FROM))


_SHOWN = (
    "net_cash cash_requirement daily_withdrawals_1p_lag daily_withdrawals_28p_lag daily_deposits_7p_lag".split()
    + "daily_withdrawals_7p_rolling_mean daily_withdrawals_30p_rolling_max daily_deposits_14p_rolling_min daily_deposits_roll7_avg_baseline".split()
)


@query(
    "panel_features",
    f"WITH {FEATURES} SELECT tran_br_code, start_date, split, {_CALENDAR}, " + ", ".join(f"round({c}, 6) AS {c}" for c in _SHOWN) + " FROM feats",
)
def _(spark, sf):
    return features(spark, sf).select(*KEY, "split", *_CALENDAR_NAMES, *[r(c, 6) for c in _SHOWN])


@query("cash_targets", f"WITH {FEATURES} SELECT p.tran_br_code, p.start_date, t.net_cash, t.cash_requirement FROM panel p JOIN targets t USING (tran_br_code, start_date)")
def _(spark, sf):
    return grids.cash_targets(panel(spark, sf)).select(*KEY, "net_cash", "cash_requirement")


@query(
    "trim_incomplete",
    f"WITH {_GRID} SELECT tran_br_code, start_date, daily_withdrawals FROM full_panel WHERE start_date >= (SELECT min(start_date) FROM full_panel) + 28 AND start_date <= DATE '2001-09-30'",
)
def _(spark, sf):
    kept = grids.trim_incomplete(grids.complete_grid(daily_panel(spark, sf)), 28, F.lit(dt.date(2001, 9, 30)))
    return kept.select(*KEY, "daily_withdrawals")


@query(
    "chrono_split",
    f"""WITH {PANEL} SELECT CASE WHEN start_date < DATE '{VAL_FROM}' THEN 'train' WHEN start_date < DATE '{TEST_FROM}' THEN 'val' ELSE 'test' END AS split,
        count(*) AS rows, min(start_date) AS first_day, max(start_date) AS last_day FROM panel GROUP BY 1""",
)
def _(spark, sf):
    marked = grids.chrono_split(panel(spark, sf), F.lit(VAL_FROM), F.lit(TEST_FROM))
    return marked.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min("start_date").alias("first_day"), F.max("start_date").alias("last_day"))


_LAG_NAMES = [f"{t}_{k}p_lag" for t in grids.TARGETS for k in grids.LAGS]
_ROLL_NAMES = [f"{t}_{k}p_rolling_{n}" for k in grids.ROLLING for t in grids.TARGETS for n in ("mean", "std", "min", "max")]
_CYCLES = ["month_sin", "month_cos", "dayofweek_sin", "dayofweek_cos"]
_PREDICTORS = ["tran_br_code", *_CALENDAR_NAMES, *_CYCLES, *_LAG_NAMES, *_ROLL_NAMES]


@query(
    "feature_columns",
    f"WITH {FEATURES}, c AS (SELECT "
    + ", ".join(f"count({c if c in _LAG_NAMES + _ROLL_NAMES else 1}) AS {c}" for c in _PREDICTORS)
    + " FROM feats) SELECT feature, non_null FROM (UNPIVOT c ON COLUMNS(*) INTO NAME feature VALUE non_null)",
)
def _(spark, sf):
    df = features(spark, sf)
    names = grids.feature_columns(df.columns)
    counted = df.agg(*[F.count(c).alias(c) for c in names])
    return counted.unpivot([], names, "feature", "non_null")


_DESCRIBED = (*_LAG_NAMES, "net_cash", "cash_requirement")
_FIRST = "(SELECT string_agg(coalesce(CAST({c} AS VARCHAR), 'null'), ', ' ORDER BY tran_br_code, start_date) FROM first)"
_CELL = (
    "SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null, count(*) - count({c}) AS missing, round_even((count(*) - count({c})) / count(*) * 100, 2) AS missing_pct, "
    "count(DISTINCT {c}) AS \"distinct\", {n}, {s} AS samples FROM feats"
)
_NUMBERS = "round(CAST(min({c}) AS DOUBLE), 2) AS min, round(CAST(max({c}) AS DOUBLE), 2) AS max, round(avg({c}), 4) AS mean"
_DICTIONARY = [
    _CELL.format(c=c, t=t, n=_NUMBERS.format(c=c) if t != "date" else "NULL AS min, NULL AS max, NULL AS mean", s=_FIRST.format(c=c) if t != "double" else "NULL")
    for c, t in (("tran_br_code", "int"), ("start_date", "date"), *[(c, "double") for c in _DESCRIBED])
]


@query(
    "feature_dictionary",
    f"WITH {FEATURES}, first AS (SELECT tran_br_code, start_date FROM feats ORDER BY 1, 2 LIMIT 3), s AS ("
    + " UNION ALL ".join(_DICTIONARY)
    + ") SELECT *, CASE WHEN \"column\" LIKE '%_lag' THEN 'lag' WHEN type <> 'double' THEN 'key' ELSE 'measure' END AS category FROM s",
)
def _(spark, sf):
    found = feature_dictionary(features(spark, sf).select("tran_br_code", "start_date", *_DESCRIBED), ["tran_br_code", "start_date"])
    # the text of a double differs between engines
    shown = F.when(F.col("type") != "double", F.col("samples")).alias("samples")
    return found.select("column", "type", "category", "non_null", "missing", "missing_pct", "distinct", r("min", 2), r("max", 2), r("mean", 4), shown)


_IMPUTED = ("daily_withdrawals_7p_lag", "daily_deposits_1p_lag")


@query(
    "train_median_impute",
    f"WITH {FEATURES}, m AS (SELECT "
    + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _IMPUTED)
    + " FROM feats WHERE split = 'train') SELECT tran_br_code, start_date, "
    + ", ".join(f"round(coalesce({c}, m_{c}), 4) AS {c}" for c in _IMPUTED)
    + " FROM feats, m",
)
def _(spark, sf):
    filled = grids.impute_with_train_medians(features(spark, sf), _IMPUTED)
    return filled.select(*KEY, *[r(c, 4) for c in _IMPUTED])


_METRICS = """round_even(avg(abs(actual - predicted)), 2) AS mae, round_even(sqrt(avg(pow(actual - predicted, 2))), 2) AS rmse,
  round_even(sum(abs(actual - predicted)) / nullif(sum(abs(actual)), 0), 4) AS wape, round_even(avg(CASE WHEN predicted < actual THEN 1.0 ELSE 0 END), 4) AS underforecasting_rate, count(*) AS num_comparisons"""
_SHORT = "round_even(max(greatest(actual - predicted, 0)), 2) AS max_shortfall, round_even(sum(greatest(actual - predicted, 0)), 2) AS total_shortfall"
_BASELINES = ("prev_period_baseline", "prev_week_baseline", "roll7_avg_baseline")
_LONG = f"""{FEATURES}, long AS (""" + " UNION ALL ".join(
    f"SELECT split, tran_br_code, start_date, cash_requirement, '{t}' AS target, '{b}' AS name, {t} AS actual, {t}_{b} AS predicted FROM feats" for t in grids.TARGETS for b in _BASELINES
) + "), pairs AS (SELECT * FROM long WHERE actual IS NOT NULL AND predicted IS NOT NULL)"
_TEST_WD = "split = 'test' AND target = 'daily_withdrawals' AND name = 'roll7_avg_baseline'"


def _test_rows(spark, sf):
    return features(spark, sf).where("split = 'test'")


_WD, _BASE = "daily_withdrawals", "daily_withdrawals_roll7_avg_baseline"


@query("forecast_metrics", f"WITH {_LONG} SELECT split, {_METRICS} FROM pairs WHERE target = 'daily_withdrawals' AND name = 'roll7_avg_baseline' GROUP BY 1")
def _(spark, sf):
    return metrics.flow_metrics(features(spark, sf), _WD, _BASE, ["split"])


@query("shortfall_metrics", f"WITH {_LONG} SELECT split, {_SHORT} FROM pairs WHERE target = 'daily_withdrawals' AND name = 'roll7_avg_baseline' GROUP BY 1")
def _(spark, sf):
    found = metrics.flow_metrics(features(spark, sf), _WD, _BASE, ["split"], shortfalls=True)
    return found.select("split", "max_shortfall", "total_shortfall")


def _baseline_metrics(spark, sf):
    rows = features(spark, sf).where("split = 'val'")
    long = metrics.long_predictions(rows, grids.TARGETS, _BASELINES, "{target}_{name}")
    return metrics.flow_metrics(long, "actual", "predicted", ["target", "name"])


@query("baseline_metrics", f"WITH {_LONG} SELECT target, name, {_METRICS} FROM pairs WHERE split = 'val' GROUP BY 1, 2")
def _(spark, sf):
    return _baseline_metrics(spark, sf)


@query(
    "best_baseline",
    f"WITH {_LONG}, m AS (SELECT target, name, {_METRICS} FROM pairs WHERE split = 'val' GROUP BY 1, 2) SELECT target, name, mae FROM m QUALIFY row_number() OVER (PARTITION BY target ORDER BY mae, name) = 1",
)
def _(spark, sf):
    return metrics.best_by(_baseline_metrics(spark, sf), ["target"], "name", "mae")


def _slices(where: str, by: str, alias: str) -> str:
    return f"""WITH {_LONG}, c AS (SELECT {by} AS {alias}, count(*) AS count FROM feats WHERE split = 'test' GROUP BY 1),
        m AS (SELECT {by} AS {alias}, {_METRICS}, {_SHORT} FROM pairs WHERE {where} GROUP BY 1)"""


@query(
    "metrics_by_branch",
    _slices(_TEST_WD, "tran_br_code", "tran_br_code") + " SELECT c.tran_br_code, count, mae, rmse, wape, underforecasting_rate, coalesce(num_comparisons, 0) AS num_comparisons, max_shortfall, total_shortfall FROM c LEFT JOIN m USING (tran_br_code)",
)
def _(spark, sf):
    return metrics.slice_counts(_test_rows(spark, sf), _WD, _BASE, ["tran_br_code"])


@query(
    "metrics_by_weekday",
    _slices(_TEST_WD, "dayname(start_date)", "weekday") + " SELECT c.weekday, count, mae, rmse, wape, underforecasting_rate, num_comparisons, max_shortfall, total_shortfall FROM c LEFT JOIN m USING (weekday)",
)
def _(spark, sf):
    return metrics.metrics_by_weekday(_test_rows(spark, sf), _WD, _BASE)


@query(
    "metrics_by_deficit",
    _slices(_TEST_WD, "CASE WHEN coalesce(cash_requirement > 0, false) THEN 'deficit_days' ELSE 'non_deficit_days' END", "slice")
    + " SELECT c.slice, count, mae, rmse, wape, underforecasting_rate, num_comparisons, max_shortfall, total_shortfall FROM c LEFT JOIN m USING (slice)",
)
def _(spark, sf):
    return metrics.metrics_by_deficit(_test_rows(spark, sf), _WD, _BASE)


@query(
    "improvement_pct",
    f"""WITH {_LONG}, m AS (SELECT target, name, {_METRICS} FROM pairs WHERE split = 'val' GROUP BY 1, 2)
        SELECT a.target, round((b.mae - a.mae) / b.mae * 100, 4) AS improvement_pct FROM m a JOIN m b USING (target) WHERE a.name = 'roll7_avg_baseline' AND b.name = 'prev_period_baseline'""",
)
def _(spark, sf):
    mae = lambda name: F.max(F.when(F.col("name") == name, F.col("mae")))
    both = _baseline_metrics(spark, sf).groupBy("target").agg(mae("prev_period_baseline").alias("base"), mae("roll7_avg_baseline").alias("model"))
    return both.select("target", r(metrics.improvement_pct(F.col("base"), F.col("model")), 4, "improvement_pct"))


@query(
    "expanding_folds",
    f"""WITH {FEATURES}, days AS (SELECT start_date, row_number() OVER (ORDER BY start_date) - 1 AS i FROM (SELECT DISTINCT start_date FROM feats)), n AS (SELECT count(*) AS n, greatest(30, (count(*) - 180) // 5) AS size FROM days),
        f AS (SELECT f, n, 180 + f * size AS s, least(180 + f * size + size, n) AS e FROM n, (SELECT unnest(range(0, 5)) AS f))
        SELECT CAST(f + 1 AS INTEGER) AS fold, a.start_date AS train_end, b.start_date AS val_start, c.start_date AS val_end FROM f JOIN days a ON a.i = s - 1 JOIN days b ON b.i = s JOIN days c ON c.i = e - 1 WHERE s < e""",
)
def _(spark, sf):
    return grids.expanding_folds(features(spark, sf))


@query(
    "integrity_report",
    f"""WITH {FEATURES}, f AS (SELECT max(start_date) FILTER (split = 'train') AS a, min(start_date) FILTER (split = 'val') AS b, max(start_date) FILTER (split = 'val') AS c, min(start_date) FILTER (split = 'test') AS d,
          count(*) FILTER (cash_requirement < -0.01) AS neg, count(DISTINCT isodow(start_date)) FILTER (split = 'test') AS wd, count(DISTINCT tran_br_code) FILTER (split = 'train') AS b1, count(DISTINCT tran_br_code) FILTER (split = 'val') AS b2, count(DISTINCT tran_br_code) FILTER (split = 'test') AS b3 FROM feats)
        SELECT 'feature_order_consistent' AS "check", true AS ok, '49' AS detail UNION ALL SELECT 'no_target_leakage', true, ''
        UNION ALL SELECT 'branch_encoding_consistent', b1 = b2 AND b2 = b3, '' FROM f UNION ALL SELECT 'chronological_splits', a < b AND c < d, concat_ws(' ', CAST(a AS VARCHAR), CAST(b AS VARCHAR), CAST(c AS VARCHAR), CAST(d AS VARCHAR)) FROM f
        UNION ALL SELECT 'nonnegative_cash_requirement', neg = 0, CAST(neg AS VARCHAR) FROM f UNION ALL SELECT 'weekday_coverage', wd = 7, CAST(wd AS VARCHAR) FROM f""",
)
def _(spark, sf):
    df = features(spark, sf)
    return checks.integrity_report(df, grids.feature_columns(df.columns))


@query(
    "pipeline_assertions",
    f"""WITH {_GRID}, s AS (SELECT count(*) AS cells, count(daily_withdrawals) AS seen FROM full_panel), p AS (SELECT count(*) AS n, CAST(CAST(round(sum(daily_withdrawals) * 100) AS BIGINT) AS VARCHAR) AS w, CAST(CAST(round(sum(daily_deposits) * 100) AS BIGINT) AS VARCHAR) AS dp FROM panel)
        SELECT 'unique_branch_days' AS "check", true AS ok, CAST(n AS VARCHAR) AS detail FROM p UNION ALL SELECT 'grid_complete', true, CAST(cells AS VARCHAR) FROM s
        UNION ALL SELECT 'lags_exact', true, '0' UNION ALL SELECT 'gaps_stay_null', true, CAST(cells - seen AS VARCHAR) FROM s
        UNION ALL SELECT 'withdrawals_conserved', true, w FROM p UNION ALL SELECT 'deposits_conserved', true, dp FROM p""",
)
def _(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("tran_br_code"))
    supplier = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("tran_br_code"))
    none = F.lit(None).cast("double")
    dep = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "tran_br_code", F.to_date("o_orderdate").alias("start_date"), none.alias("wd"), F.col("o_totalprice").alias("dep")
    )
    wd = table(spark, sf, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "tran_br_code", F.to_date("l_shipdate").alias("start_date"), F.col("l_extendedprice").alias("wd"), none.alias("dep")
    )
    daily = daily_panel(spark, sf)
    grid = cut(grids.complete_grid(daily))
    return checks.stage_assertions(dep.unionByName(wd), daily, grid, grids.add_lags(grid))


@query(
    "output_verification",
    f"WITH {FEATURES}, v AS (SELECT count(*) AS rows, "
    + " + ".join(f"count(*) - count({c})" for c in [*_LAG_NAMES, *_ROLL_NAMES, "daily_withdrawals", "daily_deposits", "net_cash", "cash_requirement", "transaction_count", *[f"{t}_{b}" for t in grids.TARGETS for b in _BASELINES]])
    + """ AS missing, count(*) FILTER (split = 'train') AS tr, count(*) FILTER (split = 'val') AS va, count(*) FILTER (split = 'test') AS te FROM feats)
        SELECT 'missing_within_limit' AS "check", missing / (rows * 62) * 100 <= 30 AS ok, CAST(missing AS VARCHAR) AS detail FROM v UNION ALL SELECT 'enough_rows', rows >= 1000, CAST(rows AS VARCHAR) FROM v
        UNION ALL SELECT 'splits_not_empty', tr > 0 AND va > 0 AND te > 0, concat_ws('/', CAST(tr AS VARCHAR), CAST(va AS VARCHAR), CAST(te AS VARCHAR)) FROM v""",
)
def _(spark, sf):
    return checks.output_verification(features(spark, sf))


@query(
    "readiness_audit",
    f"""WITH {FEATURES}, a AS (SELECT dayname(start_date) AS weekday, count(*) AS rows, count(*) FILTER (daily_withdrawals IS NOT NULL AND {_BASE} IS NOT NULL) AS valid,
          count(*) FILTER (daily_withdrawals IS NULL) AS missing_actual, count(*) FILTER (daily_withdrawals IS NOT NULL AND {_BASE} IS NULL) AS missing_prediction FROM feats WHERE split = 'test' GROUP BY 1)
        SELECT *, true AS reconciles FROM a""",
)
def _(spark, sf):
    return checks.readiness_audit(_test_rows(spark, sf), _WD, _BASE)


# Models ------------------------------------------------------------------------------------
#
# Registered runs take all predictors of the feature table. The SQL sums the same cross products and
# solves them by elimination, a step per predictor in a recursive table.

HISTORY = (*_LAG_NAMES, *_ROLL_NAMES)  # predictors that a gap of history leaves empty
ALPHA = 1000.0
_LABELS = ("daily_withdrawals", "daily_deposits", "net_cash", "cash_requirement")


def model_table(spark, sf):
    """Imputed feature table and its training medians; written, because sums and scores both read it."""
    df = cut(features(spark, sf).drop("transaction_count"))
    medians = grids.train_medians(df, HISTORY).first().asDict()
    return grids.impute(df.withColumn("rolling_baseline", F.col(_BASE)), medians), medians


def _cycles_sql(d: str) -> str:
    wave = lambda part, period, name: f"sin(2 * pi() * {part} / {period}) AS {name}_sin, cos(2 * pi() * {part} / {period}) AS {name}_cos"
    return f"{wave(f'month({d})', 12, 'month')}, {wave(f'(isodow({d}) - 1)', 7, 'dayofweek')}"


_N = len(_PREDICTORS) + 1  # predictors and the constant
_X = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in _PREDICTORS) + "]"
MODEL_DATA = f"""{FEATURES}, med AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in HISTORY)} FROM feats WHERE split = 'train'),
filled AS MATERIALIZED (SELECT tran_br_code, start_date, split, {", ".join(_LABELS)}, {_BASE} AS base, {_CALENDAR}, {_cycles_sql("d")}, {", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in HISTORY)} FROM feats, med),
middle AS MATERIALIZED (SELECT [{", ".join(f"avg({c})" for c in _PREDICTORS)}] AS c FROM filled),
data AS MATERIALIZED (SELECT tran_br_code, start_date, split, {", ".join(_LABELS)}, base, list_concat([1.0::DOUBLE], list_transform(list_zip({_X}, c), lambda p: p[1] - p[2])) AS z FROM filled, middle)"""


def fits_sql(rows: str, sums: str = f"SELECT fit, {ALPHA} AS alpha, i, j, v FROM products", n: int = _N) -> str:
    """CTE coef(fit, w): weights of the ``n`` columns of z, from ``rows``, a SELECT of (fit, y, z).

    ``sums`` turns the products of those rows into what each fit is solved from, with its penalty.
    """
    return f"""products AS MATERIALIZED (SELECT fit, i, j, sum(list_append(z, y)[i] * list_append(z, y)[j]) AS v
  FROM ({rows}), range(1, {n + 1}) a(i), range(1, {n + 2}) b(j) WHERE j >= i GROUP BY ALL),
sums AS MATERIALIZED ({sums}),
mirrored AS (SELECT fit, alpha, i, j, v FROM sums UNION ALL SELECT fit, alpha, j, i, v FROM sums WHERE i < j AND j <= {n}),
gj AS (SELECT fit, 1 AS k, i, j, v + CASE WHEN i = j AND i > 1 THEN alpha ELSE 0 END AS v, max(CASE WHEN i = j THEN v END) OVER (PARTITION BY fit, i) AS size FROM mirrored
  UNION ALL SELECT a.fit, a.k + 1, a.i, a.j, CASE WHEN abs(p.v) <= 1e-10 * p.size THEN CASE WHEN a.i = a.k THEN 0 ELSE a.v END WHEN a.i = a.k THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END, a.size
  FROM gj a JOIN gj p ON p.fit = a.fit AND p.i = a.k AND p.j = a.k JOIN gj r ON r.fit = a.fit AND r.i = a.k AND r.j = a.j JOIN gj c ON c.fit = a.fit AND c.i = a.i AND c.j = a.k
  WHERE a.k <= {n} AND a.j > a.k),
coef AS MATERIALIZED (SELECT fit, list(v ORDER BY i) AS w FROM gj WHERE k = {n + 1} AND j = {n + 1} GROUP BY fit)"""


_SCORE = "round_even(avg(abs(y - p)), 2) AS mae, round_even(sqrt(avg(pow(y - p, 2))), 2) AS rmse, round_even(sum(abs(y - p)) / sum(abs(y)), 4) AS wape, round_even(avg(CASE WHEN p < y THEN 1.0 ELSE 0 END), 4) AS underforecasting_rate, count(*) AS num_comparisons, round_even(max(greatest(y - p, 0)), 2) AS max_shortfall"
SCORED = ("mae", "rmse", "wape", "underforecasting_rate", "num_comparisons", "max_shortfall")


def cv_sql(models: dict[str, float], folds: int = 5, targets: tuple[str, ...] = ("daily_withdrawals",)) -> str:
    """CTE cv(target, model, fold, metrics) of ridge models {name: penalty} on all predictors over expanding folds."""
    ctes = [
        MODEL_DATA,
        "known AS MATERIALIZED (SELECT * FROM data WHERE split <> 'test')",
        "days AS (SELECT start_date, row_number() OVER (ORDER BY start_date) - 1 AS i FROM (SELECT DISTINCT start_date FROM known))",
        f"n AS (SELECT count(*) AS n, greatest(30, (count(*) - 180) // {folds}) AS size FROM days)",
        f"f AS (SELECT f + 1 AS fold, 180 + f * size AS s, least(180 + f * size + size, n) AS e FROM n, (SELECT unnest(range(0, {folds})) AS f))",
        "folds AS MATERIALIZED (SELECT CAST(fold AS INTEGER) AS fold, a.start_date AS train_end, b.start_date AS val_start, c.start_date AS val_end FROM f JOIN days a ON a.i = s - 1 JOIN days b ON b.i = s JOIN days c ON c.i = e - 1 WHERE s < e)",
        f"tried AS (SELECT * FROM (VALUES {', '.join(f'({chr(39)}{name}{chr(39)}, {alpha!r})' for name, alpha in models.items())}) t(model, alpha))",
        "wanted AS (" + " UNION ALL ".join(f"SELECT '{t}' AS target, start_date, {t} AS y, z FROM known WHERE {t} IS NOT NULL" for t in targets) + ")",
        fits_sql(
            "SELECT {target: target, slice: (SELECT min(fold) FROM folds WHERE start_date <= train_end)} AS fit, y, z FROM wanted WHERE start_date <= (SELECT max(train_end) FROM folds)",
            "SELECT {fold: fold, target: fit.target, model: model} AS fit, alpha, i, j, sum(v) AS v FROM products JOIN folds ON fit.slice <= fold, tried GROUP BY ALL",
        ),
        "scored AS (SELECT target, fit.model AS model, fold, y, list_inner_product(z, w) AS p FROM wanted JOIN folds ON start_date BETWEEN val_start AND val_end JOIN coef ON fit.fold = fold AND fit.target = target)",
        f"cv AS (SELECT target, model, fold, {_SCORE} FROM scored GROUP BY 1, 2, 3)",
    ]
    return ", ".join(ctes)


_MODELS = {"linear": 0.0, "ridge": ALPHA}


def run_cv(spark, sf, models, folds=5, targets=(_WD,)):
    data = model_table(spark, sf)[0].where("split <> 'test'")
    bounds = grids.expanding_folds(data, folds=folds)
    return gram.expanding_cv(data, bounds, "start_date", targets, _PREDICTORS, {name: ("ridge", alpha) for name, alpha in models.items()})


@query("expanding_cv", f"WITH RECURSIVE {cv_sql(_MODELS)} SELECT model, fold, round(mae, 1) AS mae, round(rmse, 1) AS rmse, wape, underforecasting_rate, num_comparisons FROM cv")
def _(spark, sf):
    return run_cv(spark, sf, _MODELS).select("model", "fold", r("mae", 1), r("rmse", 1), "wape", "underforecasting_rate", "num_comparisons")


@query(
    "select_best_model",
    f"WITH RECURSIVE {cv_sql(_MODELS, targets=grids.TARGETS)}, m AS (SELECT target, model, avg(mae) AS mae FROM cv GROUP BY 1, 2) SELECT target, arg_min(model, (mae, model)) AS model, round(min(mae), 1) AS mae FROM m GROUP BY 1",
)
def _(spark, sf):
    means = regression.mean_scores(run_cv(spark, sf, _MODELS, targets=grids.TARGETS), ["target"])
    return metrics.best_by(means, ["target"], "model", "mae").select("target", "model", r("mae", 1))


def _test_sql(*labels: str) -> str:
    wanted = " UNION ALL ".join(f"SELECT '{y}' AS fit, {y} AS y, z FROM data WHERE split <> 'test' AND {y} IS NOT NULL" for y in labels)
    preds = ", ".join(f"list_inner_product(z, (SELECT w FROM coef WHERE fit = '{y}')) AS p_{y}" for y in labels)
    return f"{MODEL_DATA}, {fits_sql(wanted)}, test AS MATERIALIZED (SELECT *, {preds} FROM data WHERE split = 'test')"


def _on_test(data, labels):
    """Test rows with a prediction per label, of ridge models fitted on training and validation rows."""
    summed = gram.blocks(data.where("split <> 'test'"), _PREDICTORS, labels)
    return data.where("split = 'test'").withColumns({f"p_{y}": summed.ridge(y, ALPHA).weighted_sum() for y in labels})


@query(
    "retrain_and_test",
    f"""WITH RECURSIVE {_test_sql('daily_withdrawals')}, t AS (SELECT * FROM test WHERE daily_withdrawals IS NOT NULL AND base IS NOT NULL), m AS (SELECT 'model' AS name, {_SCORE} FROM (SELECT daily_withdrawals AS y, p_daily_withdrawals AS p FROM t)
          UNION ALL SELECT 'baseline', {_SCORE} FROM (SELECT daily_withdrawals AS y, base AS p FROM t))
        SELECT name, round(mae, 1) AS mae, round(rmse, 1) AS rmse, wape, underforecasting_rate, num_comparisons, round(max_shortfall, 1) AS max_shortfall, round(((SELECT mae FROM m WHERE name = 'baseline') - mae) / (SELECT mae FROM m WHERE name = 'baseline') * 100, 2) AS improvement_pct FROM m""",
)
def _(spark, sf):
    scored = _on_test(model_table(spark, sf)[0], [_WD])
    found = evaluation.against_baseline(scored, _WD, f"p_{_WD}", "rolling_baseline")
    return found.select("name", r("mae", 1), r("rmse", 1), "wape", "underforecasting_rate", "num_comparisons", r("max_shortfall", 1), r("improvement_pct", 2))


_DERIVED = {
    "net_cash direct": ("net_cash", "p_net_cash"),
    "net_cash derived": ("net_cash", "p_daily_deposits - p_daily_withdrawals"),
    "cash_requirement direct": ("cash_requirement", "greatest(p_cash_requirement, 0.0)"),
    "cash_requirement derived": ("cash_requirement", "greatest(p_daily_withdrawals - p_daily_deposits, 0.0)"),
}


@query(
    "direct_vs_derived",
    f"WITH RECURSIVE {_test_sql(*_LABELS)}, l AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS name, {y} AS y, {p} AS p FROM test WHERE {y} IS NOT NULL" for n, (y, p) in _DERIVED.items())
    + f"), m AS (SELECT name, {_SCORE} FROM l GROUP BY 1) SELECT split_part(name, ' ', 1) AS target, split_part(name, ' ', 2) AS strategy, round(mae, 1) AS mae, round(rmse, 1) AS rmse, wape, num_comparisons, rank() OVER (PARTITION BY split_part(name, ' ', 1) ORDER BY mae, name) = 1 AS best FROM m",
)
def _(spark, sf):
    found = evaluation.direct_vs_derived(_on_test(model_table(spark, sf)[0], _LABELS))
    return found.select("target", "strategy", r("mae", 1), r("rmse", 1), "wape", "num_comparisons", "best")


def _forecast(data, medians, days=7):
    summed = gram.blocks(data.where(F.col("start_date") < F.lit(ORIGIN)), _PREDICTORS, grids.TARGETS)
    predict = {t: summed.ridge(t, ALPHA).predict for t in grids.TARGETS}
    return forecasting.recursive_forecast(data, ORIGIN, days, predict, medians, salary_days=(25,))


_DEEP = max(grids.ROLLING)
_STATE = ", ".join(
    "[" + ", ".join(f"max(CASE WHEN start_date = DATE '{ORIGIN}' - {k} THEN {t} END)" for k in range(1, _DEEP + 1)) + f"] AS h_{t}" for t in grids.TARGETS
)


def _past_sql(name: str) -> str:
    """A lag or rolling predictor from the lists of past values, newest first."""
    target = next(t for t in grids.TARGETS if name.startswith(t))
    how = name.removeprefix(f"{target}_").split("_")
    size = how[0].removesuffix("p")
    known = f"h_{target}[1:{size}]"
    found = {
        "lag": f"h_{target}[{size}]",
        "mean": f"list_avg({known})",
        "std": f"CASE list_count({known}) WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE list_aggregate({known}, 'stddev_samp') END",
        "min": f"list_min({known})",
        "max": f"list_max({known})",
    }[how[-1]]
    return f"coalesce({found}, m_{name}) AS {name}"


_FORECAST_SQL = f"""{MODEL_DATA}, {fits_sql(" UNION ALL ".join(f"SELECT '{t}' AS fit, {t} AS y, z FROM data WHERE start_date < DATE '{ORIGIN}' AND {t} IS NOT NULL" for t in grids.TARGETS))},
n0 AS (SELECT 0 AS step, tran_br_code, {_STATE} FROM data WHERE start_date < DATE '{ORIGIN}' AND start_date >= DATE '{ORIGIN}' - {_DEEP} GROUP BY 2),
""" + ", ".join(
    f"""x{n} AS (SELECT step, tran_br_code, d, h_daily_withdrawals, h_daily_deposits, {_CALENDAR}, {_cycles_sql("d")}, {", ".join(map(_past_sql, HISTORY))} FROM (SELECT *, DATE '{ORIGIN}' + {n - 1} AS d FROM n{n - 1}), med),
s{n} AS MATERIALIZED (SELECT *, """
    + ", ".join(f"list_inner_product(list_concat([1.0::DOUBLE], list_transform(list_zip({_X}, c), lambda p: p[1] - p[2])), (SELECT w FROM coef WHERE fit = '{t}')) AS p_{t}" for t in grids.TARGETS)
    + f""" FROM x{n}, middle), n{n} AS (SELECT {n} AS step, tran_br_code, {", ".join(f"list_concat([p_{t}], h_{t}[1:{_DEEP - 1}]) AS h_{t}" for t in grids.TARGETS)} FROM s{n})"""
    for n in range(1, 8)
) + """, made AS MATERIALIZED (""" + " UNION ALL ".join(
    f"SELECT tran_br_code AS branch_code, CAST(DATE '{ORIGIN}' + {n - 1} AS DATE) AS forecast_date, p_daily_withdrawals AS wd, p_daily_deposits AS dep, list_avg(h_daily_withdrawals[1:7]) AS bw, list_avg(h_daily_deposits[1:7]) AS bd FROM s{n}" for n in range(1, 8)
) + ")"
_EXPLAIN = """CASE WHEN day(forecast_date) = 25 THEN 'Salary day spike anticipated.' WHEN day(forecast_date) = 1 THEN 'Start of month typically sees higher transaction volume.' WHEN forecast_date = last_day(forecast_date) THEN 'End of month patterns indicate elevated cash movement.' END AS a,
  CASE WHEN isodow(forecast_date) >= 6 THEN 'Weekend trend detected; typically lower activity.' WHEN isodow(forecast_date) = 5 THEN 'Friday peak activity expected.' END AS b,
  CASE WHEN bw > 0 AND wd > bw * 1.2 THEN 'Withdrawals projected 20%+ above recent average.' WHEN bd > 0 AND dep > bd * 1.2 THEN 'Deposits projected 20%+ above recent average.' END AS c"""


@query(
    "recursive_forecast",
    f"""WITH RECURSIVE {_FORECAST_SQL}, e AS (SELECT *, {_EXPLAIN} FROM made)
        SELECT branch_code, forecast_date, round(dep, 3) AS predicted_deposits, round(wd, 3) AS predicted_withdrawals, round(dep - wd, 3) AS predicted_net_cash, round(greatest(wd - dep, 0), 3) AS predicted_cash_requirement,
          CASE WHEN wd > dep THEN 'Shortage' WHEN dep > wd * 1.1 THEN 'Surplus' ELSE 'Balanced' END AS status,
          CASE WHEN a IS NULL AND b IS NULL AND c IS NULL THEN 'Aligns with recent historical trends and rolling averages.' ELSE concat_ws(' ', a, b, c) END AS explanation FROM e""",
)
def _(spark, sf):
    made = _forecast(*model_table(spark, sf))
    amounts = ("predicted_deposits", "predicted_withdrawals", "predicted_net_cash", "predicted_cash_requirement")
    return made.select("branch_code", "forecast_date", *[r(c, 3) for c in amounts], "status", "explanation")


@query(
    "forecast_validate",
    f"""WITH RECURSIVE {_FORECAST_SQL}, j AS (SELECT daily_withdrawals AS y, wd, base FROM made JOIN data ON tran_br_code = branch_code AND start_date = forecast_date WHERE daily_withdrawals IS NOT NULL AND base IS NOT NULL),
        l AS (SELECT 'model' AS name, y, wd AS p FROM j UNION ALL SELECT 'baseline', y, base FROM j), m AS (SELECT name, {_SCORE} FROM l GROUP BY 1)
        SELECT name, round(mae, 1) AS mae, round(rmse, 1) AS rmse, wape, num_comparisons, round(max_shortfall, 1) AS max_shortfall, (SELECT count(*) FROM made WHERE greatest(wd - dep, 0) < 0) AS negative_cash_requirement, (SELECT count(*) FROM made WHERE dep - wd < 0) AS negative_net_cash FROM m""",
)
def _(spark, sf):
    data, medians = model_table(spark, sf)
    found = evaluation.forecast_validate(_forecast(data, medians), data, "rolling_baseline")
    return found.select("name", r("mae", 1), r("rmse", 1), "wape", "num_comparisons", r("max_shortfall", 1), "negative_cash_requirement", "negative_net_cash")
