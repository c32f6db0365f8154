"""Learning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.operators import classification as cls
from harborline.operators import gram, metrics, regression
from harborline.plans.aggregate_queries import r
from harborline.plans.panel_queries import _SCORE, VAL_FROM, cv_sql, fits_sql, run_cv
from harborline.plans.registry import query
from harborline.plans.tables import PANEL, panel, table
from harborline.session import cut

# Regression: price of a line from quantity and discount --------------------------------------


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_quantity", "l_discount", F.col("l_extendedprice").alias("price"), (F.col("l_quantity") * F.col("l_quantity")).alias("squared")
    )


def _two(x1: str, x2: str, source: str, y: str = "price", alpha: float = 0.0) -> str:
    """CTEs c(m1, m2, my, s11, ...) and fit(b1, b2, b0): least squares on two columns."""
    return f"""c AS (SELECT avg({x1}) AS m1, avg({x2}) AS m2, avg({y}) AS my, var_pop({x1}) * count(*) + {alpha} AS s11, var_pop({x2}) * count(*) + {alpha} AS s22,
      covar_pop({x1}, {x2}) * count(*) AS s12, covar_pop({x1}, {y}) * count(*) AS s1y, covar_pop({x2}, {y}) * count(*) AS s2y FROM {source}),
    b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM c),
    fit AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM b)"""


_LINES = "x AS (SELECT l_quantity, l_discount, l_extendedprice AS price, l_quantity * l_quantity AS squared FROM lineitem)"


def _coefficients(x1: str, x2: str) -> str:
    return f"""SELECT '{x1}' AS feature, round(b1, 3) AS coefficient FROM fit UNION ALL SELECT '{x2}', round(b2, 3) FROM fit UNION ALL SELECT 'intercept', round(b0, 2) FROM fit"""


def _rounded(df):
    digits = F.when(F.col("feature") == "intercept", F.round("coefficient", 2)).otherwise(F.round("coefficient", 3))
    return df.withColumn("coefficient", digits)


@query("linear_regression", f"WITH {_LINES}, {_two('l_quantity', 'l_discount', 'x')} {_coefficients('l_quantity', 'l_discount')}")
def _(spark, sf):
    model = regression.linear_regression(_lines(spark, sf), ["l_quantity", "l_discount"], "price")
    return _rounded(model.coefficients(spark))


@query("ridge", f"WITH {_LINES}, {_two('l_quantity', 'l_discount', 'x', alpha=1000.0)} {_coefficients('l_quantity', 'l_discount')}")
def _(spark, sf):
    model = gram.blocks(_lines(spark, sf), ["l_quantity", "l_discount"], ["price"]).ridge("price", 1000.0)
    return _rounded(model.coefficients(spark))


@query(
    "lasso",
    f"""WITH {_LINES}, s AS (SELECT covar_pop(l_quantity, price) AS c, var_pop(l_quantity) AS v, avg(l_quantity) AS mx, avg(price) AS my FROM x),
        f AS (SELECT sign(c) * greatest(abs(c) - 100000.0, 0) / v AS b1, mx, my FROM s)
        SELECT 'l_quantity' AS feature, round(b1, 1) AS coefficient FROM f UNION ALL SELECT 'intercept', round(my - b1 * mx, 1) FROM f""",
)
def _(spark, sf):
    model = regression.lasso(_lines(spark, sf), ["l_quantity"], "price", 100000.0)
    return model.coefficients(spark).select("feature", r("coefficient", 1))


_POLY = f"{_LINES}, {_two('l_quantity', 'squared', 'x')}"


@query("polynomial_regression", f"WITH {_POLY} SELECT l_quantity, count(*) AS n, round(min(b0 + b1 * l_quantity + b2 * squared), 1) AS prediction FROM x, fit GROUP BY 1")
def _(spark, sf):
    df = _lines(spark, sf)
    model = regression.polynomial_regression(df, ["l_quantity"], "price", 2)
    counts = df.groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"))
    return model.predict(counts).select("l_quantity", "n", r("prediction", 1))


def _tree_scores(model, df):
    return metrics.regression_metrics(model.predict(df), "price", "prediction")


@query("random_forest_reg")
def _(spark, sf):
    df = cut(_lines(spark, sf))
    return _tree_scores(regression.random_forest(df, ["l_quantity", "l_discount"], "price"), df)


@query("gbt_reg")
def _(spark, sf):
    df = cut(_lines(spark, sf))
    return _tree_scores(regression.boosted_trees(df, ["l_quantity", "l_discount"], "price"), df)


_TIMES = ", ".join(f"sin(2 * pi() * {n} * t / {period}), cos(2 * pi() * {n} * t / {period})" for period, order in ((7.0, 2), (365.25, 3)) for n in range(1, order + 1))
_WAVES = f"""{PANEL}, days AS (SELECT tran_br_code, start_date, daily_withdrawals AS y, date_diff('day', DATE '1970-01-01', start_date) AS t FROM panel),
waves AS MATERIALIZED (SELECT tran_br_code, start_date, y, [1.0::DOUBLE, date_diff('day', DATE '{VAL_FROM}', start_date) / 365.25, {_TIMES}] AS z FROM days),
{fits_sql(f"SELECT tran_br_code AS fit, y, z FROM waves WHERE start_date < DATE '{VAL_FROM}' AND y IS NOT NULL", "SELECT fit, 0.0 AS alpha, i, j, v FROM products", 12)}"""


@query(
    "trend_seasonal_reg",
    f"""WITH RECURSIVE {_WAVES}, p AS (SELECT tran_br_code, y, list_inner_product(z, w) AS p FROM waves JOIN coef ON fit = tran_br_code WHERE start_date >= DATE '{VAL_FROM}' AND y IS NOT NULL)
        SELECT tran_br_code, round(mae, 1) AS mae, round(rmse, 1) AS rmse, wape, underforecasting_rate, num_comparisons FROM (SELECT tran_br_code, {_SCORE} FROM p GROUP BY 1)""",
)
def _(spark, sf):
    scored = regression.trend_seasonal(panel(spark, sf), "tran_br_code", "start_date", "daily_withdrawals", VAL_FROM)
    late = scored.where((F.col("start_date") >= F.lit(VAL_FROM)) & F.col("daily_withdrawals").isNotNull())
    found = metrics.flow_metrics(late, "daily_withdrawals", "prediction", ["tran_br_code"])
    return found.select("tran_br_code", r("mae", 1), r("rmse", 1), "wape", "underforecasting_rate", "num_comparisons")


_IMPORTANCE = f"""{_LINES}, {_two('l_quantity', 'l_discount', 'x')}, i AS (SELECT 'l_quantity' AS feature, abs(b1) AS importance FROM fit UNION ALL SELECT 'l_discount', abs(b2) FROM fit)"""


def _importance(spark, sf):
    model = regression.linear_regression(_lines(spark, sf), ["l_quantity", "l_discount"], "price")
    return model.importance(spark).select("feature", r("importance", 3))


@query("feature_importance", f"WITH {_IMPORTANCE} SELECT feature, round(importance, 3) AS importance FROM i")
def _(spark, sf):
    return _importance(spark, sf)


@query("top_features", f"WITH {_IMPORTANCE} SELECT feature, round(importance, 3) AS importance FROM i ORDER BY importance DESC, feature LIMIT 1")
def _(spark, sf):
    return _importance(spark, sf).orderBy(F.desc("importance"), "feature").limit(1)


_SHAPES = "x AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS chars, CAST(len(string_split(text, ' ')) AS DOUBLE) AS words, CAST(len(string_split(text, chr(10))) AS DOUBLE) AS lines FROM documents)"


def _shapes(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("chars"),
        F.size(F.split("text", " ", -1)).cast("double").alias("words"),
        F.size(F.split("text", "\n", -1)).cast("double").alias("lines"),
    )


_U = "CAST(CAST('0x' || substr(md5(concat_ws('|', {})), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0"
_HASH42 = _U.format("'42', CAST(doc_id AS VARCHAR)")


@query(
    "permutation_importance",
    f"""WITH {_SHAPES}, {_two('words', 'lines', 'x', 'chars')}, p AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS at, row_number() OVER (ORDER BY {_HASH42}, doc_id) AS deal FROM x),
        s AS (SELECT a.chars, a.words, a.lines, d.words AS dw, d.lines AS dl FROM p a JOIN p d ON a.at = d.deal),
        e AS (SELECT avg(abs(chars - b0 - b1 * words - b2 * lines)) AS base, avg(abs(chars - b0 - b1 * dw - b2 * lines)) AS w, avg(abs(chars - b0 - b1 * words - b2 * dl)) AS l FROM s, fit)
        SELECT 'words' AS feature, round(w - base, 4) AS mae_rise FROM e UNION ALL SELECT 'lines', round(l - base, 4) FROM e""",
)
def _(spark, sf):
    df = cut(_shapes(spark, sf))
    model = regression.linear_regression(df, ["words", "lines"], "chars")
    found = regression.permutation_importance(df, model, ["words", "lines"], "chars", "doc_id")
    return found.select("feature", r("mae_rise", 4))


@query("train_test_split", f"SELECT doc_id, {_HASH42} < 0.2 AS is_test FROM documents")
def _(spark, sf):
    return regression.train_test_mark(table(spark, sf, "documents").select("doc_id"), ["doc_id"], 0.2)


_RANGE = "s AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)"


@query("minmax_scale", f"WITH {_RANGE} SELECT c_custkey, round((c_acctbal - lo) / (hi - lo), 10) AS scaled FROM customer, s")
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("scaled"))
    return regression.min_max_scale(df, ["scaled"]).select("c_custkey", r("scaled", 10))


@query("minmax_inverse", "SELECT c_custkey, round(c_acctbal, 4) AS restored FROM customer")
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("restored"))
    scaled = regression.min_max_scale(df, ["restored"])
    return regression.min_max_inverse(scaled, ["restored"], df).select("c_custkey", r("restored", 4))


@query("standard_scale", f"WITH {_RANGE} SELECT c_custkey, round((c_acctbal - m) / s, 9) AS scaled FROM customer, s")
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("scaled"))
    return regression.standard_scale(df, ["scaled"]).select("c_custkey", r("scaled", 9))


_CODES = "codes AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT c_mktsegment FROM customer))"


@query("label_encode", f"WITH {_CODES} SELECT c_custkey, code FROM customer JOIN codes USING (c_mktsegment)")
def _(spark, sf):
    coded = cls.label_encode(table(spark, sf, "customer"), "c_mktsegment")
    return coded.select("c_custkey", F.col("c_mktsegment_code").alias("code"))


@query("one_hot", f"WITH {_CODES} SELECT c_custkey, k.c_mktsegment AS segment, CASE WHEN k.c_mktsegment = c.c_mktsegment THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS flag FROM customer c, codes k")
def _(spark, sf):
    coded, names = cls.encode(table(spark, sf, "customer"), "c_mktsegment")
    cells = [F.struct(F.lit(n).alias("segment"), F.get("c_mktsegment_onehot", F.lit(i)).alias("flag")) for i, n in enumerate(names)]
    return coded.select("c_custkey", F.inline(F.array(*cells)))


_PCA = """x AS (SELECT l_quantity AS a, l_extendedprice / 5000 AS b FROM lineitem), c AS (SELECT var_samp(a) AS v1, var_samp(b) AS v2, covar_samp(a, b) AS cv FROM x),
l AS (SELECT *, (v1 + v2) / 2 + sqrt(pow((v1 - v2) / 2, 2) + cv * cv) AS l1, (v1 + v2) / 2 - sqrt(pow((v1 - v2) / 2, 2) + cv * cv) AS l2 FROM c),
e AS (SELECT *, cv / sqrt(cv * cv + pow(l1 - v1, 2)) AS ax, (l1 - v1) / sqrt(cv * cv + pow(l1 - v1, 2)) AS bx FROM l),
g AS (SELECT *, CASE WHEN abs(ax) >= abs(bx) THEN sign(ax) ELSE sign(bx) END AS s1, CASE WHEN abs(bx) >= abs(ax) THEN sign(-bx) ELSE sign(ax) END AS s2 FROM e)"""


@query(
    "pca",
    f"""WITH {_PCA} SELECT CAST(1 AS INTEGER) AS component, round(l1 / (l1 + l2), 8) AS explained, round(l1 / (l1 + l2), 8) AS cumulative, 'a' AS "column", round(ax * s1, 8) AS loading FROM g
        UNION ALL SELECT 1, round(l1 / (l1 + l2), 8), round(l1 / (l1 + l2), 8), 'b', round(bx * s1, 8) FROM g
        UNION ALL SELECT 2, round(l2 / (l1 + l2), 8), 1.0, 'a', round(-bx * s2, 8) FROM g UNION ALL SELECT 2, round(l2 / (l1 + l2), 8), 1.0, 'b', round(ax * s2, 8) FROM g""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("a"), (F.col("l_extendedprice") / 5000).alias("b"))
    found = regression.Components(df, ["a", "b"], 2).table(spark)
    return found.select("component", r("explained", 8), r("cumulative", 8), "column", r("loading", 8))


@query(
    "regression_metrics",
    """WITH x AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 4500 AS p FROM lineitem)
       SELECT l_returnflag, round(avg(pow(y - p, 2)), 0) AS mse, round(sqrt(avg(pow(y - p, 2))), 4) AS rmse, round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)), 8) AS r2 FROM x GROUP BY 1""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 4500).alias("p"))
    found = metrics.regression_metrics(df, "y", "p", ["l_returnflag"])
    return found.select("l_returnflag", r("mse", 0), r("rmse", 4), r("r2", 8))


# Model selection over expanding folds ----------------------------------------------------------

_SPACE = {"alpha": [0.001, 0.1, 1.0, 1e10, 1e12, 1e14]}
_TRIED = {f"ridge alpha={s['alpha']:g}": s["alpha"] for s in regression.sampled_grid(_SPACE, 3)}


@query(
    "tuned_search",
    f"WITH RECURSIVE {cv_sql(_TRIED, 3)} SELECT model, round(avg(mae), 1) AS mae, round(avg(rmse), 1) AS rmse, count(*) AS folds FROM cv GROUP BY 1",
)
def _(spark, sf):
    means = regression.mean_scores(run_cv(spark, sf, _TRIED, folds=3))
    return means.select("model", r("mae", 1), r("rmse", 1), "folds").orderBy("mae", "model")


# Classification: document quality ----------------------------------------------------------------

_QUALITY = f"""q AS (SELECT doc_id, quality, ln(1 + n_chars) AS size, CAST(len(string_split(text, ' ')) AS DOUBLE) / (1 + n_chars) AS density, {_HASH42} < 0.2 AS is_test FROM labels JOIN documents USING (doc_id))"""
COLUMNS = ["size", "density"]


def quality(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.log(1 + F.col("n_chars")).alias("size"),
        (F.size(F.split("text", " ", -1)).cast("double") / (1 + F.col("n_chars"))).alias("density"),
    )
    df = docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return regression.train_test_mark(df, ["doc_id"], 0.2)


def _sides(spark, sf):
    data = cut(quality(spark, sf))
    return data.where(~F.col("is_test")), data.where("is_test")


def _classify(kind, scaled=False, **params):
    def run(spark, sf):
        train, test = _sides(spark, sf)
        if scaled:
            train, test = regression.standard_scale(train, COLUMNS, train), regression.standard_scale(test, COLUMNS, train)
        found = cls.fit_predict(kind, train, test, COLUMNS, "quality", ["doc_id", "quality"], **params)
        return found.withColumn("score", F.round("score", 6))

    return run


query("decision_tree_cls")(_classify("decision_tree_entropy"))
query("random_forest_cls")(_classify("random_forest"))
query("gbt_cls")(_classify("boosted"))
query("logistic_regression")(_classify("logistic"))
query("mlp_classify")(_classify("mlp", scaled=True))


@query(
    "gaussian_nb",
    f"""WITH {_QUALITY}, t AS (SELECT * FROM q WHERE NOT is_test), eps AS (SELECT greatest(var_pop(size), var_pop(density)) * 1e-9 AS e, count(*) AS n FROM t),
        k AS (SELECT quality AS c, count(*) AS n, avg(size) AS m1, var_pop(size) AS v1, avg(density) AS m2, var_pop(density) AS v2 FROM t GROUP BY 1),
        j AS (SELECT doc_id, q.quality, c, ln(k.n / eps.n) - ln(2 * pi() * (v1 + e)) / 2 - pow(size - m1, 2) / (2 * (v1 + e)) - ln(2 * pi() * (v2 + e)) / 2 - pow(density - m2, 2) / (2 * (v2 + e)) AS lp FROM q, k, eps WHERE is_test)
        SELECT doc_id, quality, arg_max(c, lp) AS prediction, round(sum(CASE WHEN c = 1 THEN exp(lp) ELSE 0 END) / sum(exp(lp)), 6) AS score FROM j GROUP BY 1, 2""",
)
def _(spark, sf):
    train, test = _sides(spark, sf)
    found = cls.gaussian_nb(train, test, COLUMNS, "quality", ["doc_id", "quality"])
    return found.withColumn("score", F.round("score", 6))


_SCALED = f"""{_QUALITY}, s AS (SELECT min(size) AS a, max(size) AS b, min(density) AS c, max(density) AS d FROM q WHERE NOT is_test),
z AS (SELECT doc_id, quality, is_test, (size - a) / (b - a) AS x1, (density - c) / (d - c) AS x2 FROM q, s)"""


def _scaled_sides(spark, sf):
    train, test = _sides(spark, sf)
    return cut(regression.min_max_scale(train, COLUMNS, train)), cut(regression.min_max_scale(test, COLUMNS, train))


@query(
    "knn_classify",
    f"""WITH {_SCALED}, n AS (SELECT a.doc_id, b.quality AS vote, row_number() OVER (PARTITION BY a.doc_id ORDER BY round(-(0.0 + pow(a.x1 - b.x1, 2) + pow(a.x2 - b.x2, 2)), 9) DESC, b.doc_id) AS rank FROM z a JOIN z b ON a.is_test AND NOT b.is_test),
        v AS (SELECT doc_id, vote, count(*) AS n FROM n WHERE rank <= 3 GROUP BY 1, 2) SELECT doc_id, vote AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, vote) = 1""",
)
def _(spark, sf):
    train, test = _scaled_sides(spark, sf)
    return cls.knn_classify(train, test, "doc_id", COLUMNS, "quality", 3)


@query(
    "knn_accuracy_curve",
    f"""WITH {_SCALED}, n AS (SELECT a.doc_id, a.quality AS truth, b.quality AS vote, row_number() OVER (PARTITION BY a.doc_id ORDER BY round(-(0.0 + pow(a.x1 - b.x1, 2) + pow(a.x2 - b.x2, 2)), 9) DESC, b.doc_id) AS rank FROM z a JOIN z b ON a.is_test AND NOT b.is_test),
        v AS (SELECT k, doc_id, truth, vote, count(*) AS n FROM n, (SELECT CAST(unnest(range(1, 31)) AS INTEGER) AS k) WHERE rank <= k GROUP BY ALL),
        p AS (SELECT k, doc_id, truth, vote FROM v QUALIFY row_number() OVER (PARTITION BY k, doc_id ORDER BY n DESC, vote) = 1)
        SELECT k, round(avg(CASE WHEN truth = vote THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM p GROUP BY 1""",
)
def _(spark, sf):
    train, test = _scaled_sides(spark, sf)
    return cls.knn_curve(train, test, "doc_id", COLUMNS, "quality", 30).select("k", r("accuracy", 6))


_TOXIC = f"""q AS (SELECT doc_id, toxic, ln(1 + n_chars) AS size, CAST(len(string_split(text, ' ')) AS DOUBLE) / (1 + n_chars) AS density FROM labels JOIN documents USING (doc_id)),
sc AS (SELECT min(size) AS a, max(size) AS b, min(density) AS c, max(density) AS d FROM q), z AS (SELECT doc_id, toxic, (size - a) / (b - a) AS x1, (density - c) / (d - c) AS x2 FROM q, sc), m AS (SELECT * FROM z WHERE toxic = 1)"""


@query(
    "smote",
    f"""WITH {_TOXIC}, n AS (SELECT a.doc_id, b.doc_id AS nb, row_number() OVER (PARTITION BY a.doc_id ORDER BY round(-(0.0 + pow(a.x1 - b.x1, 2) + pow(a.x2 - b.x2, 2)), 9) DESC, b.doc_id) AS rank FROM m a JOIN m b ON a.doc_id <> b.doc_id),
        near AS (SELECT doc_id, list(nb ORDER BY rank) AS near FROM n WHERE rank <= 5 GROUP BY 1),
        need AS (SELECT count(*) FILTER (toxic <> 1) - count(*) FILTER (toxic = 1) AS need, count(*) FILTER (toxic = 1) AS have FROM z),
        pos AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS place FROM m),
        cp AS (SELECT doc_id, CAST(unnest(range(0, CAST(floor((need - place) / have) AS BIGINT) + 1)) AS BIGINT) AS copy FROM pos, need WHERE need >= place),
        pk AS (SELECT doc_id, copy, near[1 + CAST(floor({_U.format("'42', CAST(doc_id AS VARCHAR), CAST(copy AS VARCHAR), 'pick'")} * len(near)) AS BIGINT)] AS nb, {_U.format("'42', CAST(doc_id AS VARCHAR), CAST(copy AS VARCHAR), 'along'")} AS u FROM cp JOIN near USING (doc_id))
        SELECT a.doc_id AS base_key, copy, nb AS neighbour_key, round(a.x1 + u * (b.x1 - a.x1), 9) AS size, round(a.x2 + u * (b.x2 - a.x2), 9) AS density, CAST(1 AS INTEGER) AS toxic FROM pk JOIN m a ON pk.doc_id = a.doc_id JOIN m b ON pk.nb = b.doc_id""",
)
def _(spark, sf):
    docs = quality(spark, sf).select("doc_id", *COLUMNS).join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    data = cut(regression.min_max_scale(docs, COLUMNS))
    made = cls.smote(data, "doc_id", COLUMNS, "toxic", 1, 5)
    return made.select("base_key", "copy", "neighbour_key", r("size", 9), r("density", 9), "toxic")


# Predictions by two rules stand in for two models in the metric queries.
_RULES = f"""{_QUALITY}, d AS (SELECT avg(size) AS ms, avg(density) AS md FROM q), rules AS (SELECT 'long' AS model, doc_id, quality, CAST(size > ms AS INTEGER) AS prediction, round(size, 3) AS score FROM q, d
  UNION ALL SELECT 'dense', doc_id, quality, CAST(density > md AS INTEGER), round(density, 3) FROM q, d)"""
_CELLS = """cells AS (SELECT model, count(*) FILTER (quality = 1 AND prediction = 1) AS tp, count(*) FILTER (quality = 0 AND prediction = 1) AS fp, count(*) FILTER (quality = 1 AND prediction = 0) AS fn, count(*) FILTER (quality = 0 AND prediction = 0) AS tn FROM rules GROUP BY 1)"""
_AUC = """auc AS (SELECT model, sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END) / count(*) AS auc FROM rules p JOIN rules n USING (model) WHERE p.quality = 1 AND n.quality = 0 GROUP BY 1)"""
_CLS = """round((tp + tn) / (tp + fp + fn + tn), 8) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 8) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 8) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 8) AS f1, tp + fn AS support"""


def _rules(spark, sf):
    df = quality(spark, sf)
    means = df.agg(F.avg("size").alias("ms"), F.avg("density").alias("md"))
    rule = lambda column, mean: df.select(
        "doc_id", "quality", (F.col(column) > means.select(mean).scalar()).cast("int").alias("prediction"), F.round(column, 3).alias("score")
    )
    return metrics.union_named({"long": rule("size", "ms"), "dense": rule("density", "md")})


def _rated(df):
    return [r(c, 8) for c in ("accuracy", "precision", "recall", "f1")]


@query("classification_metrics", f"WITH {_RULES}, {_CELLS} SELECT model, {_CLS} FROM cells")
def _(spark, sf):
    found = metrics.classification_metrics(_rules(spark, sf), "quality", "prediction", ["model"])
    return found.select("model", *_rated(found), "support")


@query(
    "classification_report",
    f"""WITH {_RULES}, l AS (SELECT * FROM rules WHERE model = 'long'), k AS (SELECT unnest([0, 1]) AS class),
        c AS (SELECT class, count(*) FILTER (quality = class) AS support, count(*) FILTER (prediction = class) AS claimed, count(*) FILTER (quality = class AND prediction = class) AS hit FROM l, k GROUP BY 1)
        SELECT class, round(hit / claimed, 8) AS precision, round(hit / support, 8) AS recall, round(2 * hit / (claimed + support), 8) AS f1, support FROM c""",
)
def _(spark, sf):
    found = metrics.per_class_report(_rules(spark, sf).where("model = 'long'"), "quality", "prediction")
    return found.select("class", r("precision", 8), r("recall", 8), r("f1", 8), "support")


@query("roc_auc", f"WITH {_RULES}, {_AUC} SELECT model, round(auc, 8) AS auc FROM auc")
def _(spark, sf):
    return metrics.roc_auc(_rules(spark, sf), "quality", "score", ["model"]).select("model", r("auc", 8))


@query(
    "confusion_matrix",
    f"WITH {_RULES} SELECT quality AS actual, count(*) FILTER (prediction = 0) AS predicted_0, count(*) FILTER (prediction = 1) AS predicted_1 FROM rules WHERE model = 'long' GROUP BY 1",
)
def _(spark, sf):
    return metrics.confusion_matrix(_rules(spark, sf).where("model = 'long'"), "quality", "prediction", [0, 1])


@query("compare_models", f"WITH {_RULES}, {_CELLS}, {_AUC} SELECT model, {_CLS}, round(auc, 8) AS auc FROM cells JOIN auc USING (model)")
def _(spark, sf):
    df = _rules(spark, sf)
    found = metrics.classification_metrics(df, "quality", "prediction", ["model"])
    auc = metrics.roc_auc(df, "quality", "score", ["model"])
    return found.join(auc, "model").select("model", *_rated(found), "support", r("auc", 8))


@query("grid_search")
def _(spark, sf):
    data = cut(quality(spark, sf))
    _, scores = cls.cross_validated("decision_tree", data, COLUMNS, "quality", "doc_id", {"maxDepth": [2, 4], "impurity": ["gini", "entropy"]}, folds=3)
    return scores


@query("cross_val_score")
def _(spark, sf):
    data = cut(quality(spark, sf))
    _, scores = cls.cross_validated("logistic", data, COLUMNS, "quality", "doc_id", folds=5)
    return scores
