"""Windows, sorting and top-k."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from harborline.operators import forecasting
from harborline.operators import panel as grids
from harborline.operators import windows as win
from harborline.operators.aggregates import group_total
from harborline.plans.aggregate_queries import r
from harborline.plans.join_queries import _GRID
from harborline.plans.registry import query
from harborline.plans.tables import PANEL, SALES, daily_panel, panel, sales, table

KEY = ["tran_br_code", "start_date"]


def _grid(spark, sf):
    return grids.complete_grid(daily_panel(spark, sf))


@query(
    "lag_calendar",
    f"WITH {_GRID} SELECT tran_br_code, start_date, "
    + ", ".join(f"lag({t}, {k}) OVER w AS {t}_{k}p_lag" for t in grids.TARGETS for k in grids.LAGS)
    + " FROM full_panel WINDOW w AS (PARTITION BY tran_br_code ORDER BY start_date)",
)
def _(spark, sf):
    lags = [f"{t}_{k}p_lag" for t in grids.TARGETS for k in grids.LAGS]
    return grids.add_lags(_grid(spark, sf)).select(*KEY, *lags)


_STATS = (("mean", "avg", 6), ("std", "stddev_samp", 3), ("min", "min", 2), ("max", "max", 2))


@query(
    "rolling_stats",
    f"WITH {_GRID} SELECT tran_br_code, start_date, "
    + ", ".join(
        f"round({fn}({t}) OVER w{k}, {d}) AS {t}_{k}p_rolling_{n}" for t in grids.TARGETS for k in grids.ROLLING for n, fn, d in _STATS
    )
    + " FROM full_panel WINDOW "
    + ", ".join(f"w{k} AS (PARTITION BY tran_br_code ORDER BY start_date ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)" for k in grids.ROLLING),
)
def _(spark, sf):
    columns = [r(f"{t}_{k}p_rolling_{n}", d) for t in grids.TARGETS for k in grids.ROLLING for n, _, d in _STATS]
    return grids.add_rolling(_grid(spark, sf)).select(*KEY, *columns)


@query(
    "baselines",
    f"WITH {_GRID} SELECT tran_br_code, start_date, "
    + ", ".join(
        f"lag({t}, 1) OVER w AS {t}_prev_period_baseline, lag({t}, 7) OVER w AS {t}_prev_week_baseline, round(avg({t}) OVER f, 4) AS {t}_roll7_avg_baseline"
        for t in grids.TARGETS
    )
    + " FROM full_panel WINDOW w AS (PARTITION BY tran_br_code ORDER BY start_date), f AS (PARTITION BY tran_br_code ORDER BY start_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)",
)
def _(spark, sf):
    df = grids.add_baselines(grids.add_rolling(grids.add_lags(_grid(spark, sf), lags=(1, 7)), windows=(7,)))
    names = [f"{t}_{b}_baseline" for t in grids.TARGETS for b in ("prev_period", "prev_week", "roll7_avg")]
    return df.select(*KEY, *[r(n, 4) if "roll7" in n else F.col(n) for n in names])


_DAILY = f"""{PANEL}, daily AS (SELECT start_date, round(coalesce(sum(daily_withdrawals), 0), 2) AS wd, round(coalesce(sum(daily_deposits), 0), 2) AS dep FROM panel GROUP BY 1),
flow AS (SELECT start_date, sum(wd) OVER w AS cwd, sum(dep) OVER w AS cdep FROM daily WINDOW w AS (ORDER BY start_date ROWS UNBOUNDED PRECEDING))"""


def _cumulative(spark, sf):
    daily = panel(spark, sf).groupBy("start_date").agg(
        F.round(F.coalesce(F.sum("daily_withdrawals"), F.lit(0.0)), 2).alias("wd"),
        F.round(F.coalesce(F.sum("daily_deposits"), F.lit(0.0)), 2).alias("dep"),
    )
    return win.running_total(daily, [], ["start_date"], F.date_trunc("month", "start_date"), {"cwd": "wd", "cdep": "dep"})


@query("cumulative_flow", f"WITH {_DAILY} SELECT start_date, round(cwd, 2) AS withdrawals, round(cdep, 2) AS deposits, round(cdep - cwd, 2) AS net FROM flow")
def _(spark, sf):
    return _cumulative(spark, sf).select(
        "start_date", r("cwd", 2, "withdrawals"), r("cdep", 2, "deposits"), r(F.col("cdep") - F.col("cwd"), 2, "net")
    )


@query("surplus_zone", f"WITH {_DAILY} SELECT start_date, CASE WHEN cdep > cwd THEN 'surplus' ELSE 'deficit' END AS zone FROM flow")
def _(spark, sf):
    zone = F.when(F.col("cdep") > F.col("cwd"), "surplus").otherwise("deficit")
    return _cumulative(spark, sf).select("start_date", zone.alias("zone"))


_MONTHS = f"""{SALES}, months AS (SELECT category, product, CAST(date_trunc('month', sale_date) AS DATE) AS month, round(sum(revenue), 2) AS revenue FROM sales GROUP BY 1, 2, 3),
pm AS (SELECT product, month, round(sum(revenue), 2) AS revenue FROM months GROUP BY 1, 2)"""


def _months(spark, sf):
    month = F.to_date(F.date_trunc("month", "sale_date")).alias("month")
    return sales(spark, sf).groupBy("category", "product", month).agg(r(F.sum("revenue"), 2, "revenue"))


def _product_months(spark, sf):
    month = F.to_date(F.date_trunc("month", "sale_date")).alias("month")
    return sales(spark, sf).groupBy("product", month).agg(r(F.sum("revenue"), 2, "revenue"))


@query("running_by_group", f"WITH {_MONTHS} SELECT product, month, round(sum(revenue) OVER (PARTITION BY product ORDER BY month ROWS UNBOUNDED PRECEDING), 2) AS running FROM pm")
def _(spark, sf):
    df = win.running_total(_product_months(spark, sf), ["product"], ["month"], F.year("month"), {"running": "revenue"})
    return df.select("product", "month", r("running", 2))


@query("rolling_n_group", f"WITH {_MONTHS} SELECT product, month, round(sum(revenue) OVER (PARTITION BY product ORDER BY month ROWS 2 PRECEDING), 2) AS rolling FROM pm")
def _(spark, sf):
    df = win.rolling_rows(_product_months(spark, sf), ["product"], ["month"], "revenue", 3, "rolling")
    return df.select("product", "month", r("rolling", 2))


@query(
    "rolling_n_category",
    f"WITH {_MONTHS} SELECT category, product, month, round(sum(revenue) OVER (PARTITION BY category ORDER BY month, product ROWS 2 PRECEDING), 2) AS rolling FROM months",
)
def _(spark, sf):
    df = win.rolling_rows(_months(spark, sf), ["category"], ["month", "product"], "revenue", 3, "rolling", F.col("month"))
    return df.select("category", "product", "month", r("rolling", 2))


@query(
    "prev_growth",
    f"""WITH {SALES}, y AS (SELECT product, CAST(year(sale_date) AS INTEGER) AS year, round(sum(revenue), 2) AS revenue FROM sales GROUP BY 1, 2), p AS (SELECT *, lag(revenue) OVER (PARTITION BY product ORDER BY year) AS previous FROM y)
        SELECT product, year, revenue, previous, round(coalesce((revenue - previous) / previous * 100, 0), 6) AS growth_pct FROM p""",
)
def _(spark, sf):
    yearly = sales(spark, sf).groupBy("product", F.year("sale_date").alias("year")).agg(r(F.sum("revenue"), 2, "revenue"))
    df = win.previous_growth(yearly, ["product"], "year", "revenue")
    return df.select("product", "year", "revenue", "previous", r("growth_pct", 6))


@query(
    "increase_flag",
    f"WITH {_MONTHS} SELECT product, month, coalesce(revenue > lag(revenue) OVER (PARTITION BY product ORDER BY month), false) AS increased FROM pm",
)
def _(spark, sf):
    return win.increase_flag(_product_months(spark, sf), ["product"], "month", "revenue").drop("revenue")


@query(
    "topn_per_group",
    """SELECT o_orderpriority, o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return win.top_n(df, ["o_orderpriority"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)


@query("group_transform", "SELECT o_orderkey, o_orderpriority, round(sum(o_totalprice) OVER (PARTITION BY o_orderpriority), 2) AS total FROM orders")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return group_total(df, ["o_orderpriority"], "o_totalprice", "total").select("o_orderkey", "o_orderpriority", r("total", 2))


@query(
    "recent_n",
    f"WITH {PANEL} SELECT tran_br_code, start_date, daily_withdrawals FROM panel QUALIFY row_number() OVER (PARTITION BY tran_br_code ORDER BY start_date DESC) <= 60",
)
def _(spark, sf):
    days = panel(spark, sf).select("tran_br_code", "start_date", "daily_withdrawals")
    return win.recent_n(days, ["tran_br_code"], "start_date", 60)


_ORIGIN = dt.date(2001, 1, 1)


@query(
    "rolling_forecast_features",
    f"WITH {PANEL} SELECT tran_br_code, "
    + ", ".join(
        f"round(avg(wd{k}), 4) AS daily_withdrawals_{k}p_rolling_mean, round(CASE WHEN count(wd{k}) > 0 THEN coalesce(stddev_samp(wd{k}), 0) END, 3) AS daily_withdrawals_{k}p_rolling_std, "
        f"min(wd{k}) AS daily_withdrawals_{k}p_rolling_min, max(wd{k}) AS daily_withdrawals_{k}p_rolling_max"
        for k in grids.ROLLING
    )
    + " FROM (SELECT tran_br_code, "
    + ", ".join(f"CASE WHEN start_date >= DATE '2001-01-01' - {k} THEN daily_withdrawals END AS wd{k}" for k in grids.ROLLING)
    + " FROM panel WHERE start_date < DATE '2001-01-01' AND start_date >= DATE '2001-01-01' - 30) GROUP BY 1",
)
def _(spark, sf):
    df = forecasting.rolling_at_origin(panel(spark, sf), F.lit(_ORIGIN), ["daily_withdrawals"], grids.ROLLING)
    digits = {"mean": 4, "std": 3, "min": 2, "max": 2}
    return df.select("tran_br_code", *[r(c, digits[c.rsplit("_", 1)[1]]) for c in df.columns if c != "tran_br_code"])


@query("sort_rows", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return df.orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query("limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 25")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(25)


@query("topk_global", f"WITH {SALES} SELECT product, category, round(sum(revenue), 2) AS revenue FROM sales GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10")
def _(spark, sf):
    totals = sales(spark, sf).groupBy("product", "category").agg(r(F.sum("revenue"), 2, "revenue"))
    return totals.orderBy(F.desc("revenue"), "product", "category").limit(10)
