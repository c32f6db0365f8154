"""Aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.functions.labels import status_label
from harborline.operators import aggregates as agg
from harborline.operators import cash
from harborline.operators import panel as grids
from harborline.operators.columns import right_closed_bins
from harborline.operators.quantiles import medians
from harborline.plans.join_queries import _GRID
from harborline.plans.registry import query
from harborline.plans.tables import HOURLY, PANEL, SALES, daily_panel, hourly, panel, sales, table


def r(column, digits, name=None):
    return F.round(column, digits).alias(name or column)


@query(
    "agg_global",
    """SELECT round(sum(l_extendedprice), 2) AS total, round(avg(l_extendedprice), 6) AS mean, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
              min(l_extendedprice) AS low, max(l_extendedprice) AS high, round(stddev_pop(l_extendedprice), 4) AS std,
              round(var_pop(l_extendedprice), 1) AS var, count(*) AS n FROM lineitem""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_extendedprice")
    v = "l_extendedprice"
    middle = medians(df, [v]).select(v).scalar()
    return df.agg(
        r(F.sum(v), 2, "total"), r(F.avg(v), 6, "mean"), F.min(v).alias("low"), F.max(v).alias("high"),
        r(F.stddev_pop(v), 4, "std"), r(F.var_pop(v), 1, "var"), F.count(F.lit(1)).alias("n"),
    ).withColumn("median", F.round(middle, 4))


@query("agg_group", "SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        r(F.sum("o_totalprice"), 2, "total"), r(F.avg("o_totalprice"), 4, "mean"), F.count(F.lit(1)).alias("n")
    )


@query(
    "agg_group_multi",
    f"""WITH {SALES} SELECT CAST(year(sale_date) AS INTEGER) AS year, product, round(sum(revenue), 2) AS revenue, sum(quantity) AS quantity,
        round(avg(discount), 6) AS mean_discount, max(revenue) AS best FROM sales GROUP BY 1, 2""",
)
def _(spark, sf):
    return (
        sales(spark, sf)
        .groupBy(F.year("sale_date").alias("year"), "product")
        .agg(r(F.sum("revenue"), 2, "revenue"), F.sum("quantity").alias("quantity"), r(F.avg("discount"), 6, "mean_discount"), F.max("revenue").alias("best"))
    )


@query(
    "agg_scaled_rounded",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, round_even(sum(l_extendedprice) / 1e6, 2) AS sum_then_round,
              round(sum(round_even(l_extendedprice / 1e6, 2)), 2) AS round_then_sum FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.groupBy(F.year("l_shipdate").alias("year")).agg(
        agg.in_millions(F.sum("l_extendedprice")).alias("sum_then_round"),
        r(F.sum(agg.in_millions(F.col("l_extendedprice"))), 2, "round_then_sum"),
    )


@query("agg_abs_sum", "SELECT l_returnflag, round(sum(abs(-l_discount * l_extendedprice)), 2) AS discount_amount FROM lineitem GROUP BY 1")
def _(spark, sf):
    amount = -F.col("l_discount") * F.col("l_extendedprice")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(r(F.sum(F.abs(amount)), 2, "discount_amount"))


@query("agg_custom", "SELECT l_returnflag, l_linestatus, max(l_extendedprice) - min(l_extendedprice) AS spread FROM lineitem GROUP BY 1, 2")
def _(spark, sf):
    v = "l_extendedprice"
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg((F.max(v) - F.min(v)).alias("spread"))


@query(
    "having_sum",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING sum(o_totalprice) > 2000000)",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return agg.rows_of_groups(df, ["o_custkey"], F.sum("o_totalprice") > 2_000_000)


@query(
    "having_count",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 12)",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return agg.rows_of_groups(df, ["o_custkey"], F.count(F.lit(1)) >= 12)


@query(
    "daily_aggregate",
    f"""WITH {HOURLY} SELECT tran_br_code, start_date, round(sum(TOTAL_DR), 2) AS daily_withdrawals, round(sum(TOTAL_CR), 2) AS daily_deposits,
        count(txn_hour) AS transaction_count, count(DISTINCT txn_hour) AS active_hour_count FROM hourly GROUP BY 1, 2""",
)
def _(spark, sf):
    return agg.daily_totals(hourly(spark, sf))


_NETWORK = f"""{HOURLY}, network AS (SELECT start_date, round(sum(TOTAL_DR), 2) AS daily_withdrawals, round(sum(TOTAL_CR), 2) AS daily_deposits,
  count(DISTINCT tran_br_code) AS active_branches, round(sum(TOTAL_CR) - sum(TOTAL_DR), 2) AS net_cash FROM hourly GROUP BY 1)"""


@query("network_daily", f"WITH {_NETWORK} SELECT * FROM network")
def _(spark, sf):
    return agg.network_daily(hourly(spark, sf))


@query(
    "weekday_profile",
    f"""WITH {_NETWORK} SELECT CAST(isodow(start_date) - 1 AS INTEGER) AS day_number, dayname(start_date) AS day_name,
        round(avg(daily_withdrawals), 4) AS daily_withdrawals, round(avg(daily_deposits), 4) AS daily_deposits FROM network GROUP BY 1, 2""",
)
def _(spark, sf):
    profile = agg.weekday_profile(agg.network_daily(hourly(spark, sf)), "start_date", ["daily_withdrawals", "daily_deposits"])
    return profile.select("day_number", "day_name", r("daily_withdrawals", 4), r("daily_deposits", 4))


@query(
    "monthly_trend",
    f"""WITH {PANEL} SELECT CAST(date_trunc('month', start_date) AS DATE) AS month, round(sum(daily_withdrawals), 2) AS withdrawals,
        round(sum(daily_deposits), 2) AS deposits, round(sum(transaction_count) / count(DISTINCT start_date), 6) AS mean_daily_rows FROM panel GROUP BY 1""",
)
def _(spark, sf):
    # Days first, so that the mean per day needs no distinct aggregate over the panel.
    days = panel(spark, sf).groupBy("start_date").agg(
        F.sum("daily_withdrawals").alias("w"), F.sum("daily_deposits").alias("d"), F.sum("transaction_count").alias("n")
    )
    return days.groupBy(F.to_date(F.date_trunc("month", "start_date")).alias("month")).agg(
        r(F.sum("w"), 2, "withdrawals"), r(F.sum("d"), 2, "deposits"), r(F.avg("n"), 6, "mean_daily_rows")
    )


@query(
    "weekend_compare",
    f"""WITH {PANEL} SELECT isodow(start_date) >= 6 AS weekend, round(avg(daily_withdrawals), 4) AS withdrawals, round(avg(daily_deposits), 4) AS deposits,
        count(*) AS days FROM panel GROUP BY 1""",
)
def _(spark, sf):
    return panel(spark, sf).groupBy((F.weekday("start_date") >= 5).alias("weekend")).agg(
        r(F.avg("daily_withdrawals"), 4, "withdrawals"), r(F.avg("daily_deposits"), 4, "deposits"), F.count(F.lit(1)).alias("days")
    )


@query("value_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def _(spark, sf):
    return agg.value_counts(table(spark, sf, "events"), "event_type")


@query("distinct_values", "SELECT DISTINCT p_brand, p_type FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_brand", "p_type").distinct()


@query("nunique", "SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_orderkey) AS orders FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_orderkey").alias("orders")
    )


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "pivot_sum",
    f"WITH {SALES} SELECT CAST(year(sale_date) AS INTEGER) AS year, "
    + ", ".join(f"coalesce(sum(CASE WHEN product = '{t}' THEN quantity END), 0) AS \"{t}\"" for t in _TYPES)
    + " FROM sales GROUP BY 1",
)
def _(spark, sf):
    return agg.pivot_sum(sales(spark, sf).withColumn("year", F.year("sale_date")), ["year"], "product", "quantity")


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    "pivot_count_by_date",
    "SELECT CAST(o_orderdate AS DATE) AS day, "
    + ", ".join(f"nullif(count(CASE WHEN o_orderpriority = '{p}' THEN 1 END), 0) AS \"{p}\"" for p in _PRIORITIES)
    + " FROM orders GROUP BY 1",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    return df.groupBy("day").pivot("o_orderpriority").agg(F.count(F.lit(1)))


_YEARLY = f"""{SALES}, yearly AS (SELECT CAST(year(sale_date) AS INTEGER) AS year, category, round(sum(revenue), 2) AS revenue FROM sales GROUP BY 1, 2)"""


def _yearly(spark, sf):
    return sales(spark, sf).groupBy(F.year("sale_date").alias("year"), "category").agg(r(F.sum("revenue"), 2, "revenue"))


@query("share_of_total", f"WITH {_YEARLY} SELECT year, category, round(revenue / sum(revenue) OVER (PARTITION BY year) * 100, 6) AS pct FROM yearly")
def _(spark, sf):
    return agg.share_of_total(_yearly(spark, sf), ["year"], "revenue", "pct").select("year", "category", r("pct", 6))


@query(
    "hier_counts",
    """WITH banded AS (SELECT o_orderpriority, CASE WHEN o_totalprice > 0 AND o_totalprice <= 50000 THEN '0-50000' WHEN o_totalprice > 50000 AND o_totalprice <= 200000 THEN '50000-200000'
                 WHEN o_totalprice > 200000 AND o_totalprice <= 400000 THEN '200000-400000' WHEN o_totalprice > 400000 AND o_totalprice <= 1000000 THEN '400000-1e+06' END AS band FROM orders),
       grid AS (SELECT * FROM (VALUES ('0-50000'), ('50000-200000'), ('200000-400000'), ('400000-1e+06')) b(band), (SELECT DISTINCT o_orderpriority FROM orders)),
       cells AS (SELECT g.band, g.o_orderpriority, count(b.band) AS n FROM grid g LEFT JOIN banded b USING (band, o_orderpriority) GROUP BY 1, 2)
       SELECT band, o_orderpriority, n, CAST(sum(n) OVER (PARTITION BY band) AS BIGINT) AS parent_n FROM cells""",
)
def _(spark, sf):
    edges = [0, 50000, 200000, 400000, 1000000]
    df = table(spark, sf, "orders").select("o_orderpriority", right_closed_bins(F.col("o_totalprice"), edges).alias("band"))
    names = [f"{a:g}-{b:g}" for a, b in zip(edges, edges[1:])]
    return agg.cell_counts(df, "band", names, "o_orderpriority")


@query(
    "bar_width_share",
    f"""WITH {SALES}, d AS (SELECT category, sum(discount * revenue) AS amount FROM sales GROUP BY 1)
        SELECT category, round(amount / (SELECT sum(amount) FROM d) * 0.5, 6) AS width FROM d""",
)
def _(spark, sf):
    df = sales(spark, sf).groupBy("category").agg(F.sum(F.col("discount") * F.col("revenue")).alias("amount"))
    total = df.agg(F.sum("amount")).scalar()
    return df.select("category", r(F.col("amount") / total * 0.5, 6, "width"))


@query("conditional_pct", "SELECT round(avg(CASE WHEN l_quantity BETWEEN 20 AND 30 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct FROM lineitem")
def _(spark, sf):
    inside = F.when(F.col("l_quantity").between(20, 30), 1.0).otherwise(0.0)
    return table(spark, sf, "lineitem").agg(r(F.avg(inside) * 100, 6, "pct"))


_MONTHLY = "monthly AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, round(sum(l_extendedprice), 2) AS amount FROM lineitem GROUP BY 1, 2)"


def _monthly(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(
        r(F.sum("l_extendedprice"), 2, "amount")
    )


@query(
    "matrix_row_col_agg",
    f"""WITH {_MONTHLY} SELECT 'year' AS axis, year AS position, round(sum(amount), 2) AS value FROM monthly GROUP BY 2
        UNION ALL SELECT 'month', month, round(avg(amount), 4) FROM monthly GROUP BY 2""",
)
def _(spark, sf):
    cells = _monthly(spark, sf)
    rows = cells.groupBy(F.col("year").alias("position")).agg(r(F.sum("amount"), 2, "value")).withColumn("axis", F.lit("year"))
    columns = cells.groupBy(F.col("month").alias("position")).agg(r(F.avg("amount"), 4, "value")).withColumn("axis", F.lit("month"))
    return rows.unionByName(columns)


@query("argmax_key", f"WITH {_MONTHLY} SELECT month, round(avg(amount), 4) AS mean FROM monthly GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def _(spark, sf):
    means = _monthly(spark, sf).groupBy("month").agg(F.avg("amount").alias("mean"))
    best = means.agg(F.max(F.struct("mean", (-F.col("month")).alias("earlier"))).alias("b"))
    return best.select((-F.col("b.earlier")).alias("month"), r(F.col("b.mean"), 4, "mean"))


@query("mode_value", "SELECT l_returnflag, l_quantity AS mode, n FROM (SELECT l_returnflag, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, l_quantity) = 1")
def _(spark, sf):
    return agg.modal_value(table(spark, sf, "lineitem"), "l_quantity", ["l_returnflag"])


@query(
    "moments",
    """WITH m AS (SELECT l_returnflag, l_extendedprice AS v, avg(l_extendedprice) OVER (PARTITION BY l_returnflag) AS mu FROM lineitem)
       SELECT l_returnflag, round(max(v) - min(v), 2) AS range, round(var_pop(v), 0) AS variance,
              round(avg(pow(v - mu, 3)) / pow(var_pop(v), 1.5), 8) AS skewness, round(avg(pow(v - mu, 4)) / pow(var_pop(v), 2) - 3, 8) AS kurtosis
       FROM m GROUP BY 1""",
)
def _(spark, sf):
    found = agg.moments(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return found.select("l_returnflag", r("range", 2), r("variance", 0), r("skewness", 8), r("kurtosis", 8))


_CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, " + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 8)") + " AS r FROM " + ("(SELECT 1)" if a == b else "lineitem")
        for a in _CORR
        for b in _CORR
    ),
)
def _(spark, sf):
    return agg.corr_matrix(table(spark, sf, "lineitem"), _CORR).select("a", "b", r("r", 8))


@query(
    "histogram",
    """WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, (max(o_totalprice) - min(o_totalprice)) / 30.0 AS step FROM orders),
       c AS (SELECT least(CAST(floor((o_totalprice - lo) / step) AS INTEGER), 29) AS bin, count(*) AS n FROM orders, e GROUP BY 1),
       b AS (SELECT CAST(unnest(generate_series(0, 29)) AS INTEGER) AS bin)
       SELECT b.bin, round(lo + b.bin * step, 4) AS low, round(lo + (b.bin + 1) * step, 4) AS high, coalesce(n, 0) AS n FROM e, b LEFT JOIN c ON b.bin = c.bin""",
)
def _(spark, sf):
    return agg.histogram(table(spark, sf, "orders"), "o_totalprice", 30).select("bin", r("low", 4), r("high", 4), "n")


_BOX = """q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
f AS (SELECT *, q1 - 0.5 * (q3 - q1) AS lo, q3 + 0.5 * (q3 - q1) AS hi FROM q)"""


@query(
    "box_stats",
    f"""WITH {_BOX} SELECT l_returnflag, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
          min(CASE WHEN l_extendedprice BETWEEN lo AND hi THEN l_extendedprice END) AS whisker_low, max(CASE WHEN l_extendedprice BETWEEN lo AND hi THEN l_extendedprice END) AS whisker_high,
          count(CASE WHEN NOT l_extendedprice BETWEEN lo AND hi THEN 1 END) AS outliers
        FROM lineitem JOIN f USING (l_returnflag) GROUP BY l_returnflag, q1, median, q3""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    found = agg.box_stats(df, "l_extendedprice", ["l_returnflag"], 0.5)
    return found.select("l_returnflag", r("q1", 4), r("median", 4), r("q3", 4), "whisker_low", "whisker_high", "outliers")


@query(
    "kde_curve",
    """WITH s AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, count(*) AS n, stddev_samp(c_acctbal) * pow(count(*), -0.2) AS h FROM customer),
       x AS (SELECT lo + (hi - lo) * (i / 49.0) AS x FROM s, (SELECT unnest(generate_series(0, 49)) AS i))
       SELECT round(x, 4) AS x, round(sum(exp(-0.5 * pow((x - c_acctbal) / h, 2))) / (min(n) * min(h) * sqrt(2 * pi())), 10) AS density FROM x, s, customer GROUP BY x""",
)
def _(spark, sf):
    return agg.kde_curve(table(spark, sf, "customer"), "c_acctbal").select(r("x", 4), r("density", 10))


@query(
    "coverage_by_branch",
    f"""WITH {_GRID}, c AS (SELECT tran_br_code, count(*) AS expected_days, count(daily_withdrawals) AS observed_days,
          min(CASE WHEN daily_withdrawals IS NOT NULL THEN start_date END) AS first_day, max(CASE WHEN daily_withdrawals IS NOT NULL THEN start_date END) AS last_day FROM full_panel GROUP BY 1)
        SELECT *, expected_days - observed_days AS missing_days, round_even(observed_days / expected_days * 100, 2) AS coverage_pct FROM c""",
)
def _(spark, sf):
    return grids.coverage_by_branch(grids.complete_grid(daily_panel(spark, sf)))


@query(
    "missing_combinations",
    f"""WITH {_GRID}, m AS (SELECT tran_br_code, start_date FROM full_panel WHERE daily_withdrawals IS NULL)
        SELECT 'branch' AS slice, CAST(tran_br_code AS VARCHAR) AS value, count(*) AS missing FROM m GROUP BY 2
        UNION ALL SELECT 'day_type', CASE WHEN isodow(start_date) >= 6 THEN 'weekend' ELSE 'weekday' END, count(*) FROM m GROUP BY 2
        UNION ALL SELECT 'month', strftime(start_date, '%Y-%m'), count(*) FROM m GROUP BY 2""",
)
def _(spark, sf):
    return grids.missing_breakdown(grids.complete_grid(daily_panel(spark, sf)))


FORECAST = f"""{PANEL}, forecast AS (
  SELECT tran_br_code AS branch_code, start_date AS forecast_date, daily_deposits AS predicted_deposits, daily_withdrawals AS predicted_withdrawals,
         daily_deposits - daily_withdrawals AS predicted_net_cash, greatest(daily_withdrawals - daily_deposits, 0) AS predicted_cash_requirement,
         CASE WHEN daily_withdrawals > daily_deposits THEN 'Shortage' WHEN daily_deposits > daily_withdrawals * 1.1 THEN 'Surplus' ELSE 'Balanced' END AS status
  FROM panel WHERE daily_deposits IS NOT NULL AND daily_withdrawals IS NOT NULL)"""


def forecast(spark, sf):
    """Panel days with both flows, in the shape of a forecast."""
    wd, dep = F.col("daily_withdrawals"), F.col("daily_deposits")
    return panel(spark, sf).where(wd.isNotNull() & dep.isNotNull()).select(
        F.col("tran_br_code").alias("branch_code"),
        F.col("start_date").alias("forecast_date"),
        dep.alias("predicted_deposits"),
        wd.alias("predicted_withdrawals"),
        (dep - wd).alias("predicted_net_cash"),
        F.greatest(wd - dep, F.lit(0.0)).alias("predicted_cash_requirement"),
        status_label(wd, dep).alias("status"),
    )


@query(
    "guidance_by_branch",
    f"""WITH {FORECAST}, g AS (SELECT branch_code, count(*) AS forecast_days, round(sum(predicted_deposits), 2) AS total_predicted_inflow, round(sum(predicted_withdrawals), 2) AS total_predicted_outflow,
          round(sum(predicted_net_cash), 2) AS total_predicted_net_cash, round(sum(predicted_cash_requirement), 2) AS total_predicted_cash_requirement, avg(predicted_deposits) AS ad,
          count(CASE WHEN status = 'Shortage' THEN 1 END) AS shortage_days, count(CASE WHEN status = 'Surplus' THEN 1 END) AS surplus_days, count(CASE WHEN status = 'Balanced' THEN 1 END) AS balanced_days FROM forecast GROUP BY 1),
        modes AS (SELECT branch_code, status FROM (SELECT branch_code, status, count(*) AS n FROM forecast GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY branch_code ORDER BY n DESC, status) = 1)
        SELECT g.* EXCLUDE (ad), status AS primary_status, CASE WHEN total_predicted_cash_requirement > 0 THEN 'Monitor closely and prepare for potential replenishment'
          WHEN total_predicted_net_cash > ad * 0.2 THEN 'Consider reallocating excess cash to branches with shortage' ELSE 'Maintain current cash levels' END AS recommendation
        FROM g JOIN modes USING (branch_code)""",
)
def _(spark, sf):
    return cash.guidance_by_branch(forecast(spark, sf))


@query(
    "forecast_kpis",
    f"""WITH {FORECAST} SELECT round(sum(predicted_deposits), 2) AS total_inflow, round(sum(predicted_withdrawals), 2) AS total_outflow, round(sum(predicted_net_cash), 2) AS total_net,
          round(sum(predicted_cash_requirement), 2) AS total_requirement, count(*) AS rows, round(avg(CASE WHEN status = 'Shortage' THEN 100.0 ELSE 0 END), 4) AS shortage_pct,
          round(avg(CASE WHEN status = 'Surplus' THEN 100.0 ELSE 0 END), 4) AS surplus_pct, round(avg(CASE WHEN status = 'Balanced' THEN 100.0 ELSE 0 END), 4) AS balanced_pct FROM forecast""",
)
def _(spark, sf):
    return cash.forecast_kpis(forecast(spark, sf))
