"""Cash operations and incremental totals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from harborline.operators import aggregates as agg
from harborline.operators import cash
from harborline.operators import panel as grids
from harborline.operators.quantiles import quantile_columns
from harborline.plans.aggregate_queries import r
from harborline.plans.join_queries import _GRID
from harborline.plans.registry import query
from harborline.plans.tables import HOURLY, PANEL, daily_panel, hourly, panel, table
from harborline.sources.readers import rows
from harborline.session import scratch_path
from harborline.streaming import feeds


@query("peak_hours", f"WITH {HOURLY} SELECT txn_hour, round(sum(TOTAL_DR), 2) AS withdrawals, round(sum(TOTAL_CR), 2) AS deposits, count(*) AS rows FROM hourly GROUP BY 1")
def _(spark, sf):
    return hourly(spark, sf).groupBy("txn_hour").agg(
        r(F.sum("TOTAL_DR"), 2, "withdrawals"), r(F.sum("TOTAL_CR"), 2, "deposits"), F.count(F.lit(1)).alias("rows")
    )


@query("branch_performance", f"WITH {PANEL} SELECT tran_br_code, round(sum(daily_withdrawals), 2) AS withdrawals, round(sum(daily_deposits), 2) AS deposits, CAST(sum(transaction_count) AS BIGINT) AS transactions FROM panel GROUP BY 1")
def _(spark, sf):
    return panel(spark, sf).groupBy("tran_br_code").agg(
        r(F.sum("daily_withdrawals"), 2, "withdrawals"), r(F.sum("daily_deposits"), 2, "deposits"), F.sum("transaction_count").alias("transactions")
    )


@query(
    "branch_net_position",
    f"WITH {PANEL} SELECT tran_br_code, round(sum(daily_deposits) - sum(daily_withdrawals), 2) AS net, CASE WHEN sum(daily_deposits) >= sum(daily_withdrawals) THEN 'surplus' ELSE 'deficit' END AS position FROM panel GROUP BY 1",
)
def _(spark, sf):
    net = F.sum("daily_deposits") - F.sum("daily_withdrawals")
    return panel(spark, sf).groupBy("tran_br_code").agg(
        r(net, 2, "net"), F.when(net >= 0, "surplus").otherwise("deficit").alias("position")
    )


@query(
    "hourly_box",
    f"""WITH {HOURLY}, q AS (SELECT txn_hour, quantile_cont(TOTAL_DR, 0.25) AS q1, quantile_cont(TOTAL_DR, 0.5) AS median, quantile_cont(TOTAL_DR, 0.75) AS q3 FROM hourly GROUP BY 1)
        SELECT txn_hour, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(min(CASE WHEN TOTAL_DR BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN TOTAL_DR END), 4) AS whisker_low,
          round(max(CASE WHEN TOTAL_DR BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN TOTAL_DR END), 4) AS whisker_high, count(CASE WHEN NOT TOTAL_DR BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
        FROM hourly JOIN q USING (txn_hour) GROUP BY txn_hour, q1, median, q3""",
)
def _(spark, sf):
    found = agg.box_stats(hourly(spark, sf).select("txn_hour", "TOTAL_DR"), "TOTAL_DR", ["txn_hour"])
    return found.select("txn_hour", *[r(c, 4) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "outliers")


@query(
    "branch_hour_heatmap",
    f"WITH {HOURLY} SELECT tran_br_code, " + ", ".join(f"round(coalesce(sum(CASE WHEN txn_hour = {h} THEN TOTAL_DR END), 0), 2) AS h{h}" for h in range(24)) + " FROM hourly GROUP BY 1",
)
def _(spark, sf):
    wide = agg.pivot_sum(hourly(spark, sf), ["tran_br_code"], "txn_hour", "TOTAL_DR", list(range(24)))
    return wide.select("tran_br_code", *[r(f"`{h}`", 2, f"h{h}") for h in range(24)])


@query(
    "deficit_frequency",
    f"""WITH {PANEL}, n AS (SELECT tran_br_code, start_date, coalesce(daily_deposits, 0) - coalesce(daily_withdrawals, 0) AS net FROM panel),
        w AS (SELECT *, sum(net) OVER (PARTITION BY tran_br_code ORDER BY start_date ROWS 6 PRECEDING) AS week_net FROM n)
        SELECT tran_br_code, count(*) FILTER (net < 0) AS deficit_days, round(avg(-net) FILTER (net < 0), 4) AS mean_deficit, round(max(-net) FILTER (net < 0), 2) AS worst_deficit, round(min(week_net), 2) AS worst_week FROM w GROUP BY 1""",
)
def _(spark, sf):
    net = F.coalesce("daily_deposits", F.lit(0.0)) - F.coalesce("daily_withdrawals", F.lit(0.0))
    week = Window.partitionBy("tran_br_code").orderBy("start_date").rowsBetween(-6, 0)
    df = panel(spark, sf).withColumn("net", net).withColumn("week_net", F.sum("net").over(week))
    short = F.when(F.col("net") < 0, -F.col("net"))
    return df.groupBy("tran_br_code").agg(
        F.count(short).alias("deficit_days"), r(F.avg(short), 4, "mean_deficit"), r(F.max(short), 2, "worst_deficit"), r(F.min("week_net"), 2, "worst_week")
    )


_SEASONAL = f"""WITH {PANEL}, d AS (SELECT start_date, coalesce(sum(daily_withdrawals), 0) AS v FROM panel GROUP BY 1),
t AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN avg(v) OVER w END AS trend, isodow(start_date) AS dow FROM d WINDOW w AS (ORDER BY start_date RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND INTERVAL 3 DAYS FOLLOWING)),
s AS (SELECT dow, avg(v - trend) AS s FROM t GROUP BY 1), c AS (SELECT dow, s - (SELECT avg(s) FROM s) AS seasonal FROM s)"""


@query(
    "seasonal_decompose",
    _SEASONAL + " SELECT start_date, round(v, 2) AS observed, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal, round(v - trend - seasonal, 4) AS residual FROM t JOIN c USING (dow)",
)
def _(spark, sf):
    daily = panel(spark, sf).groupBy("start_date").agg(F.coalesce(F.sum("daily_withdrawals"), F.lit(0.0)).alias("v"))
    found = cash.seasonal_decompose(daily, "start_date", "v")
    return found.select("start_date", r("v", 2, "observed"), r("trend", 4), r("seasonal", 4), r("residual", 4))


_EVENTS = [(dt.date(y, 1, 1), "New Year") for y in range(1995, 2002)] + [(dt.date(y, 12, 25), "Year end holiday") for y in range(1995, 2002)]
_EVENT_SQL = "ev AS (SELECT * FROM (VALUES " + ", ".join(f"(DATE '{d}', '{n}')" for d, n in _EVENTS) + ") t(start_date, event_name))"


@query(
    "holiday_salary_flags",
    f"""WITH {PANEL}, {_EVENT_SQL} SELECT tran_br_code, start_date, event_name, CAST(event_name IS NOT NULL AS INTEGER) AS is_holiday, CAST(day(start_date) IN (1, 25) AS INTEGER) AS is_salary_day,
        CAST(day(start_date) BETWEEN 0 AND 2 OR day(start_date) BETWEEN 24 AND 26 AS INTEGER) AS is_salary_window FROM panel LEFT JOIN ev USING (start_date)""",
)
def _(spark, sf):
    calendar = rows(spark, _EVENTS, "event_date date, event_name string")
    days = panel(spark, sf).select("tran_br_code", "start_date")
    return cash.event_flags(days, "start_date", calendar, [1, 25])


@query(
    "spike_flag",
    f"""WITH {_GRID}, l AS (SELECT tran_br_code, start_date, daily_withdrawals AS v, avg(daily_withdrawals) OVER w + 2 * stddev_samp(daily_withdrawals) OVER w AS spike_limit FROM full_panel
          WINDOW w AS (PARTITION BY tran_br_code ORDER BY start_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
        SELECT tran_br_code, start_date, round(spike_limit, 3) AS spike_limit, CAST(coalesce(v > spike_limit, false) AS INTEGER) AS is_spike FROM l""",
)
def _(spark, sf):
    found = cash.spike_flag(grids.complete_grid(daily_panel(spark, sf)), ["tran_br_code"], "start_date", "daily_withdrawals")
    return found.select("tran_br_code", "start_date", r("spike_limit", 3), "is_spike")


_SHARES = f"""{HOURLY}, sh AS (SELECT tran_br_code, coalesce(sum(CASE WHEN txn_hour < 12 THEN TOTAL_DR ELSE 0 END) / nullif(sum(TOTAL_DR), 0), 0.5) AS s FROM hourly WHERE start_date < DATE '2024-01-20' GROUP BY 1),
dd AS (SELECT tran_br_code, start_date, round(sum(TOTAL_DR), 2) AS v FROM hourly GROUP BY 1, 2)"""


@query("ampm_allocation", f"WITH {_SHARES} SELECT tran_br_code, start_date, round(v * coalesce(s, 0.5), 2) AS am, round(v - round(v * coalesce(s, 0.5), 2), 2) AS pm FROM dd LEFT JOIN sh USING (tran_br_code)")
def _(spark, sf):
    feed = hourly(spark, sf)
    # Shares come from the training days only.
    shares = cash.morning_shares(feed.where(F.col("start_date") < F.lit(dt.date(2024, 1, 20))), ["tran_br_code"], "txn_hour", "TOTAL_DR")
    daily = feed.groupBy("tran_br_code", "start_date").agg(r(F.sum("TOTAL_DR"), 2, "v"))
    return cash.allocate_half_days(daily, shares, ["tran_br_code"], "v").select("tran_br_code", "start_date", "am", "pm")


_RESIDUALS = f"""{_GRID}, p AS (SELECT tran_br_code, start_date, daily_withdrawals AS v, avg(daily_withdrawals) OVER (PARTITION BY tran_br_code ORDER BY start_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS pred FROM full_panel)"""


def _predicted(spark, sf):
    df = grids.add_rolling(grids.complete_grid(daily_panel(spark, sf)), ["daily_withdrawals"], (7,))
    return df.select("tran_br_code", "start_date", F.col("daily_withdrawals").alias("v"), F.col("daily_withdrawals_7p_rolling_mean").alias("pred"))


@query(
    "prediction_interval",
    f"""WITH {_RESIDUALS}, b AS (SELECT tran_br_code, quantile_cont(v - pred, 0.05) AS lo, quantile_cont(v - pred, 0.95) AS hi FROM p WHERE start_date < DATE '2001-01-01' GROUP BY 1)
        SELECT tran_br_code, start_date, round(pred, 6) AS pred, round(greatest(pred + lo, 0), 6) AS lower, round(greatest(pred + hi, 0), 6) AS upper FROM p JOIN b USING (tran_br_code) WHERE start_date >= DATE '2001-01-01' AND pred IS NOT NULL""",
)
def _(spark, sf):
    df, from_day = _predicted(spark, sf), F.lit(dt.date(2001, 1, 1))
    past = df.where(F.col("start_date") < from_day).withColumn("residual", F.col("v") - F.col("pred"))
    bounds = cash.residual_bounds(past, "residual", 0.05, 0.95, ["tran_br_code"])
    coming = df.where((F.col("start_date") >= from_day) & F.col("pred").isNotNull())
    found = cash.prediction_interval(coming, bounds, "pred", ["tran_br_code"])
    return found.select("tran_br_code", "start_date", r("pred", 6), r("lower", 6), r("upper", 6))


# Branch operations are derived from the suppliers of a nation, for want of a branch table.
_OPS = f"""WITH {PANEL}, u AS (SELECT tran_br_code, quantile_cont(daily_withdrawals, 0.95) AS upper_demand FROM panel GROUP BY 1),
o AS (SELECT s_nationkey AS tran_br_code, round(sum(greatest(s_acctbal, 0)), 2) AS opening_cash, 10000.0 AS minimum_reserve, 1000000.0 AS vault_capacity, CAST(1 + s_nationkey % 3 AS INTEGER) AS lead_days, 250.0 AS order_cost FROM supplier GROUP BY 1, 5),
x AS (SELECT *, upper_demand * lead_days + minimum_reserve - opening_cash AS gap, greatest(vault_capacity - opening_cash, 0) AS room FROM u JOIN o USING (tran_br_code))"""


def _operations(spark, sf):
    return table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("tran_br_code")).agg(
        r(F.sum(F.greatest("s_acctbal", F.lit(0.0))), 2, "opening_cash")
    ).withColumns(
        {
            "minimum_reserve": F.lit(10000.0), "vault_capacity": F.lit(1000000.0), "order_cost": F.lit(250.0),
            "lead_days": (1 + F.col("tran_br_code") % 3).cast("int"),
        }
    )


@query(
    "replenishment",
    _OPS + " SELECT tran_br_code, round(greatest(least(gap, room), 0), 2) AS order_amount, round(greatest(gap - room, 0), 2) AS uncovered, CASE WHEN greatest(least(gap, room), 0) > 0 THEN 250.0::DOUBLE ELSE 0.0::DOUBLE END AS cost FROM x",
)
def _(spark, sf):
    needs = quantile_columns(panel(spark, sf), ["daily_withdrawals"], {"upper_demand": 0.95}, ["tran_br_code"]).drop("column")
    found = cash.replenishment(needs, _operations(spark, sf), ["tran_br_code"])
    return found.select("tran_br_code", "order_amount", "uncovered", "cost")


@query(
    "risk_branches",
    f"""WITH {PANEL}, b AS (SELECT tran_br_code, coalesce(sum(daily_withdrawals), 0) AS wd, coalesce(sum(daily_deposits), 0) AS dep, avg(CASE WHEN coalesce(daily_withdrawals, 0) > coalesce(daily_deposits, 0) THEN 1.0 ELSE 0.0 END) AS short_share FROM panel GROUP BY 1), m AS (SELECT avg(wd) AS mw FROM b),
        f AS (SELECT tran_br_code, CAST(wd > mw * 1.1 AS INTEGER) AS high_withdrawal, CAST(dep > wd * 0.45 AS INTEGER) AS idle_cash, CAST(short_share > 0.85 AS INTEGER) AS shortage_risk FROM b, m)
        SELECT *, high_withdrawal + idle_cash + shortage_risk AS risks FROM f""",
)
def _(spark, sf):
    wd, dep = F.coalesce("daily_withdrawals", F.lit(0.0)), F.coalesce("daily_deposits", F.lit(0.0))
    per = panel(spark, sf).groupBy("tran_br_code").agg(
        F.sum(wd).alias("wd"), F.sum(dep).alias("dep"), F.avg((wd > dep).cast("double")).alias("short_share")
    )
    mean = per.agg(F.avg("wd")).scalar()
    found = cash.risk_branches(
        per, F.col("wd") > mean * 1.1, F.col("dep") > F.col("wd") * 0.45, F.col("short_share") > 0.85
    )
    return found.select("tran_br_code", "high_withdrawal", "idle_cash", "shortage_risk", "risks")


_NET = f"""{PANEL}, n AS (SELECT start_date, tran_br_code, round(coalesce(daily_deposits, 0) - coalesce(daily_withdrawals, 0), 2) AS net FROM panel),
side AS (SELECT start_date, tran_br_code AS b, abs(net) AS size, net > 0 AS plus FROM n WHERE net <> 0),
iv AS (SELECT *, round(sum(size) OVER (PARTITION BY start_date, plus ORDER BY b ROWS UNBOUNDED PRECEDING), 2) AS hi FROM side), iw AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY start_date, plus ORDER BY b), 0) AS lo FROM iv)"""


@query(
    "redistribute",
    f"""WITH {_NET} SELECT s.start_date, s.b AS from_branch, d.b AS to_branch, round(least(s.hi, d.hi) - greatest(s.lo, d.lo), 2) AS transfer FROM iw s JOIN iw d ON s.start_date = d.start_date AND s.plus AND NOT d.plus
        WHERE least(s.hi, d.hi) > greatest(s.lo, d.lo)""",
)
def _(spark, sf):
    net = F.round(F.coalesce("daily_deposits", F.lit(0.0)) - F.coalesce("daily_withdrawals", F.lit(0.0)), 2)
    return cash.redistribute(panel(spark, sf).select("start_date", "tran_br_code", net.alias("net")), ["start_date"], "tran_br_code", "net")


def _event_feed(df):
    outgoing = F.col("event_type").isin("purchase", "error")
    return df.select(
        F.pmod("user_id", F.lit(15)).cast("int").alias("tran_br_code"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(outgoing, F.col("value")).otherwise(0.0).alias("dr"),
        F.when(outgoing, 0.0).otherwise(F.col("value")).alias("cr"),
    )


_FEED = """feed AS (SELECT CAST(user_id % 15 AS INTEGER) AS tran_br_code, ts, CASE WHEN event_type IN ('purchase','error') THEN value ELSE 0 END AS dr, CASE WHEN event_type IN ('purchase','error') THEN 0 ELSE value END AS cr FROM events)"""


@query(
    "half_day_totals",
    f"WITH {_FEED} SELECT tran_br_code, CAST(ts AS DATE) AS day, CASE WHEN hour(ts) < 12 THEN 'AM' ELSE 'PM' END AS half, round(sum(dr), 2) AS withdrawals, round(sum(cr), 2) AS deposits, count(*) AS rows FROM feed GROUP BY 1, 2, 3",
)
def _(spark, sf):
    totals = feeds.half_day_totals(_event_feed(table(spark, sf, "events")))
    return totals.select("tran_br_code", F.to_date("window_start").alias("day"), "half", r("withdrawals", 2), r("deposits", 2), "rows")


@query(
    "stream_daily",
    f"WITH {_FEED} SELECT tran_br_code, CAST(ts AS DATE) AS day, round(sum(dr), 2) AS withdrawals, round(sum(cr), 2) AS deposits, count(*) AS rows FROM feed GROUP BY 1, 2",
)
def _(spark, sf):
    schema = table(spark, sf, "events").schema
    feed = _event_feed(feeds.read_feed(spark, sf, schema, "events.parquet"))
    return feeds.stream_daily(feed).select("tran_br_code", F.to_date("window_start").alias("day"), r("withdrawals", 2), r("deposits", 2), "rows")


@query(
    "stream_late_repairs",
    f"WITH {_FEED} SELECT tran_br_code, CAST(ts AS DATE) AS day, round(sum(dr), 2) AS withdrawals, round(sum(cr), 2) AS deposits, count(*) AS rows FROM feed GROUP BY 1, 2",
)
def _(spark, sf):
    """The events in four files, each over all days and read as a batch of its own, so that most rows come late."""
    events = table(spark, sf, "events")
    folder = scratch_path(spark, "late-feed")
    events.repartition(4, "user_id").write.parquet(folder)
    feed = _event_feed(feeds.read_feed(spark, folder, events.schema, "*.parquet", files_per_batch=1))
    return feeds.stream_daily(feed, late="2 days").select("tran_br_code", F.to_date("window_start").alias("day"), r("withdrawals", 2), r("deposits", 2), "rows")
