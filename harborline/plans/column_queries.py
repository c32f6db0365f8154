"""Projection, filter, column editing, labels and formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.functions import labels
from harborline.operators import columns as ops
from harborline.plans.registry import query
from harborline.plans.tables import PANEL, panel, table, with_gaps
from harborline.sources.readers import rows


@query("project", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "filter_pred",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
       WHERE (l_quantity > 30 AND l_discount >= 0.05) OR (l_returnflag = 'R' AND l_tax < 0.02)""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem")
    keep = ((F.col("l_quantity") > 30) & (F.col("l_discount") >= 0.05)) | (
        (F.col("l_returnflag") == "R") & (F.col("l_tax") < 0.02)
    )
    return df.where(keep).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query(
    "derive_column",
    """SELECT l_orderkey, l_linenumber, round(l_quantity * (l_extendedprice / l_quantity), 2) AS revenue,
              round(l_extendedprice * 1.1, 4) AS raised, round(l_quantity * 9 / 5 + 32, 4) AS fahrenheit FROM lineitem""",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.col("l_quantity") * (F.col("l_extendedprice") / F.col("l_quantity")), 2).alias("revenue"),
        F.round(F.col("l_extendedprice") * 1.1, 4).alias("raised"),
        F.round(F.col("l_quantity") * 9 / 5 + 32, 4).alias("fahrenheit"),
    )


@query("rename_column", "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey FROM customer")
def _(spark, sf):
    return (
        table(spark, sf, "customer")
        .select("c_custkey", "c_name", "c_nationkey")
        .withColumnsRenamed({"c_custkey": "customer_id", "c_name": "customer_name"})
    )


@query("drop_columns", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").drop("o_custkey", "o_orderdate", "o_orderpriority")


@query("drop_null_columns", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(spark, sf):
    return ops.drop_null_columns(with_gaps(spark, sf))


@query(
    "split_columns_by_type",
    """WITH kinds AS (SELECT * FROM (VALUES ('c_custkey','numeric'),('c_name','categorical'),('c_nationkey','numeric'),
                                           ('c_acctbal','numeric'),('c_mktsegment','categorical')) t(column_name, kind)),
       filled AS (UNPIVOT (SELECT count(c_custkey) AS c_custkey, count(c_name) AS c_name, count(c_nationkey) AS c_nationkey,
                                  count(c_acctbal) AS c_acctbal, count(c_mktsegment) AS c_mktsegment FROM customer)
                  ON COLUMNS(*) INTO NAME column_name VALUE present)
       SELECT kind, column_name, present FROM kinds JOIN filled USING (column_name)""",
)
def _(spark, sf):
    df = table(spark, sf, "customer")
    kinds = ops.columns_by_type(df)
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
    cells = [
        F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("column_name"), F.col(c).alias("present"))
        for kind, names in kinds.items()
        for c in names
    ]
    return counted.select(F.inline(F.array(*cells)))


@query("loc_label", "SELECT c_mktsegment, c_custkey, c_acctbal FROM customer WHERE c_mktsegment IN ('FURNITURE','BUILDING')")
def _(spark, sf):
    df = table(spark, sf, "customer")
    return ops.rows_by_label(df, "c_mktsegment", ["FURNITURE", "BUILDING"], ["c_custkey", "c_acctbal"])


@query(
    "iloc_position",
    "SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn BETWEEN 11 AND 40",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ops.rows_by_position(df, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10, 40)


@query(
    "cond_update",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_extendedprice END AS l_extendedprice,
              CASE WHEN l_returnflag = 'R' THEN 'X' ELSE l_linestatus END AS l_linestatus FROM lineitem""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem")
    changed = ops.update_where(
        df, F.col("l_returnflag") == "R", {"l_extendedprice": F.lit(0.0), "l_linestatus": F.lit("X")}
    )
    return changed.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_linestatus")


@query(
    "insert_rows",
    """SELECT c_custkey, c_name, c_acctbal FROM customer
       UNION ALL SELECT -1, 'walk-in', CAST(NULL AS DOUBLE) UNION ALL SELECT -2, 'internal', 0.0""",
)
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    internal = rows(spark, [(-2, "internal", 0.0)], "c_custkey long, c_name string, c_acctbal double")
    walk_in = rows(spark, [(-1, "walk-in")], "c_custkey long, c_name string")
    return df.unionByName(internal).unionByName(walk_in, allowMissingColumns=True)


@query("delete_rows", "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'F')")
def _(spark, sf):
    return table(spark, sf, "orders").where(~(F.col("o_orderstatus") == "F")).select("o_orderkey", "o_orderstatus")


@query(
    "head_tail",
    """SELECT 'head' AS part, * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5)
       UNION ALL SELECT 'tail', * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5)""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    first = ops.head(df, [F.col("o_orderkey")], 5).withColumn("part", F.lit("head"))
    last = ops.tail(df, [F.col("o_orderkey").desc()], 5).withColumn("part", F.lit("tail"))
    return first.unionByName(last)


@query(
    "bins_cut",
    """SELECT p_partkey, p_retailprice - 900 AS price,
              CASE WHEN p_retailprice - 900 > 0 AND p_retailprice - 900 <= 50 THEN '0-50'
                   WHEN p_retailprice - 900 > 50 AND p_retailprice - 900 <= 100 THEN '50-100'
                   WHEN p_retailprice - 900 > 100 AND p_retailprice - 900 <= 200 THEN '100-200'
                   WHEN p_retailprice - 900 > 200 AND p_retailprice - 900 <= 500 THEN '200-500'
                   WHEN p_retailprice - 900 > 500 AND p_retailprice - 900 <= 1000 THEN '500-1000' END AS price_range
       FROM part""",
)
def _(spark, sf):
    price = F.col("p_retailprice") - 900
    return table(spark, sf, "part").select(
        "p_partkey",
        price.alias("price"),
        ops.right_closed_bins(price, [0, 50, 100, 200, 500, 1000]).alias("price_range"),
    )


@query(
    "map_codes",
    """WITH seen AS (SELECT o_orderpriority, min(o_orderkey) AS first FROM orders GROUP BY 1),
       codes AS (SELECT o_orderpriority, row_number() OVER (ORDER BY first) - 1 AS code FROM seen)
       SELECT o_orderkey, o_orderpriority, code FROM orders JOIN codes USING (o_orderpriority)""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return ops.add_codes(df, "o_orderpriority", ["o_orderkey"]).select("o_orderkey", "o_orderpriority", "code")


_FLOWS = f"""WITH {PANEL}, flows AS (
  SELECT tran_br_code, start_date, coalesce(daily_withdrawals, 0) AS wd, coalesce(daily_deposits, 0) AS dep FROM panel),
status AS (SELECT *, CASE WHEN wd - dep > 0 THEN 'Shortage' WHEN dep > wd * 1.1 THEN 'Surplus' ELSE 'Balanced' END AS status FROM flows)"""


def _flows(spark, sf):
    return panel(spark, sf).select(
        "tran_br_code",
        "start_date",
        F.coalesce("daily_withdrawals", F.lit(0.0)).alias("wd"),
        F.coalesce("daily_deposits", F.lit(0.0)).alias("dep"),
    )


@query("status_label", f"{_FLOWS} SELECT tran_br_code, start_date, status FROM status")
def _(spark, sf):
    return _flows(spark, sf).select(
        "tran_br_code", "start_date", labels.status_label(F.col("wd"), F.col("dep")).alias("status")
    )


@query(
    "guidance_text",
    f"""{_FLOWS} SELECT tran_br_code, start_date, CASE status WHEN 'Shortage' THEN 'Replenishment may be required'
        WHEN 'Surplus' THEN 'Possible excess idle cash' WHEN 'Balanced' THEN 'No major cash gap expected'
        ELSE 'Unknown' END AS guidance FROM status""",
)
def _(spark, sf):
    status = labels.status_label(F.col("wd"), F.col("dep"))
    return _flows(spark, sf).select("tran_br_code", "start_date", labels.guidance_text(status).alias("guidance"))


@query(
    "forecast_explanation",
    f"""{_FLOWS}, means AS (SELECT *, avg(wd) OVER w AS bw, avg(dep) OVER w AS bd, isodow(start_date) - 1 AS dow FROM flows
          WINDOW w AS (PARTITION BY tran_br_code ORDER BY start_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
        parts AS (SELECT tran_br_code, start_date,
          CASE WHEN day(start_date) = 25 THEN 'Salary day spike anticipated.'
               WHEN day(start_date) = 1 THEN 'Start of month typically sees higher transaction volume.'
               WHEN start_date = last_day(start_date) THEN 'End of month patterns indicate elevated cash movement.' END AS a,
          CASE WHEN dow >= 5 THEN 'Weekend trend detected; typically lower activity.'
               WHEN dow = 4 THEN 'Friday peak activity expected.' END AS b,
          CASE WHEN bw > 0 AND wd > bw * 1.2 THEN 'Withdrawals projected 20%+ above recent average.'
               WHEN bd > 0 AND dep > bd * 1.2 THEN 'Deposits projected 20%+ above recent average.' END AS c FROM means)
        SELECT tran_br_code, start_date,
          CASE WHEN a IS NULL AND b IS NULL AND c IS NULL THEN 'Aligns with recent historical trends and rolling averages.'
               ELSE concat_ws(' ', a, b, c) END AS explanation FROM parts""",
)
def _(spark, sf):
    from pyspark.sql import Window

    before = Window.partitionBy("tran_br_code").orderBy("start_date").rowsBetween(-7, -1)
    day = F.col("start_date")
    df = _flows(spark, sf).withColumns({"bw": F.avg("wd").over(before), "bd": F.avg("dep").over(before)})
    text = labels.forecast_explanation(
        F.dayofmonth(day) == 25, F.dayofmonth(day) == 1, day == F.last_day(day), F.weekday(day),
        F.col("wd"), F.col("dep"), F.col("bw"), F.col("bd"),
    )
    return df.select("tran_br_code", "start_date", text.alias("explanation"))


@query(
    "format_amount",
    f"""WITH {PANEL}, net AS (SELECT tran_br_code, start_date, daily_deposits - daily_withdrawals AS v FROM panel)
        SELECT tran_br_code, start_date,
          CASE WHEN v IS NULL THEN '—' ELSE concat(CASE WHEN v < 0 THEN '-' ELSE '' END,
            CASE WHEN abs(v) >= 1e9 THEN printf('%.1fB', abs(v) / 1e9) WHEN abs(v) >= 1e6 THEN printf('%.1fM', abs(v) / 1e6)
                 WHEN abs(v) >= 1e3 THEN printf('%.0fK', abs(v) / 1e3) ELSE printf('%.0f', abs(v)) END) END AS amount,
          CASE WHEN v IS NULL THEN 'N/A'
               WHEN abs(v) >= 1e9 THEN printf('%.2fB', v / 1e9) WHEN abs(v) >= 1e6 THEN printf('%.2fM', v / 1e6)
               WHEN abs(v) >= 1e3 THEN printf('%.2fK', v / 1e3) ELSE printf('%.2f', v) END AS metric
        FROM net""",
)
def _(spark, sf):
    net = F.col("daily_deposits") - F.col("daily_withdrawals")
    return panel(spark, sf).select(
        "tran_br_code", "start_date", labels.short_amount(net).alias("amount"), labels.metric_amount(net).alias("metric")
    )


@query(
    "risk_reserve",
    f"{_FLOWS} SELECT tran_br_code, start_date, round(greatest(wd - dep, 0) * 1.1, 3) AS reserve FROM flows",
)
def _(spark, sf):
    requirement = F.greatest(F.col("wd") - F.col("dep"), F.lit(0.0))
    return _flows(spark, sf).select(
        "tran_br_code", "start_date", F.round(labels.reserve(requirement, 0.1), 3).alias("reserve")
    )
