"""Joins and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from harborline.operators import joins, panel as grids
from harborline.plans.registry import query
from harborline.plans.tables import PANEL, daily_panel, panel, table


@query(
    "join_inner",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey, o_orderpriority
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@query("join_left", "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")


@query("join_right", "SELECT d.doc_id, l.quality, d.lang FROM labels l RIGHT JOIN documents d ON d.doc_id = l.doc_id")
def _(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return joins.right_join(labels, table(spark, sf, "documents").select("doc_id", "lang"), ["doc_id"])


_DAYS = """dep AS (SELECT c_nationkey AS branch, CAST(o_orderdate AS DATE) AS day, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey),
wd AS (SELECT s_nationkey AS branch, CAST(l_shipdate AS DATE) AS day, round(sum(l_extendedprice), 2) AS out_total FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"""


def _days(spark, sf):
    """Single orders by branch and day, and shipped totals by branch and day."""
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("branch"))
    supplier = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("branch"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice", F.to_date("l_shipdate").alias("day"))
    dep = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("branch", "day", "o_orderkey")
    wd = (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("branch", "day")
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("out_total"))
    )
    return dep, wd


@query("join_outer", f"WITH {_DAYS} SELECT branch, day, o_orderkey, out_total FROM dep FULL JOIN wd USING (branch, day)")
def _(spark, sf):
    dep, wd = _days(spark, sf)
    return joins.full_join(dep, wd, ["branch", "day"])


@query("join_index", f"WITH {_DAYS} SELECT branch, day, o_orderkey, out_total FROM dep LEFT JOIN wd USING (branch, day)")
def _(spark, sf):
    dep, wd = _days(spark, sf)
    return dep.join(wd, ["branch", "day"], "left")


@query(
    "join_counts",
    f"""WITH {_DAYS} SELECT 'inner' AS how, (SELECT count(*) FROM dep JOIN wd USING (branch, day)) AS rows
        UNION ALL SELECT 'left', (SELECT count(*) FROM dep LEFT JOIN wd USING (branch, day))
        UNION ALL SELECT 'right', (SELECT count(*) FROM dep RIGHT JOIN wd USING (branch, day))
        UNION ALL SELECT 'outer', (SELECT count(*) FROM dep FULL JOIN wd USING (branch, day))""",
)
def _(spark, sf):
    return joins.join_counts(*_days(spark, sf), ["branch", "day"])


@query(
    "concat_rows",
    "SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier",
)
def _(spark, sf):
    shape = lambda kind, df, key, value: df.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.col(value).alias("balance"))
    customers = shape("customer", table(spark, sf, "customer"), "c_custkey", "c_acctbal")
    return customers.unionByName(shape("supplier", table(spark, sf, "supplier"), "s_suppkey", "s_acctbal"))


@query(
    "concat_columns",
    """WITH a AS (SELECT o_custkey AS id, count(*) AS orders FROM orders GROUP BY 1), b AS (SELECT c_custkey AS id, c_acctbal FROM customer)
       SELECT id, orders, c_acctbal FROM a FULL JOIN b USING (id)""",
)
def _(spark, sf):
    a = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("orders"))
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    return joins.align_columns(a, b, ["id"])


_GRID = f"""{PANEL}, span AS (SELECT min(start_date) AS lo, max(start_date) AS hi FROM panel),
grid AS (SELECT tran_br_code, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS start_date
         FROM (SELECT DISTINCT tran_br_code FROM panel), span),
full_panel AS (SELECT tran_br_code, start_date, daily_withdrawals, daily_deposits, transaction_count
               FROM grid LEFT JOIN panel USING (tran_br_code, start_date))"""


@query("cross_grid", f"WITH {_GRID} SELECT * FROM full_panel")
def _(spark, sf):
    return grids.complete_grid(daily_panel(spark, sf))


@query(
    "semi_valid_keys",
    "SELECT item_key FROM (SELECT DISTINCT l_suppkey + 40 AS item_key FROM lineitem) WHERE item_key IN (SELECT s_suppkey FROM supplier)",
)
def _(spark, sf):
    asked = table(spark, sf, "lineitem").select((F.col("l_suppkey") + 40).alias("item_key")).distinct()
    known = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("item_key"))
    return joins.known_keys(asked, known, ["item_key"])


@query(
    "anti_unknown_keys",
    """SELECT item_key, 'unknown branch' AS problem FROM (SELECT DISTINCT l_suppkey + 40 AS item_key FROM lineitem) WHERE item_key NOT IN (SELECT s_suppkey FROM supplier)
       UNION ALL SELECT o_orderkey, 'before first date' FROM orders WHERE o_orderdate < (SELECT min(l_shipdate) FROM lineitem)""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    asked = lines.select((F.col("l_suppkey") + 40).alias("item_key")).distinct()
    known = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("item_key"))
    first = lines.agg(F.min("l_shipdate")).scalar()
    early = table(spark, sf, "orders").where(F.col("o_orderdate") < first)
    return (
        joins.unknown_keys(asked, known, ["item_key"])
        .select("item_key", F.lit("unknown branch").alias("problem"))
        .unionByName(early.select(F.col("o_orderkey").alias("item_key"), F.lit("before first date").alias("problem")))
    )


@query(
    "asof_last_before",
    f"WITH {PANEL} SELECT * FROM (SELECT tran_br_code, start_date, daily_withdrawals, daily_deposits FROM panel WHERE start_date < DATE '2001-01-01') QUALIFY row_number() OVER (PARTITION BY tran_br_code ORDER BY start_date DESC) = 1",
)
def _(spark, sf):
    days = panel(spark, sf).drop("transaction_count")
    return joins.latest_before(days, ["tran_br_code"], "start_date", F.lit(dt.date(2001, 1, 1)))


@query(
    "exact_date_lookup",
    f"""WITH {PANEL} SELECT p.tran_br_code, p.start_date, p.daily_withdrawals, e.daily_withdrawals AS week_ago
        FROM panel p LEFT JOIN panel e ON e.tran_br_code = p.tran_br_code AND e.start_date = p.start_date - 7""",
)
def _(spark, sf):
    days = panel(spark, sf).select("tran_br_code", "start_date", "daily_withdrawals")
    return joins.value_days_ago(days, ["tran_br_code"], "start_date", "daily_withdrawals", 7, "week_ago")


@query(
    "union_all",
    "SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day FROM orders UNION ALL SELECT l_orderkey, CAST(l_shipdate AS DATE) FROM lineitem",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("day"))
    lines = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"), F.col("l_orderkey").alias("id"))
    return orders.unionByName(lines)


@query("except_keys", "SELECT o_orderkey AS id FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return orders.subtract(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")))


@query(
    "set_equal",
    """WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier), c AS (SELECT DISTINCT n_nationkey AS k FROM nation)
       SELECT 'customer-nation' AS pair, NOT EXISTS (FROM a EXCEPT FROM c) AND NOT EXISTS (FROM c EXCEPT FROM a) AS equal
       UNION ALL SELECT 'supplier-customer', NOT EXISTS (FROM b EXCEPT FROM a) AND NOT EXISTS (FROM a EXCEPT FROM b)""",
)
def _(spark, sf):
    keys = lambda name, column: table(spark, sf, name).select(F.col(column).alias("k"))
    customer, supplier, nation = keys("customer", "c_nationkey"), keys("supplier", "s_nationkey"), keys("nation", "n_nationkey")
    check = lambda name, a, b: grids.sets_equal(a, b).select(F.lit(name).alias("pair"), "equal")
    return check("customer-nation", customer, nation).unionByName(check("supplier-customer", supplier, customer))
