"""The given tables, and the fixtures derived from them, in Spark and in SQL.

Each derived fixture has a SQL twin (a CTE body) so that a query and its check start from
the same definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.session import cut


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly branch transactions: one row per branch, date and hour."""
    outgoing = F.col("event_type").isin("purchase", "error")
    return (
        table(spark, sf_dir, "events")
        .select(
            F.pmod("user_id", F.lit(15)).cast("int").alias("tran_br_code"),
            F.to_date("ts").alias("start_date"),
            F.hour("ts").alias("txn_hour"),
            F.when(outgoing, F.col("value")).otherwise(0.0).alias("dr"),
            F.when(outgoing, 0.0).otherwise(F.col("value")).alias("cr"),
        )
        .groupBy("tran_br_code", "start_date", "txn_hour")
        .agg(F.sum("dr").alias("TOTAL_DR"), F.sum("cr").alias("TOTAL_CR"))
    )


HOURLY = """hourly AS (
  SELECT CAST(user_id % 15 AS INTEGER) AS tran_br_code, CAST(ts AS DATE) AS start_date,
         CAST(hour(ts) AS INTEGER) AS txn_hour,
         sum(CASE WHEN event_type IN ('purchase','error') THEN value ELSE 0 END) AS TOTAL_DR,
         sum(CASE WHEN event_type IN ('purchase','error') THEN 0 ELSE value END) AS TOTAL_CR
  FROM events GROUP BY 1, 2, 3)"""


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily branch panel: deposits are orders by customer nation, withdrawals line items by supplier nation.

    Both flows are stacked and summed in one aggregate, which costs one shuffle where a full
    outer join of two aggregates costs three.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nothing = F.lit(None).cast("double")
    deposits = (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_nationkey").alias("tran_br_code"),
            F.to_date("o_orderdate").alias("start_date"),
            nothing.alias("wd"),
            F.col("o_totalprice").alias("dep"),
        )
    )
    withdrawals = (
        table(spark, sf_dir, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("s_nationkey").alias("tran_br_code"),
            F.to_date("l_shipdate").alias("start_date"),
            F.col("l_extendedprice").alias("wd"),
            nothing.alias("dep"),
        )
    )
    return (
        deposits.unionByName(withdrawals)
        .groupBy("tran_br_code", "start_date")
        .agg(
            F.round(F.sum("wd"), 2).alias("daily_withdrawals"),
            F.round(F.sum("dep"), 2).alias("daily_deposits"),
            F.count(F.lit(1)).alias("transaction_count"),
        )
    )


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel written as a table: the grid, its ends and its branches all start from it, so the
    transactions are scanned once. It has at most one row per branch and day."""
    return cut(panel(spark, sf_dir))


PANEL = """panel AS (
  SELECT tran_br_code, start_date, round(sum(wd), 2) AS daily_withdrawals,
         round(sum(dep), 2) AS daily_deposits, count(*) AS transaction_count
  FROM (
    SELECT c_nationkey AS tran_br_code, CAST(o_orderdate AS DATE) AS start_date,
           CAST(NULL AS DOUBLE) AS wd, o_totalprice AS dep
    FROM orders JOIN customer ON o_custkey = c_custkey
    UNION ALL
    SELECT s_nationkey, CAST(l_shipdate AS DATE), l_extendedprice, CAST(NULL AS DOUBLE)
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
  GROUP BY 1, 2)"""


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales rows: product, category, quantity, price, date, plus the keys that make them unique."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            F.col("p_type").alias("product"),
            F.col("p_brand").alias("category"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("revenue"),
            F.col("l_discount").alias("discount"),
            F.to_date("l_shipdate").alias("sale_date"),
        )
    )


SALES = """sales AS (
  SELECT l_orderkey, l_linenumber, p_type AS product, p_brand AS category, l_quantity AS quantity,
         l_extendedprice AS revenue, l_discount AS discount, CAST(l_shipdate AS DATE) AS sale_date
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items where a zero discount, a zero tax and the status 'O' count as not recorded."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.expr("nullif(l_discount, 0.0)").alias("discount_rate"),
        F.expr("nullif(l_tax, 0.0)").alias("cash_tax"),
        F.expr("nullif(l_linestatus, 'O')").alias("status"),
        F.when(F.col("l_returnflag") != "N", F.to_date("l_shipdate")).alias("ship_date"),
    )


GAPS = """gaps AS (
  SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_discount, 0.0) AS discount_rate,
         nullif(l_tax, 0.0) AS cash_tax, nullif(l_linestatus, 'O') AS status,
         CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) END AS ship_date
  FROM lineitem)"""
