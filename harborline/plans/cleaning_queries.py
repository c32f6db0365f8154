"""Cleaning and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.operators import cleaning, profiling
from harborline.plans.registry import query
from harborline.plans.tables import GAPS, table, with_gaps

# Order prices and dates as badly kept text, by order status.
_TEXTS = """texts AS (SELECT o_orderkey,
  CASE o_orderpriority WHEN '1-URGENT' THEN '-' WHEN '2-HIGH' THEN concat(' ', CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), ',000 ')
       WHEN '3-MEDIUM' THEN 'n/a' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS price_text,
  CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%d/%m/%Y') WHEN '2-HIGH' THEN strftime(o_orderdate, '%d-%m-%Y')
       WHEN '3-MEDIUM' THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text,
  concat(o_orderstatus, '!@#', o_orderpriority, '$(x)') AS label_text FROM orders)"""


def _texts(spark, sf):
    priority = F.col("o_orderpriority")
    whole = F.floor("o_totalprice").cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(priority == "1-URGENT", "-")
        .when(priority == "2-HIGH", F.concat(F.lit(" "), whole, F.lit(",000 ")))
        .when(priority == "3-MEDIUM", "n/a")
        .otherwise(whole)
        .alias("price_text"),
        F.when(priority == "1-URGENT", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(priority == "2-HIGH", F.date_format("o_orderdate", "dd-MM-yyyy"))
        .when(priority == "3-MEDIUM", "unknown")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("date_text"),
        F.concat("o_orderstatus", F.lit("!@#"), "o_orderpriority", F.lit("$(x)")).alias("label_text"),
    )


@query("coerce_numeric", f"WITH {_TEXTS} SELECT o_orderkey, TRY_CAST(price_text AS DOUBLE) AS price FROM texts")
def _(spark, sf):
    return _texts(spark, sf).select("o_orderkey", cleaning.coerce_number(F.col("price_text")).alias("price"))


@query(
    "coerce_datetime",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(o_orderdate AS DATE) END AS d FROM orders""",
)
def _(spark, sf):
    return _texts(spark, sf).select("o_orderkey", F.to_date(cleaning.coerce_date(F.col("date_text"))).alias("d"))


@query(
    "detect_date_columns",
    "SELECT c AS column_name, CAST(n AS BIGINT) AS parsed FROM (SELECT 'shipped_on' AS c, count(*) AS n FROM lineitem)",
)
def _(spark, sf):
    # No column is named like a date, so the values of the text columns decide.
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_returnflag", F.date_format("l_shipdate", "dd/MM/yyyy").alias("shipped_on")
    )
    names = cleaning.date_columns(df)
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("parsed")) for c in names
    ]
    return df.agg(*[F.count(cleaning.coerce_date(F.col(c))).alias(c) for c in names]).select(F.inline(F.array(*cells)))


@query("fill_zero_cash", f"WITH {GAPS} SELECT l_orderkey, l_linenumber, discount_rate, coalesce(cash_tax, 0) AS cash_tax FROM gaps")
def _(spark, sf):
    return cleaning.fill_zero_cash(with_gaps(spark, sf)).select("l_orderkey", "l_linenumber", "discount_rate", "cash_tax")


@query(
    "fill_median",
    f"""WITH {GAPS} SELECT l_orderkey, l_linenumber,
          round(coalesce(discount_rate, (SELECT quantile_cont(discount_rate, 0.5) FROM gaps)), 6) AS discount_rate,
          round(coalesce(cash_tax, (SELECT quantile_cont(cash_tax, 0.5) FROM gaps)), 6) AS cash_tax FROM gaps""",
)
def _(spark, sf):
    filled = cleaning.fill_median(with_gaps(spark, sf), ["discount_rate", "cash_tax"])
    return filled.select(
        "l_orderkey", "l_linenumber", F.round("discount_rate", 6).alias("discount_rate"), F.round("cash_tax", 6).alias("cash_tax")
    )


@query(
    "fill_mean",
    f"""WITH {GAPS} SELECT l_orderkey, l_linenumber, round(coalesce(discount_rate, (SELECT avg(discount_rate) FROM gaps)), 8) AS discount_rate FROM gaps""",
)
def _(spark, sf):
    filled = cleaning.fill_mean(with_gaps(spark, sf), ["discount_rate"])
    return filled.select("l_orderkey", "l_linenumber", F.round("discount_rate", 8).alias("discount_rate"))


@query(
    "fill_max_date",
    f"WITH {GAPS} SELECT l_orderkey, l_linenumber, coalesce(ship_date, (SELECT max(ship_date) FROM gaps)) AS ship_date FROM gaps",
)
def _(spark, sf):
    return cleaning.fill_latest(with_gaps(spark, sf), ["ship_date"]).select("l_orderkey", "l_linenumber", "ship_date")


@query(
    "fill_constant",
    f"WITH {GAPS} SELECT l_orderkey, l_linenumber, coalesce(discount_rate, 0) AS discount_rate, coalesce(status, 'Unknown') AS status FROM gaps",
)
def _(spark, sf):
    return (
        with_gaps(spark, sf)
        .fillna({"discount_rate": 0.0, "status": "Unknown"})
        .select("l_orderkey", "l_linenumber", "discount_rate", "status")
    )


@query(
    "fill_from_other_column",
    f"""WITH {GAPS} SELECT l_orderkey, l_linenumber, CASE WHEN discount_rate IS NULL AND status = 'F' THEN cash_tax ELSE discount_rate END AS discount_rate FROM gaps""",
)
def _(spark, sf):
    value = cleaning.fill_from("discount_rate", "cash_tax", F.col("status") == "F")
    return with_gaps(spark, sf).select("l_orderkey", "l_linenumber", value.alias("discount_rate"))


@query(
    "drop_null_rows",
    f"""WITH {GAPS} SELECT 'any' AS rule, count(*) AS rows FROM gaps WHERE discount_rate IS NOT NULL AND cash_tax IS NOT NULL AND status IS NOT NULL AND ship_date IS NOT NULL
        UNION ALL SELECT 'critical', count(*) FROM gaps WHERE ship_date IS NOT NULL
        UNION ALL SELECT 'all', count(*) FROM gaps WHERE NOT (discount_rate IS NULL AND cash_tax IS NULL AND status IS NULL AND ship_date IS NULL)""",
)
def _(spark, sf):
    df = with_gaps(spark, sf)
    rule = lambda name, kept: kept.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("rule"), "rows")
    measures = ["discount_rate", "cash_tax", "status", "ship_date"]
    return (
        rule("any", df.dropna(how="any"))
        .unionByName(rule("critical", df.dropna(subset=["ship_date"])))
        .unionByName(rule("all", df.dropna(how="all", subset=measures)))
    )


# Line items with the returned ones entered twice.
_TWICE = "twice AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R')"


def _twice(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.unionByName(df.where(F.col("l_returnflag") == "R"))


@query("dedupe_rows", f"WITH {_TWICE} SELECT DISTINCT * FROM twice")
def _(spark, sf):
    return _twice(spark, sf).dropDuplicates()


@query("dedupe_keep_none", f"WITH {_TWICE} SELECT * FROM twice GROUP BY ALL HAVING count(*) = 1")
def _(spark, sf):
    return cleaning.keep_unrepeated(_twice(spark, sf))


@query("duplicate_count", f"WITH {_TWICE} SELECT (SELECT count(*) FROM twice) - (SELECT count(*) FROM (SELECT DISTINCT * FROM twice)) AS duplicates")
def _(spark, sf):
    return cleaning.duplicate_count(_twice(spark, sf))


_BOUNDS = """bounds AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3,
    quantile_cont(l_extendedprice, 0.25) - 0.3 * (quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)) AS lo,
    quantile_cont(l_extendedprice, 0.75) + 0.3 * (quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)) AS hi FROM lineitem)"""


@query(
    "iqr_bounds",
    """SELECT l_returnflag, 'l_extendedprice' AS "column", round(q1, 6) AS q1, round(q3, 6) AS q3,
              round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper
       FROM (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3
             FROM lineitem GROUP BY 1)""",
)
def _(spark, sf):
    found = cleaning.iqr_bounds(table(spark, sf, "lineitem"), ["l_extendedprice"], ["l_returnflag"])
    return found.select("l_returnflag", "column", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "lower", "upper")])


# The prices have no outliers at the usual width 1.5, so a width of 0.3 is what exercises the cap.
@query(
    "iqr_clip",
    f"""WITH {_BOUNDS} SELECT l_orderkey, l_linenumber, round(greatest(least(l_extendedprice, hi), lo), 4) AS l_extendedprice,
          l_extendedprice < lo OR l_extendedprice > hi AS capped FROM lineitem, bounds""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    clipped = cleaning.iqr_clip(df, ["l_extendedprice"], 0.3)
    return clipped.select(
        "l_orderkey", "l_linenumber", F.round("l_extendedprice", 4).alias("l_extendedprice"), F.col("l_extendedprice_capped").alias("capped")
    )


@query(
    "iqr_filter",
    f"WITH {_BOUNDS} SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, bounds WHERE l_extendedprice BETWEEN lo AND hi",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return cleaning.iqr_filter(df, ["l_extendedprice"], 0.3)


@query("clip_nonneg", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer")
def _(spark, sf):
    balance = cleaning.clip_nonnegative(F.col("c_acctbal"))
    return table(spark, sf, "customer").select("c_custkey", balance.alias("c_acctbal"))


@query("strip_special_chars", rf"WITH {_TEXTS} SELECT o_orderkey, translate(label_text, '!@#$%^&*()\', '') AS label FROM texts")
def _(spark, sf):
    return _texts(spark, sf).select("o_orderkey", cleaning.strip_special(F.col("label_text")).alias("label"))


@query(
    "clean_numeric_text",
    f"WITH {_TEXTS} SELECT o_orderkey, TRY_CAST(CASE WHEN trim(replace(price_text, ',', '')) = '-' THEN '0' ELSE trim(replace(price_text, ',', '')) END AS DOUBLE) AS price FROM texts",
)
def _(spark, sf):
    return _texts(spark, sf).select("o_orderkey", cleaning.clean_numeric_text(F.col("price_text")).alias("price"))


@query(
    "null_profile",
    f"""WITH {GAPS}, n AS (SELECT count(*) AS n FROM gaps),
        filled AS (UNPIVOT (SELECT count(l_orderkey) AS l_orderkey, count(l_linenumber) AS l_linenumber, count(l_quantity) AS l_quantity,
                   count(discount_rate) AS discount_rate, count(cash_tax) AS cash_tax, count(status) AS status, count(ship_date) AS ship_date FROM gaps)
                   ON COLUMNS(*) INTO NAME "column" VALUE present)
        SELECT "column", n - present AS nulls, round_even((n - present) / n * 100, 2) AS null_pct, n AS rows FROM filled, n""",
)
def _(spark, sf):
    return profiling.null_profile(with_gaps(spark, sf))


@query(
    "data_dictionary",
    """WITH first AS (SELECT * FROM customer ORDER BY c_custkey LIMIT 3)
       SELECT 'c_custkey' AS "column", 'bigint' AS type, 0 AS missing, (SELECT count(DISTINCT c_custkey) FROM customer) AS "distinct", (SELECT string_agg(CAST(c_custkey AS VARCHAR), ', ' ORDER BY c_custkey) FROM first) AS samples
       UNION ALL SELECT 'c_name', 'string', 0, (SELECT count(DISTINCT c_name) FROM customer), (SELECT string_agg(c_name, ', ' ORDER BY c_custkey) FROM first)
       UNION ALL SELECT 'c_nationkey', 'int', 0, (SELECT count(DISTINCT c_nationkey) FROM customer), (SELECT string_agg(CAST(c_nationkey AS VARCHAR), ', ' ORDER BY c_custkey) FROM first)
       UNION ALL SELECT 'c_acctbal', 'double', 0, (SELECT count(DISTINCT c_acctbal) FROM customer), (SELECT string_agg(CAST(c_acctbal AS VARCHAR), ', ' ORDER BY c_custkey) FROM first)
       UNION ALL SELECT 'c_mktsegment', 'string', 0, (SELECT count(DISTINCT c_mktsegment) FROM customer), (SELECT string_agg(c_mktsegment, ', ' ORDER BY c_custkey) FROM first)""",
)
def _(spark, sf):
    return profiling.data_dictionary(table(spark, sf, "customer"), ["c_custkey"])


_DESCRIBE_ONE = """SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 6) AS q25,
  round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS q50, round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 6) AS q75 FROM gaps"""


@query("describe", f"WITH {GAPS} " + " UNION ALL ".join(_DESCRIBE_ONE.format(c=c) for c in ("l_quantity", "discount_rate", "cash_tax")))
def _(spark, sf):
    found = profiling.describe(with_gaps(spark, sf), ["l_quantity", "discount_rate", "cash_tax"])
    return found.select(
        "column", "count", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "std", "q25", "q50", "q75")]
    )


@query(
    "cleaning_summary",
    f"""WITH {GAPS}, kept AS (SELECT * FROM gaps WHERE ship_date IS NOT NULL)
        SELECT 'rows' AS part, 'rows_before' AS item, count(*) AS n FROM gaps UNION ALL SELECT 'rows', 'rows_after', count(*) FROM kept
        UNION ALL SELECT 'rows', 'rows_removed', (SELECT count(*) FROM gaps) - (SELECT count(*) FROM kept)
        UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM kept GROUP BY 2
        UNION ALL SELECT 'discount_rate', CAST(discount_rate AS VARCHAR), count(*) FROM kept WHERE discount_rate IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'cash_tax', CAST(cash_tax AS VARCHAR), count(*) FROM kept WHERE cash_tax IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'status', status, count(*) FROM kept WHERE status IS NOT NULL GROUP BY 2""",
)
def _(spark, sf):
    df = with_gaps(spark, sf)
    kept = df.dropna(subset=["ship_date"])
    totals = profiling.cleaning_summary(df, kept).select(
        F.lit("rows").alias("part"), F.col("measure").alias("item"), F.col("value").alias("n")
    )
    counts = profiling.low_cardinality_counts(kept).select(
        F.col("column").alias("part"), F.col("value").alias("item"), "n"
    )
    return totals.unionByName(counts)
