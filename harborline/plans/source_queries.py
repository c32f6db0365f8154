"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.operators.metrics import flow_metrics
from harborline.plans.registry import query
from harborline.plans.tables import table
from harborline.session import drop_at_end, scratch_path
from harborline.sources import readers, writers
from harborline.sources.store import Store


@query(
    "scan_csv",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
       FROM orders""",
)
def _(spark, sf):
    source = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate")
    )
    path = writers.write_csv(source, scratch_path(spark, "orders-csv"))
    return readers.read_csv(
        spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date"
    )


@query("scan_json", "SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    source = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    path = writers.write_json_report(source, scratch_path(spark, "events-json"))
    back = readers.read_json(spark, path, "event_id long, user_id long, event_type string, value double, props string")
    return back.withColumn("k", F.get_json_object("props", "$.k").cast("long")).drop("props")


@query(
    "scan_text_docs",
    r"""SELECT trim(text, E' \t\n\r\f\x0b') AS text, count(*) AS copies FROM documents
        WHERE length(trim(text, E' \t\n\r\f\x0b')) > 0 GROUP BY 1""",
)
def _(spark, sf):
    # Text files of many documents each, parted by the record separator.
    path = scratch_path(spark, "documents-text")
    table(spark, sf, "documents").select("text").write.option("lineSep", "\x1e").text(path)
    docs = readers.read_text_documents(spark, path, separator="\x1e")
    return docs.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "rows_from_literal",
    """SELECT s.status, s.meaning, count(*) AS orders FROM orders o
       JOIN (VALUES ('O','open'),('F','filled'),('P','partial')) s(status, meaning) ON o.o_orderstatus = s.status
       GROUP BY 1, 2""",
)
def _(spark, sf):
    names = readers.rows(spark, [("O", "open"), ("F", "filled"), ("P", "partial")], "status string, meaning string")
    per_status = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    return per_status.join(names, F.col("o_orderstatus") == F.col("status")).select("status", "meaning", "orders")


@query(
    "date_range_source",
    """WITH span AS (SELECT c_nationkey AS branch, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi
                     FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
       days AS (SELECT branch, 'day' AS step, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d, lo, hi FROM span),
       months AS (SELECT branch, 'month_end' AS step, last_day(CAST(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS DATE)) AS d, lo, hi FROM span),
       years AS (SELECT branch, 'year_end' AS step, make_date(CAST(unnest(generate_series(year(lo), year(hi))) AS BIGINT), 12, 31) AS d, lo, hi FROM span)
       SELECT branch, step, d FROM (SELECT * FROM days UNION ALL SELECT * FROM months UNION ALL SELECT * FROM years) WHERE d BETWEEN lo AND hi""",
)
def _(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("branch"))
    span = (
        table(spark, sf, "orders")
        .select("o_custkey", F.to_date("o_orderdate").alias("d"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("branch")
        .agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    )
    lo, hi = F.col("lo"), F.col("hi")
    series = F.array(
        F.struct(F.lit("day").alias("step"), readers.date_series(lo, hi).alias("dates")),
        F.struct(F.lit("month_end").alias("step"), readers.date_series(lo, hi, "month", at_end=True).alias("dates")),
        F.struct(F.lit("year_end").alias("step"), readers.date_series(lo, hi, "year", at_end=True).alias("dates")),
    )
    return (
        span.select("branch", F.explode(series).alias("s"))
        .select("branch", "s.step", F.explode("s.dates").alias("d"))
    )


@query("require_columns", "SELECT count(*) AS rows FROM lineitem")
def _(spark, sf):
    df = readers.require_columns(table(spark, sf, "lineitem"), ["l_suppkey", "l_shipdate", "l_extendedprice"])
    return df.agg(F.count(F.lit(1)).alias("rows"))


@query("sink_csv", "SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1, 2")
def _(spark, sf):
    totals = (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
    )
    path = writers.write_csv(totals, scratch_path(spark, "totals-csv"))
    return readers.read_csv(spark, path, "l_returnflag string, l_linestatus string, total double")


@query(
    "sink_json_report",
    """SELECT l_returnflag, 'mae' AS metric, round_even(avg(abs(l_extendedprice - l_quantity * 5000)), 2) AS value
       FROM lineitem GROUP BY 1
       UNION ALL SELECT l_returnflag, 'num_comparisons', CAST(count(*) AS DOUBLE) FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    pairs = table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").alias("actual"), (F.col("l_quantity") * 5000).alias("predicted")
    )
    report = writers.json_report(flow_metrics(pairs, "actual", "predicted", ["l_returnflag"]), "l_returnflag")
    path = writers.write_json_report(report, scratch_path(spark, "metrics-json"))
    back = readers.read_json(spark, path, "l_returnflag string, report string")
    value = lambda name: F.get_json_object("report", f"$.{name}").cast("double")
    return back.select(
        "l_returnflag",
        F.explode(F.create_map(F.lit("mae"), value("mae"), F.lit("num_comparisons"), value("num_comparisons"))).alias(
            "metric", "value"
        ),
    )


_STORE = """store AS (
  SELECT doc_id, text, source FROM documents),
incoming AS (
  SELECT doc_id + CASE WHEN lang = 'en' THEN 0 ELSE 1000000000 END AS doc_id, concat('v2 ', text) AS text, source FROM documents),
merged AS (
  SELECT * FROM incoming UNION ALL SELECT * FROM store WHERE doc_id NOT IN (SELECT doc_id FROM incoming))"""


def _store_frames(spark, sf):
    """Documents as the store; the English ones come again changed, the others under new ids."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "lang")
    shift = F.when(F.col("lang") == "en", F.lit(0)).otherwise(F.lit(1_000_000_000)).cast("long")
    incoming = docs.select((F.col("doc_id") + shift).alias("doc_id"), F.concat(F.lit("v2 "), "text").alias("text"), "source")
    return docs.drop("lang"), incoming


def _updated_store(spark, sf):
    stored, incoming = _store_frames(spark, sf)
    path = scratch_path(spark, "store")
    drop_at_end(spark, path)
    store = Store(spark, path)
    store.create(stored, "doc_id", parts=16)
    store.upsert(incoming)
    return store


@query("sink_vector_upsert", f"WITH {_STORE} SELECT doc_id, md5(text) AS digest, source FROM merged")
def _(spark, sf):
    return _updated_store(spark, sf).read().select("doc_id", F.md5("text").alias("digest"), "source")


@query("store_count", f"WITH {_STORE} SELECT count(*) AS chunks FROM merged")
def _(spark, sf):
    store = _updated_store(spark, sf)
    return spark.range(1).select(F.lit(store.count()).cast("long").alias("chunks"))
