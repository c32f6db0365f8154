"""Incremental totals: late rows, restarts and repeated batches."""

import datetime as dt

from harborline.session import scratch_path
from harborline.streaming import feeds

SCHEMA = "tran_br_code int, ts timestamp, dr double, cr double"


def write(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def at(day, hour):
    return dt.datetime(2024, 1, day, hour)


def totals(spark, target):
    return {(r.tran_br_code, r.window_start.day): (r.withdrawals, r.deposits, r.rows) for r in feeds.latest(spark, target).collect()}


def run(spark, folder, target, checkpoint, late):
    schema = spark.createDataFrame([], SCHEMA).schema
    feed = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)
    feeds.run_available(feeds.daily_totals(feed, late), spark, target, checkpoint)


def test_second_run_adds_to_the_first_and_counts_late_rows(spark):
    folder, target, checkpoint = (scratch_path(spark, n) for n in ("feed", "target", "state"))
    write(spark, folder, "a", [(1, at(1, 9), 5.0, 0.0), (1, at(1, 18), 0.0, 2.0), (2, at(2, 3), 1.0, 1.0)])
    run(spark, folder, target, checkpoint, "3 days")
    assert totals(spark, target) == {(1, 1): (5.0, 2.0, 2), (2, 2): (1.0, 1.0, 1)}
    write(spark, folder, "b", [(1, at(1, 20), 4.0, 0.0), (1, at(9, 1), 1.0, 0.0)])
    run(spark, folder, target, checkpoint, "3 days")
    assert totals(spark, target)[1, 1] == (9.0, 2.0, 3)
    # Now the newest row is on the 9th: a row of the 1st is too late and must not count.
    write(spark, folder, "c", [(1, at(1, 21), 100.0, 0.0), (1, at(9, 2), 1.0, 0.0)])
    run(spark, folder, target, checkpoint, "3 days")
    run(spark, folder, target, checkpoint, "3 days")
    assert totals(spark, target)[1, 1] == (9.0, 2.0, 3) and totals(spark, target)[1, 9] == (2.0, 0.0, 2)


def test_a_finite_feed_out_of_time_order_is_whole(spark):
    folder = scratch_path(spark, "feed")
    start = dt.datetime(2024, 1, 1)
    for n, day in enumerate((120, 60, 0, 119, 61)):
        rows = [(1, start + dt.timedelta(days=day, hours=h), 2.0, 1.0) for h in (1, 20)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{n}")
    schema = spark.createDataFrame([], SCHEMA).schema
    feed = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(folder)
    got = {(r.window_start - start).days: (r.withdrawals, r.deposits, r.rows) for r in feeds.stream_daily(feed).collect()}
    assert got == {day: (4.0, 2.0, 2) for day in (120, 60, 0, 119, 61)}


def test_late_rows_repair_closed_days(spark):
    folder, target, checkpoint = (scratch_path(spark, n) for n in ("feed", "target", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def run_next(name, rows):
        write(spark, folder, name, rows)
        feed = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)
        feeds.run_repairing(feed, spark, target, checkpoint, "3 days")

    days = lambda df: {(r.tran_br_code, r.window_start.day): (r.withdrawals, r.deposits, r.rows) for r in df.collect()}
    run_next("a", [(1, at(1, 9), 5.0, 0.0), (2, at(9, 3), 1.0, 1.0), (3, None, 9.0, 9.0)])
    assert days(feeds.repairs(spark, target)) == {} and feeds.late_rows(spark, target).count() == 0
    # the 9th is the newest: the 5th ended three days and three hours before it, the 6th is still open
    run_next("b", [(1, at(1, 20), 4.0, 0.0), (1, at(5, 23), 7.0, 0.0), (1, at(6, 0), 2.0, 0.0), (1, at(20, 1), 3.0, None)])
    assert days(feeds.on_time(spark, target)) == {(1, 1): (5.0, 0.0, 1), (2, 9): (1.0, 1.0, 1), (1, 6): (2.0, 0.0, 1), (1, 20): (3.0, None, 1)}
    assert days(feeds.repairs(spark, target)) == {(1, 1): (4.0, 0.0, 1), (1, 5): (7.0, 0.0, 1)}
    run_next("c", [(1, at(6, 1), 1.0, 1.0)])
    assert {(r.tran_br_code, r.ts.day) for r in feeds.late_rows(spark, target).collect()} == {(1, 1), (1, 5), (1, 6)}
    table = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder)
    assert days(feeds.repaired(spark, target)) == days(feeds.daily_totals(table))


def test_half_days_on_a_table(spark):
    df = spark.createDataFrame([(1, at(1, 9), 5.0, 0.0), (1, at(1, 12), 1.0, 2.0)], SCHEMA)
    rows = {r.half: (r.withdrawals, r.deposits) for r in feeds.half_day_totals(df).collect()}
    assert rows == {"AM": (5.0, 0.0), "PM": (1.0, 2.0)}
