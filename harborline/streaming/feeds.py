"""Daily and half-day totals that run on a table or on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.session import scratch_path


def window_totals(feed: DataFrame, width: str, late: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Withdrawals, deposits and rows per branch, window and ``by`` of (tran_br_code, ts, dr, cr).

    ``late`` sets a watermark: on a stream, rows later than that behind the newest are dropped and
    the state of closed windows is freed (``run_repairing`` keeps them).
    """
    timed = feed.withWatermark("ts", late) if late else feed
    return (
        timed.groupBy(*by, "tran_br_code", F.window("ts", width))
        .agg(F.sum("dr").alias("withdrawals"), F.sum("cr").alias("deposits"), F.count(F.lit(1)).alias("rows"))
        .select(*by, "tran_br_code", F.col("window.start").alias("window_start"), "withdrawals", "deposits", "rows")
    )


def half_day_totals(feed: DataFrame, late: str | None = None) -> DataFrame:
    """Windows of twelve hours, labelled AM and PM."""
    totals = window_totals(feed, "12 hours", late)
    return totals.withColumn("half", F.when(F.hour("window_start") < 12, "AM").otherwise("PM"))


def daily_totals(feed: DataFrame, late: str | None = None) -> DataFrame:
    return window_totals(feed, "1 day", late)


def read_feed(spark: SparkSession, folder: str, schema: T.StructType, pattern: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the Parquet files in ``folder`` whose names match ``pattern``."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def run_available(totals: DataFrame, spark: SparkSession, target: str, checkpoint: str) -> None:
    """Process what is there and stop. Each batch adds the rows it changed, marked with its number.

    A batch that is repeated after a failure rewrites its own folder, so the table stays exact.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/part={number}")

    query = (
        totals.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest(spark: SparkSession, target: str) -> DataFrame:
    """Current totals: the last written row of each branch and window."""
    rows = spark.read.parquet(target)
    values = ["withdrawals", "deposits", "rows"]
    return (
        rows.groupBy("tran_br_code", "window_start")
        .agg(F.max_by(F.struct(*values), F.col("batch")).alias("_last"))
        .select("tran_br_code", "window_start", "_last.*")
    )


VALUES = ("withdrawals", "deposits", "rows")


def run_repairing(feed: DataFrame, spark: SparkSession, target: str, checkpoint: str, late: str, width: str = "1 day") -> None:
    """Process what is there and stop, keeping late rows instead of dropping them.

    A window is closed once the newest row of the earlier batches is ``late`` or more behind its end. Every batch writes,
    under its number, the partial totals of open windows and those of closed ones apart (``totals``), the rows that
    came too late for theirs (``late``), and the newest time seen (``newest``). Nothing is held in a state store: a
    batch reads one row of the batch before it. One that is repeated after a failure rewrites its own
    folders, so no row counts twice. Rows without a time belong to no window.
    """
    seen = T.StructType([T.StructField("newest", T.TimestampType())])

    def write(batch: DataFrame, number: int) -> None:
        newest = None
        if number:
            row = spark.read.schema(seen).parquet(f"{target}/newest/part={number - 1}").select("newest", (F.col("newest") - F.expr(f"INTERVAL {late}")).alias("closed")).first()
            newest, closed = row.newest, row.closed
        end = F.window("ts", width).end
        is_late = F.lit(False) if newest is None else F.coalesce(end <= F.lit(closed), F.lit(False))
        window_totals(batch.withColumn("late", is_late), width, by=("late",)).write.mode("overwrite").parquet(f"{target}/totals/part={number}")
        batch.where(is_late).write.mode("overwrite").parquet(f"{target}/late/part={number}")
        latest_seen = batch.agg(F.greatest(F.max("ts"), F.lit(newest).cast("timestamp")).alias("newest"))
        latest_seen.write.mode("overwrite").parquet(f"{target}/newest/part={number}")

    query = feed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _summed(spark: SparkSession, target: str, which) -> DataFrame:
    parts = spark.read.option("recursiveFileLookup", True).parquet(f"{target}/totals").where(which)
    return parts.groupBy("tran_br_code", "window_start").agg(*[F.sum(v).alias(v) for v in VALUES])


def on_time(spark: SparkSession, target: str) -> DataFrame:
    """Totals of the rows that came before their window was closed."""
    return _summed(spark, target, ~F.col("late"))


def repairs(spark: SparkSession, target: str) -> DataFrame:
    """What late rows add to closed windows."""
    return _summed(spark, target, F.col("late"))


def repaired(spark: SparkSession, target: str) -> DataFrame:
    """Totals with the repairs of closed windows: those of all rows, whatever came late."""
    return _summed(spark, target, F.lit(True))


def late_rows(spark: SparkSession, target: str) -> DataFrame:
    """The rows that came after their window was closed."""
    return spark.read.option("recursiveFileLookup", True).parquet(f"{target}/late")


def stream_daily(feed: DataFrame, late: str | None = None) -> DataFrame:
    """Daily totals of a finite feed by way of a stream that reads all of it and stops.

    Every row counts, in whatever order the files come. Without ``late`` the state is one row per branch and day.
    With it no state is held: days that far behind are closed, and late rows repair them.
    """
    spark = feed.sparkSession
    target, checkpoint = scratch_path(spark, "stream-daily"), scratch_path(spark, "stream-state")
    if late:
        run_repairing(feed, spark, target, checkpoint, late)
        return repaired(spark, target)
    run_available(daily_totals(feed), spark, target, checkpoint)
    return latest(spark, target)
