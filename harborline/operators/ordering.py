"""Global positions without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.session import cut


def global_position(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number rows 1..n along ``order`` (which must be unique).

    Rows are range-partitioned, sorted inside their partitions and written once with the partition's number and
    their place in it, so both stay the same even when an executor is lost. Only one count per
    partition is windowed, and the rows aren't shuffled again.
    """
    number = F.monotonically_increasing_id()  # partition number above 33 bits of row number
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_number", number)
    slice_of, at = F.shiftright("_number", 33), F.col("_number").bitwiseAND((1 << 33) - 1)
    placed = cut(placed.withColumn("_slice", slice_of).withColumn("_at_", at).drop("_number"))
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    # one row per partition of the shuffle
    joined = placed.join(F.broadcast(starts), "_slice")
    return joined.withColumn(name, F.col("_at_") + F.col("_start") + 1).drop("_slice", "_start", "_at_")
