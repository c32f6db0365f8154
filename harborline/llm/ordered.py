"""Places and running sums inside groups of any size.

Rows are dealt to ranges of their order, so a group that holds a third of all rows is spread over as many tasks
as its share asks for. A task numbers the rows it has as they stream by; what a group had in the ranges
before is added afterwards, from one row per range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.llm.common import cut

_LOW = np.uint64(0xFFFFFFFF)


def numbered(rows: DataFrame, key: str, order: Sequence[Column | str], lanes: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``place``, their number from 1 within ``key`` by ``order``; a written table.

    The long columns ``lanes`` become their running sums modulo 2^32. ``key`` holds no nulls. Rows with equal
    order get successive places; callers order by everything that tells rows apart.
    """
    spark = rows.sparkSession
    spread = rows.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    lanes, columns = list(lanes), rows.columns
    names = [*columns, "place", "_part", "_edge"]
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("place", T.LongType()), T.StructField("_part", T.IntegerType()), T.StructField("_edge", T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count, sums = None, 0, [np.uint64(0)] * len(lanes)
        ready: list[pa.Array] | None = None

        def finished(edge: bool) -> pa.RecordBatch:
            marks = np.zeros(len(ready[0]), dtype=bool)
            marks[-1] = edge
            return pa.RecordBatch.from_arrays([*ready, pa.array(marks)], names)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if ready is not None:
                yield finished(False)
            keys = batch.column(key)
            new = np.ones(n, dtype=bool)
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[0] = keys[0].as_py() != last
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, 0))
            carried = np.cumsum(new) == 0
            place = at - start + 1 + np.where(carried, count, 0)
            arrays = {c: batch.column(c) for c in columns}
            for k, lane in enumerate(lanes):
                x = batch.column(lane).to_numpy().astype(np.uint64)
                total = np.cumsum(x)
                total = (total - (total - x)[start] + np.where(carried, sums[k], np.uint64(0))) & _LOW
                sums[k] = total[-1]
                arrays[lane] = pa.array(total.astype(np.int64))
            last, count = keys[n - 1].as_py(), int(place[-1])
            ready = [*arrays.values(), pa.array(place, pa.int64()), pa.array(np.full(n, part, dtype=np.int32))]
        if ready is not None:
            yield finished(True)

    table = cut(spread.mapInArrow(run, schema))
    # one row per range reaches the driver: the last one, with what its group has in that range
    edges = table.where("_edge").select("_part", key, "place", *lanes).orderBy("_part").collect()
    before, held = [], None
    for edge, later in zip(edges, edges[1:]):
        same = held is not None and held[0] == edge[1]
        held = [edge[1], *(x + (y if same else 0) for x, y in zip(edge[2:], held[1:] if same else edge[2:]))]
        before.append((later[0], *held))
    table = table.drop("_edge")
    if not before:
        return table.drop("_part")
    more = [f"_more{k}" for k in range(len(lanes) + 1)]
    schema = T.StructType(
        [T.StructField("_at", T.IntegerType()), T.StructField("_key", rows.schema[key].dataType)] + [T.StructField(c, T.LongType()) for c in more]
    )
    offsets = F.broadcast(spark.createDataFrame(before, schema))
    table = table.join(offsets, (F.col("_part") == F.col("_at")) & (F.col(key) == F.col("_key")), "left")
    place = (F.col("place") + F.coalesce(F.col(more[0]), F.lit(0))).alias("place")
    added = {lane: ((F.col(lane) + F.coalesce(F.col(m), F.lit(0))) % F.lit(1 << 32)).alias(lane) for lane, m in zip(lanes, more[1:])}
    return table.select(*[added.get(c, F.col(c)) for c in columns], place)
