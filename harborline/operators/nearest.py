"""Exact nearest neighbours for a batch of queries.

Scores are computed as dense blocks inside tasks and only each block's best ``k`` per query leave
it, so no (query, item) pair becomes a row. Queries and items are cut into blocks, and blocks of queries
meet blocks of items as cells of bounded size, whatever the sizes are. A cell screens a tile of scores at a time by
matrix products with a known error and scores exactly what may be among the best. Null vectors, and queries
without an id, take no part; vectors of different lengths, or with null components, are refused.

Large tables of items with few components are parted by their nearest centre, a bounded sample of items. A centre and the radius of its
part bound every score in it from above. A query first meets the parts with the best bounds that hold
``k`` items; its k-th best score so far then rejects all parts whose bound lies below it, and it meets the
rest in a second round. Centres decide what is compared, never what is found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.operators.windows import top_n
from harborline.session import cut

QUERY_BLOCK = 1_024  # about as many queries, and items, in one cell
ITEM_BLOCK = 8_192
WIDE_QUERIES, WIDE_ITEMS = 16_384, 24_576  # the same for vectors of many components: larger cells mean fewer copies
FEW = 2_048  # sides with fewer vectors per block than this are not cut further
SIDE = 8  # blocks of a side, if it has enough vectors, so that small tables spread too
TILE = 1 << 22  # scores held at once
ROWS = 128  # vectors whose bounds to all centres are held at once
SCORE_DIGITS = 9
CENTRES = 4_096  # at most so many items are collected as centres
PRUNE_FROM = 16  # blocks of items; with fewer, comparing all costs less than another round
PRUNE_WIDTH = 16  # components; with more, centre and radius bound too little to reject parts


def _scores(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    """Score of each row of ``x`` with the same row of ``y``; larger is nearer: dot product, or negative squared distance."""
    if metric == "dot":
        return np.round(np.einsum("ij,ij->i", x, y), SCORE_DIGITS)
    out = np.zeros(len(x))
    for d in range(x.shape[1]):
        out -= (x[:, d] - y[:, d]) ** 2
    return np.round(out, SCORE_DIGITS)


class Screen:
    """Scores of rows with all items by matrix products, and by how much they may be wrong.

    Dot products come in single precision, distances in double; only what they can't rule out is scored exactly.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, metric: str):
        largest = max(np.abs(x).max(initial=0.0), np.abs(y).max(initial=0.0))
        self.kind = np.float32 if metric == "dot" and largest < 1e15 else np.float64
        self.x, self.y, self.metric = x.astype(self.kind, copy=False), y.astype(self.kind, copy=False), metric
        self.x_norm, self.y_norm = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
        top = self.y_norm.max(initial=0.0)
        size = self.x_norm * top if metric == "dot" else 4 * (self.x_norm + top) ** 2
        self.error = (x.shape[1] + 8) * np.finfo(self.kind).eps * size

    def scores(self, rows: slice) -> np.ndarray:
        s = self.x[rows] @ self.y.T
        if self.metric == "dot":
            return s
        s *= 2
        s -= self.x_norm[rows, None] ** 2
        s -= self.y_norm[None, :] ** 2
        return s

    def candidates(self, rows: slice, k: int, min_score: float | None) -> tuple[np.ndarray, np.ndarray]:
        """(row, item) of all pairs that may be among the ``k`` best of a row; there may be more."""
        s = self.scores(rows)
        n, error = s.shape[1], self.error[rows]
        least = np.full(len(s), -np.inf)
        if n > k:
            # maxima of disjoint groups of items: the k-th is no better than the k-th best item
            groups = max(512, 2 * k)
            tops = s[:, : n - n % groups].reshape(len(s), -1, groups).max(axis=1) if n >= 2 * groups else s
            least = np.partition(tops, tops.shape[1] - k, axis=1)[:, tops.shape[1] - k].astype(float)
        if min_score is not None:
            least = np.maximum(least, min_score)
        least = np.nextafter((least - 2 * error - 2 * 10.0**-SCORE_DIGITS).astype(self.kind), self.kind(-np.inf))
        at = np.flatnonzero(s >= least[:, None])
        return at // n, at % n


def _best(x: np.ndarray, y: np.ndarray, k: int, metric: str, min_score, same: Callable | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``x``, row of ``y``, score) of the best ``k`` items per query, ties in item order.

    ``same`` tells for pairs whether a query and an item are the same, which doesn't count as found.
    """
    screen, found = Screen(x, y, metric), []
    step = max(1, TILE // len(y))
    for start in range(0, len(x), step):
        rows = slice(start, min(len(x), start + step))
        at_x, at_y = screen.candidates(rows, k + (same is not None), min_score)
        at_x += start
        some = max(1, TILE // (4 * x.shape[1])) if x.shape[1] else len(at_x)
        score = np.concatenate([np.empty(0), *[_scores(x[at_x[i : i + some]], y[at_y[i : i + some]], metric) for i in range(0, len(at_x), some)]])
        kept = np.ones(len(score), dtype=bool) if min_score is None else score >= min_score
        if same is not None:
            kept &= ~same(at_x, at_y)
        at_x, at_y, score = at_x[kept], at_y[kept], score[kept]
        order = np.lexsort((at_y, -score, at_x))
        at_x, at_y, score = at_x[order], at_y[order], score[order]
        first = np.arange(len(at_x)) - np.searchsorted(at_x, at_x) < k
        found.append((at_x[first], at_y[first], score[first]))
    return tuple(np.concatenate([f[c] for f in found]) for c in range(3))


def _matrix(column) -> np.ndarray:
    lengths = {len(v) for v in column}
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(lengths)}")
    made = np.vstack([np.asarray(v, dtype=float) for v in column])
    if np.isnan(made).any():
        raise ValueError("a vector holds a null or NaN component")
    return made


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    """An Arrow column of vectors as a matrix."""
    chunks = [c for c in column.chunks if len(c)]
    lengths = sorted({n for c in chunks for n in pc.unique(pc.list_value_length(c)).to_pylist()})
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {lengths}")
    made = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks]).reshape(len(column), -1).astype(float, copy=False)
    if np.isnan(made).any():
        raise ValueError("a vector holds a null or NaN component")
    return made


def _first_copies(y: np.ndarray, k: int) -> np.ndarray:
    """Marks the first ``k`` of equal rows: later ones tie with all of them."""
    codes, _ = pd.factorize(np.array([blake2b(row, digest_size=16).digest() for row in np.ascontiguousarray(y)], dtype=object))
    return (pd.Series(codes).groupby(codes).cumcount() < k).to_numpy()


def nearest(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    metric: str = "dot",
    min_score: float | None = None,
    other_only: bool = False,
) -> DataFrame:
    """(query_id, item_id, score, rank) of the ``k`` best items per query.

    ``queries`` is (query_id, vector) and ``items`` is (item_id, vector). ``other_only`` leaves out
    an item with the query's own id.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    queries, items = queries.select("query_id", "vector"), items.select("item_id", "vector")
    schema = T.StructType(
        [queries.schema["query_id"], items.schema["item_id"], T.StructField("score", T.DoubleType())]
    )
    items = items.where(F.col("vector").isNotNull())
    queries = queries.where(F.col("vector").isNotNull() & F.col("query_id").isNotNull())
    ni = items.select("item_id").count()  # only ids are counted: columns that make vectors are pruned
    some = items.select(F.size("vector")).first()
    blocks = max(1, -(-ni // ITEM_BLOCK))
    if some is not None and some[0] > PRUNE_WIDTH:
        nq = queries.select("query_id").count()
        found = _cells(queries, items, schema, k, metric, min_score, other_only, _side(nq, WIDE_QUERIES), _side(ni, WIDE_ITEMS))
    elif blocks >= PRUNE_FROM:
        found = _pruned(queries, items, schema, k, metric, min_score, other_only, min(blocks, CENTRES))
    else:
        nq = max(1, -(-queries.select("query_id").count() // QUERY_BLOCK))
        found = _cells(queries, items, schema, k, metric, min_score, other_only, nq, blocks)
    return top_n(found, ["query_id"], [F.col("score").desc(), F.col("item_id")], k)


def _side(n: int, block: int) -> int:
    """Number of blocks of a side: bounded ones, and a few at least."""
    return max(1, -(-n // block), min(SIDE, n // FEW))


def _cell(k: int, metric: str, min_score: float | None, other_only: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The best items of a block of queries in a block of items."""

    def cell(q: pa.Table, i: pa.Table) -> pa.Table:
        made = pa.schema([q.schema.field("query_id"), i.schema.field("item_id"), pa.field("score", pa.float64())])
        if not len(q) or not len(i):
            return made.empty_table()
        i = i.select(["item_id", "vector"])
        i = i.take(pc.sort_indices(i["item_id"], null_placement="at_start"))
        x, y = _rows(q["vector"]), _rows(i["vector"])
        if x.shape[1] != y.shape[1]:
            raise ValueError(f"vectors of different lengths: {x.shape[1]} and {y.shape[1]}")
        first = _first_copies(y, k + other_only)
        q_ids, i_ids = q["query_id"].combine_chunks(), i["item_id"].filter(pa.array(first)).combine_chunks()
        same = None
        if other_only:
            same = lambda a, b: pc.fill_null(pc.equal(q_ids.take(pa.array(a)), i_ids.take(pa.array(b))), False).to_numpy(zero_copy_only=False)
        at_q, at_i, score = _best(x, y if first.all() else y[first], k, metric, min_score, same)
        return pa.Table.from_arrays([q_ids.take(pa.array(at_q)), i_ids.take(pa.array(at_i)), pa.array(score)], names=made.names)

    return cell


def _every(n: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(0), (n if isinstance(n, Column) else F.lit(n)) - 1))


def _block(c: str, n: Column | int) -> Column:
    return F.pmod(F.xxhash64(c, "vector"), n if isinstance(n, Column) else F.lit(n)).cast("int")


def _cells(queries, items, schema, k, metric, min_score, other_only, nq, ni) -> DataFrame:
    left = queries.select("*", _block("query_id", nq).alias("qb"), _every(ni).alias("ib"))
    right = items.select("*", _block("item_id", ni).alias("ib"), _every(nq).alias("qb"))
    cell = _cell(k, metric, min_score, other_only)
    return left.groupBy("qb", "ib").cogroup(right.groupBy("qb", "ib")).applyInArrow(cell, schema)


class Parts(NamedTuple):
    """Centres of the parts of the items, how far the items of each reach, and their number."""

    centres: np.ndarray
    radius: np.ndarray
    counts: np.ndarray

    def distances(self, x: np.ndarray) -> np.ndarray:
        if x.shape[1] != self.centres.shape[1]:
            raise ValueError(f"vectors of different lengths: {x.shape[1]} and {self.centres.shape[1]}")
        squares = (x * x).sum(axis=1)[:, None] + (self.centres**2).sum(axis=1)[None, :] - 2 * x @ self.centres.T
        return np.sqrt(np.maximum(squares, 0.0))

    def bounds(self, x: np.ndarray, metric: str) -> np.ndarray:
        """At least the score of any item of a part, with room for rounding; -inf for parts without items."""
        if metric == "dot":
            top = x @ self.centres.T + np.linalg.norm(x, axis=1)[:, None] * self.radius[None, :]
        else:
            top = -np.maximum(self.distances(x) - self.radius[None, :], 0.0) ** 2
        return np.where(self.counts > 0, top + 1e-8 * (1 + np.abs(top)), -np.inf)

    def first(self, bounds: np.ndarray, k: int) -> np.ndarray:
        """Marks the parts with the best bounds that together hold more than ``k`` items."""
        order = np.argsort(-bounds, axis=1, kind="stable")
        before = np.cumsum(self.counts[order], axis=1) - self.counts[order]
        marked = np.zeros(bounds.shape, dtype=bool)
        np.put_along_axis(marked, order, before <= k, axis=1)
        return marked & (self.counts > 0)


def parted(items: DataFrame, centres: int) -> tuple[DataFrame, Parts]:
    """``items`` with their ``part``, written, and what bounds the parts. Centres are the items with the least hashes."""
    spark = items.sparkSession
    sample = items.orderBy(F.xxhash64("item_id"), "item_id").limit(centres).select("vector").collect()
    points = np.unique(_matrix([r[0] for r in sample]), axis=0)
    none = Parts(points, np.zeros(len(points)), np.zeros(len(points), dtype=np.int64))
    shared = spark.sparkContext.broadcast(none)
    schema = T.StructType([*items.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("gap", T.DoubleType())])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for start in range(0, len(rows), ROWS):
                some = rows.iloc[start : start + ROWS]
                far = shared.value.distances(_matrix(some["vector"]))
                part = far.argmin(axis=1)
                yield some.assign(part=part.astype(np.int32), gap=np.take_along_axis(far, part[:, None], axis=1)[:, 0])

    table = cut(items.mapInPandas(assign, schema))
    radius, counts = none.radius.copy(), none.counts.copy()
    for r in table.groupBy("part").agg(F.max("gap").alias("gap"), F.count(F.lit(1)).alias("n")).collect():  # a row per centre
        # distances come from squares: what cancels there grows with the size of the vectors
        radius[r.part], counts[r.part] = r.gap + 1e-6 * (1 + np.abs(points).max() * np.sqrt(points.shape[1])), r.n
    return table.drop("gap"), Parts(points, radius, counts)


def visits(queries: DataFrame, parts: Parts, k: int, metric: str, floor: bool) -> DataFrame:
    """(query_id, part): the parts that a query meets first, or, with its ``floor``, in the second round."""
    shared = queries.sparkSession.sparkContext.broadcast(parts)
    schema = T.StructType([queries.schema["query_id"], T.StructField("part", T.IntegerType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for start in range(0, len(rows), ROWS):
                some = rows.iloc[start : start + ROWS]
                bounds = shared.value.bounds(_matrix(some["vector"]), metric)
                marked = shared.value.first(bounds, k)
                if floor:
                    least = some["floor"].to_numpy(dtype=float)[:, None]
                    marked = ~marked & (shared.value.counts > 0) & (bounds >= least)
                at, part = np.nonzero(marked)
                yield pd.DataFrame({"query_id": some["query_id"].to_numpy()[at], "part": part.astype(np.int32)})

    return queries.mapInPandas(run, schema)


def _met(queries, met, table, parts, schema, cell) -> DataFrame:
    """The best items of the parts that queries meet; a part's queries and items meet in blocks."""
    spark = queries.sparkSession
    sizes = [(k, max(1, -(-int(n) // ITEM_BLOCK))) for k, n in enumerate(parts.counts)]
    sizes = F.broadcast(spark.createDataFrame(sizes, "part int, ni int"))  # a row per centre
    guests = met.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("nq"))
    sizes = F.broadcast(guests.join(sizes, "part"))
    asked = met.withColumnRenamed("query_id", "_id").join(queries, F.col("_id").eqNullSafe(F.col("query_id"))).drop("_id")
    left = asked.join(sizes, "part").select("query_id", "vector", "part", _block("query_id", F.col("nq")).alias("qb"), _every(F.col("ni")).alias("ib"))
    right = table.join(sizes, "part").select("item_id", "vector", "part", _block("item_id", F.col("ni")).alias("ib"), _every(F.col("nq")).alias("qb"))
    keys = ["part", "qb", "ib"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, schema)


def _pruned(queries, items, schema, k, metric, min_score, other_only, centres) -> DataFrame:
    table, parts = parted(items, centres)
    cell = _cell(k, metric, min_score, other_only)
    once = cut(visits(queries, parts, k, metric, False))
    best = top_n(_met(queries, once, table, parts, schema, cell), ["query_id"], [F.col("score").desc(), F.col("item_id")], k)
    best = cut(best.select("query_id", "item_id", "score"))
    # fewer than k items so far: whatever the least score allows may still come
    least = F.when(F.count(F.lit(1)) >= k, F.min("score"))
    floors = best.groupBy(F.col("query_id").alias("_id")).agg(least.alias("floor"))
    lowest = F.lit(float("-inf") if min_score is None else float(min_score))
    again = queries.join(floors, F.col("_id").eqNullSafe(F.col("query_id")), "left").select("query_id", "vector", F.greatest(F.coalesce("floor", lowest), lowest).alias("floor"))
    more = cut(visits(again, parts, k, metric, True))
    return best.unionByName(_met(queries, more, table, parts, schema, cell))
