"""Document fingerprints: threshold-scaled sketches.

A sketch keeps every 64-bit shingle hash below a fixed fraction (one in ``scale``) of the range, so its size
follows the text and two texts keep exactly the same part of what they share, however unequal they are.
Shares of sketches estimate shares of shingle sets: ``likeness`` the Jaccard share, ``containment`` the part of
one that lies in the other. Sketches merge by union (``merged``): the sketch of a source is the set of
hashes of its documents, counted by hash so that no source is gathered in one place.

A shingle is ``width`` successive words (the whole sequence where there are fewer). A text with words of which
no hash lies below the threshold keeps its smallest one, so that only texts without words have an empty
sketch. Null texts count as empty; two empty sketches have likeness and containment 1, an empty and
another one 0. Repeated rows are sketched each, other columns pass through. Texts are read in pieces that end
at a separator: memory is bounded by the text itself and one hash per word.

``edits`` compares every document with an edited text made from its successor. Successors follow ascending
(id, text), null ids first, and the first document succeeds the last; equal rows are successors of each other.
Ids are numbers.
Documents are dealt to ranges of ids, each with a copy of the row that starts the next range, and
streamed in order, so a task holds two texts at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.llm.common import fresh

WIDTH = 5  # words of a shingle
SCALE = 8  # one hash in so many is kept
PIECE = 1 << 20  # bytes of a text read at once
_MEMO = 1 << 18  # words whose hashes a worker keeps
_ROWS = 256  # rows of a batch that leaves a worker
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class _Known(dict):
    """Hashes of words; short words are remembered."""

    def __missing__(self, word: bytes) -> int:
        found = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "big")
        if len(word) <= 64:
            if len(self) >= _MEMO:
                self.clear()
            self[word] = found
        return found


_KNOWN = _Known()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(data: bytes) -> Iterator[np.ndarray]:
    """Hashes of the words of a text, piece by piece."""
    at = 0
    while at < len(data):
        border = _SPACE.search(data, at + PIECE) if len(data) - at > PIECE else None
        end = border.start() if border else len(data)
        words = data[at:end].split()
        if words:
            yield np.fromiter(map(_KNOWN.__getitem__, words), dtype=np.uint64, count=len(words))
        at = end


def sketched(text: str | None, width: int = WIDTH, scale: int = SCALE) -> np.ndarray:
    """The sorted hashes that the sketch of a text keeps."""
    factors = _mixed(np.arange(1, width + 2, dtype=np.uint64)) | np.uint64(1)
    limit = np.uint64(2**64 // scale - 1)
    kept, least, before, n = [], None, np.empty(0, dtype=np.uint64), 0
    for words in _words((text or "").encode()):
        n += len(words)
        words = np.concatenate([before, words])
        if len(words) >= width:
            at = len(words) - width + 1
            x = np.repeat(factors[width:] * np.uint64(width), at)
            for k in range(width):
                x += words[k : k + at] * factors[k]
            x = _mixed(x)
            kept.append(x[x <= limit])
            least = x.min() if least is None else min(least, x.min())
        before = words[max(0, len(words) - width + 1) :]
    if 0 < n < width:
        x = _mixed((before * factors[:n]).sum(dtype=np.uint64, keepdims=True) + factors[width:] * np.uint64(n))
        kept, least = [x[x <= limit]], x[0]
    found = np.unique(np.concatenate(kept)) if kept else np.empty(0, dtype=np.uint64)
    return found if len(found) or least is None else np.array([least], dtype=np.uint64)


def shared(a: np.ndarray, b: np.ndarray) -> float:
    """The part of two sketches' union that both hold."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def written(sketch: np.ndarray) -> str:
    """A sketch as text: 16 hexadecimal digits a hash, ascending."""
    return sketch.astype(">u8").tobytes().hex()


def fingerprints(docs: DataFrame, text: str = "text", into: str = "sketch", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """``docs`` with the sketch of every text, an ascending array of longs (hashes as signed numbers)."""
    kept = [c for c in docs.columns if c != into]
    (held,) = fresh(docs, "_text")
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(into, T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                made = [sketched(t, width, scale).view(np.int64) for t in part.column(held).to_pylist()]
                arrays = [part.column(c) for c in kept] + [pa.array(made, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, into])

    return docs.select(*kept, docs[text].alias(held)).mapInArrow(run, schema)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard share of two texts, from their sketches."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated part of the first text's shingles that the second one holds."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) > 0, both / F.size(a)).otherwise(F.when(F.size(b) == 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def merged(sketches: DataFrame, *keys: str, sketch: str = "sketch") -> DataFrame:
    """The union of the sketches of every group, a row per hash: ``keys``, ``hash`` and ``n``, the rows that hold it."""
    rows = sketches.select(*keys, F.explode(sketch).alias("hash"))
    return rows.groupBy(*keys, "hash").agg(F.count(F.lit(1)).alias("n"))


def contained(sketches: DataFrame, groups: DataFrame, id: str, *keys: str, sketch: str = "sketch") -> DataFrame:
    """For every row and every group of ``merged`` that shares a hash with it: ``id``, ``keys`` and ``containment``.

    The join is on the hash; a hash that a third of all rows hold meets as many rows as there are groups, which
    the join's skew handling deals to several tasks.
    """
    rows = sketches.select(F.col(id), F.size(sketch).alias("_size"), F.explode(sketch).alias("hash"))
    met = rows.join(groups.select(*keys, "hash"), "hash").groupBy(id, *keys).agg(F.count(F.lit(1)).alias("_n"), F.max("_size").alias("_size"))
    return met.select(id, *keys, (F.col("_n") / F.col("_size")).alias("containment"))


def _range_of(value: Column, bounds: list) -> Column:
    """How many of the ascending ``bounds`` a value has reached; none for null. Found by halving steps."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    values = F.array(*[F.lit(b) for b in bounds])
    reached = lambda at: (at <= len(bounds)) & (F.element_at(values, F.least(at, F.lit(len(bounds)))) <= value)
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(reached(at + s), at + s).otherwise(at))
    return F.coalesce(F.when(value.isNotNull(), found), F.lit(0))


def edits(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """Every document beside its edited text, whose last floor(n / 2) code points are the first ones of its successor.

    One row per row of ``docs``: the id, ``n_chars``, ``edited_sha256``, ``fingerprint`` and ``edited_fingerprint``
    (sketches as text), ``near_edited`` and ``near_next``, the likeness to the edited text and to the successor.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 4 * parts  # several ranges a task even out their sizes
    cuts = F.percentile_approx("id", [k / n for k in range(1, n)], 10 * n).alias("cuts")
    # at most n ids reach the driver
    ends = rows.agg(cuts, F.min("id").alias("low"), F.count(F.when(F.col("id").isNull(), 1)).alias("nulls")).first()
    bounds = sorted({b for b in ends.cuts or [] if b > ends.low})
    dealt = rows.select(_range_of(F.col("id"), bounds).alias("range"), F.lit(0).alias("ahead"), "id", "text")
    # the row that starts a range also ends the range before it; the very first one ends the last
    starts = rows.where(F.col("id").isin(bounds)).groupBy("id").agg(F.min("text").alias("text"))
    starts = starts.select((_range_of(F.col("id"), bounds) - 1).alias("range"), F.lit(1).alias("ahead"), "id", "text")
    first = rows.where(F.col("id").isNull() if ends.nulls else F.col("id") == F.lit(ends.low))
    first = first.groupBy("id").agg(F.min("text").alias("text")).select(F.lit(len(bounds)).alias("range"), F.lit(1).alias("ahead"), "id", "text")
    dealt = dealt.unionByName(starts).unionByName(first)
    order = ["range", "ahead", F.asc_nulls_first("id"), "text"]
    dealt = dealt.repartition(parts, "range").sortWithinPartitions(*order)
    kind = docs.schema[id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[list] = [[] for _ in range(7)]

        def batch() -> pa.RecordBatch:
            kinds = [made_id.type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds)], names)
            for c in made:
                c.clear()
            return out

        held = None  # (range, id, text, sketch) of a row that waits for its successor
        made_id = pa.array([], pa.int64())
        for got in batches:
            made_id = got.column("id")
            for part, ahead, key, body in _rows(got, "range", "ahead", "id", "text"):
                if ahead and (held is None or held[0] != part):
                    continue  # another copy of the range's end
                sketch = sketched(body, width, scale)
                if held is not None and held[0] == part:
                    for column, value in zip(made, _compared(*held[1:], body, sketch, width, scale)):
                        column.append(value)
                    if len(made[0]) >= _ROWS:
                        yield batch()
                held = None if ahead else (part, key, body, sketch)
        if made[0]:
            yield batch()

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("n_chars", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in names[2:5]]
        + [T.StructField(c, T.DoubleType()) for c in names[5:]]
    )
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id)


def _rows(batch: pa.RecordBatch, *names: str) -> Iterable[tuple]:
    for start in range(0, batch.num_rows, _ROWS):
        part = batch.slice(start, _ROWS)
        yield from zip(*(part.column(n).to_pylist() for n in names))


def _compared(key, body: str, sketch: np.ndarray, later: str, later_sketch: np.ndarray, width: int, scale: int) -> tuple:
    half = len(body) // 2
    edited = body[: len(body) - half] + later[:half]
    changed = sketched(edited, width, scale)
    digest = hashlib.sha256(edited.encode()).hexdigest()
    return key, len(body), digest, written(sketch), written(changed), shared(sketch, changed), shared(sketch, later_sketch)
