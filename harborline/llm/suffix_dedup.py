"""Suffix-array dedup: bytes covered by a long string that starts somewhere else too.

Texts are UTF-8 bytes. With ``length`` = 400, a byte goes when a 400-byte string that covers it starts at any other
place, in the same text or another; matches never cross texts.

1. Every text is winnowed: of the 32-byte grams in each window of 400 bytes, the one with the lowest hash is an
   *anchor*. Equal windows choose the same anchor at the same offset, so two equal 400-byte strings meet in
   the group of one anchor hash. About one byte in 185 is an anchor.
2. An anchor's *context* is all bytes of 400-byte strings that hold it: 368 before, 400 after its start. Equal
   contexts (128-bit digests) fall together with their count; where it is two or more, all their strings repeat.
3. The distinct contexts of a group are suffix-sorted: suffixes that start at the anchor, and reversed
   prefixes that end there. A comparison finds the common extension by binary search over prefix
   polynomial hashes, so that it takes a logarithmic number of steps, in a mergesort; every neighbours'
   extension is then compared byte by byte, and a collision is repaired with the bytes.
   A string with l bytes before the anchor repeats if another context falls in the same class of
   prefixes of length l and the same class of suffixes of length 400 - l: both are runs of the two orders.
4. Groups with more than ``GROUP`` distinct contexts aren't sorted in one task: their strings are hashed (128 bits),
   spread over all tasks and counted, in two steps. First ranges of ``RANGE`` strings: what all of a range share
   must repeat, or none of them does; what they cover together repeats, and all of them do. Only ranges
   between these are then hashed string by string. The result is the same.
5. Spans of repeated strings go back to the texts and are merged there.

Work is shared by equal texts: anchors carry the text's digest, and results are joined by it. Null counts as
empty, texts under 400 bytes keep all bytes. Equal rows and rows that share an id are texts of their own, and
repeat each other. Texts with long runs of one byte make many anchors with one context and stay linear.
Extra columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.llm.common import cut

GRAM = 32
GROUP = 2_000  # distinct contexts of one anchor that a task sorts
RANGE = 20  # strings of a large group's context that are judged together
NAMED_BITS = 1 << 20  # of the table of texts to read again
_BASE = 0x9E3779B97F4A7C15
_PRIME = np.uint64((1 << 31) - 1)
_CHUNK = 4 << 20  # bytes of text that are winnowed at once


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the 32-byte gram at each position, by doubling."""
    h, step = raw.astype(np.uint64) + np.uint64(1), 1
    power = _BASE
    while step < GRAM:
        h = h[:-step] * np.uint64(power) + h[step:]
        power = power * power & ((1 << 64) - 1)
        step *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes of the anchors of a text."""
    if len(raw) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    window = length - GRAM + 1
    found, hashes = [], []
    data = np.frombuffer(raw, dtype=np.uint8)
    for start in range(0, len(raw) - length + 1, _CHUNK):  # parts overlap by a window
        h = _gram_hashes(data[start : start + _CHUNK + length - 1])
        value = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)  # ties: the first
        low, span = value, 1
        while span * 2 <= window:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[: len(low) - (window - span)], low[window - span :])
        at = np.unique(low & np.uint64((1 << 24) - 1)).astype(np.int64)
        found.append(at + start)
        hashes.append(h[at])
    at, first = np.unique(np.concatenate(found), return_index=True)
    return at, np.concatenate(hashes)[first]


class Context:
    """Bytes around an anchor, with prefix hashes of the part after and, reversed, of the part before."""

    __slots__ = ("before", "after", "h_before", "h_after")

    def __init__(self, before: bytes, after: bytes):
        self.before, self.after = before[::-1], after
        self.h_before, self.h_after = _prefix_hashes(self.before), _prefix_hashes(after)


_POWERS = [1]
for _ in range(4096):
    _POWERS.append(_POWERS[-1] * 911_382_323 % int(_PRIME))
_POWER_ARRAY = np.array(_POWERS, dtype=np.uint64)


def _prefix_hashes(raw: bytes) -> list[int]:
    """Polynomial hash of each prefix, modulo a prime: sum of byte * power."""
    data = np.frombuffer(raw, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.cumsum(data * _POWER_ARRAY[: len(data)] % _PRIME, dtype=np.uint64) % _PRIME
    return [0, *sums.tolist()]


def _extension(a: bytes, b: bytes, ha: list[int], hb: list[int]) -> int:
    """Length of the longest common prefix, by binary search over prefix hashes."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if ha[mid] == hb[mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _sorted(texts: list[bytes], hashes: list[list[int]]) -> tuple[list[int], list[int]]:
    """Order of the texts by mergesort, and the common extension of each with the one before it."""

    def less(i: int, j: int) -> bool:
        a, b = texts[i], texts[j]
        n = _extension(a, b, hashes[i], hashes[j])
        return a[n : n + 1] < b[n : n + 1]

    order = list(range(len(texts)))
    width = 1
    while width < len(order):
        merged = []
        for start in range(0, len(order), 2 * width):
            left, right = order[start : start + width], order[start + width : start + 2 * width]
            i = j = 0
            while i < len(left) and j < len(right):
                if less(right[j], left[i]):
                    merged.append(right[j])
                    j += 1
                else:
                    merged.append(left[i])
                    i += 1
            merged += left[i:] + right[j:]
        order, width = merged, 2 * width
    extensions, sound = [0], True
    for i, j in zip(order, order[1:]):
        a, b = texts[i], texts[j]
        n = _extension(a, b, hashes[i], hashes[j])
        sound = sound and a[:n] == b[:n] and (a[n:] == b[n:] == b"" or a[n : n + 1] != b[n : n + 1]) and a <= b
        extensions.append(n)
    if not sound:  # two different strings with one hash: compare the bytes themselves
        order = sorted(range(len(texts)), key=texts.__getitem__)
        extensions = [0]
        for i, j in zip(order, order[1:]):
            a, b = texts[i], texts[j]
            extensions.append(next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))))
    return order, extensions


def repeated_offsets(contexts: list[Context], length: int) -> list[np.ndarray]:
    """For each of several distinct contexts of one anchor: the numbers l of bytes before the anchor for which
    the string of ``length`` bytes that starts there is in another context as well."""
    most = length - GRAM
    n = len(contexts)
    ls = np.arange(most + 1)
    key = np.zeros((n, most + 1), dtype=np.int64)
    fits = np.ones((n, most + 1), dtype=bool)
    for side, need in (("before", ls), ("after", length - ls)):
        texts = [getattr(c, side) for c in contexts]
        order, ext = _sorted(texts, [getattr(c, f"h_{side}") for c in contexts])
        runs = np.cumsum(np.array(ext)[:, None] < need[None, :], axis=0)  # class of each length, in sorted order
        classes = np.empty_like(runs)
        classes[order] = runs
        key = key * (n + 1) + classes
        fits &= np.array([len(t) for t in texts])[:, None] >= need[None, :]
    key = np.where(fits, key, -1 - np.arange(n)[:, None])  # strings that the text is too short for equal nothing
    by = np.sort(key, axis=0)
    rank = np.argsort(key, axis=0, kind="stable")
    same = by[1:] == by[:-1]
    twice = np.zeros_like(key, dtype=bool)
    hit = np.zeros_like(key, dtype=bool)
    hit[1:] |= same
    hit[:-1] |= same
    np.put_along_axis(twice, rank, hit, axis=0)
    return [np.flatnonzero(row) for row in twice]


def _runs(ls: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Spans (start, end) relative to the anchor that strings with these numbers of bytes before it cover."""
    if not len(ls):
        return []
    starts = np.sort(-ls)
    gaps = np.flatnonzero(np.diff(starts) > length)
    first = np.concatenate([[0], gaps + 1])
    last = np.concatenate([gaps, [len(starts) - 1]])
    return [(int(starts[a]), int(starts[b]) + length) for a, b in zip(first, last)]


def _text_digest(raw: bytes) -> bytes:
    return hashlib.sha256(raw).digest()[:16]


def text_digest(text: Column) -> Column:
    """The same digest as a column."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """One row per anchor of each text: hash, context digest, text digest, position, bytes before and after."""
    most = length - GRAM
    names = ["anchor", "context", "digest", "at", "before", "after"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in names]
        for batch in batches:
            for text in batch.column("text"):
                raw = text.as_buffer().to_pybytes()
                at, h = anchors(raw, length)
                if not len(at):
                    continue
                before, after = np.minimum(at, most), np.minimum(len(raw) - at, length)
                held[0] += h.view(np.int64).tolist()
                held[1] += [
                    xxhash.xxh3_128_digest(raw[p - x : p + y] + x.to_bytes(4, "little"))
                    for p, x, y in zip(at.tolist(), before.tolist(), after.tolist())
                ]
                held[2] += [_text_digest(raw)] * len(at)
                held[3] += at.tolist()
                held[4] += before.tolist()
                held[5] += after.tolist()
                if len(held[0]) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(held, kinds)], names)
                    held = [[] for _ in names]
        if held[0]:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(held, kinds)], names)

    return docs.mapInArrow(run, "anchor long, context binary, digest binary, at long, before int, after int")


def _with_bytes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes (pre, post) of wanted contexts, read again from the texts.

    A bit table of fixed size keeps texts that hold none of them out of the shuffle.
    """
    most = length - GRAM
    spots = wanted.groupBy("digest").agg(F.collect_list(F.struct("anchor", "context", "at")).alias("spots"))
    bit = F.pmod(F.xxhash64("digest"), F.lit(NAMED_BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    table = [0] * (NAMED_BITS // 64)
    for k, v in wanted.groupBy((bit / 64).cast("int")).agg(F.bit_or(one)).collect():  # at most NAMED_BITS / 64 rows
        table[k] = v
    bits = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
    texts = docs.select(text_digest(F.col("text")).alias("digest"), "text")
    texts = texts.where(F.get(bits, (bit / 64).cast("int")).bitwiseAND(one) != 0).dropDuplicates(["digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, spots in zip(batch.column("text"), batch.column("spots")):
                raw, found = text.as_buffer().to_pybytes(), spots.as_py()
                at = [s["at"] for s in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([s["anchor"] for s in found], pa.int64()),
                        pa.array([s["context"] for s in found], pa.binary()),
                        pa.array([raw[max(x - most, 0) : x] for x in at], pa.binary()),
                        pa.array([raw[x : x + length] for x in at], pa.binary()),
                    ],
                    ["anchor", "context", "pre", "post"],
                )

    joined = texts.join(spots, "digest").select("text", "spots")
    return joined.mapInArrow(run, "anchor long, context binary, pre binary, post binary")


def _marked_by_sorting(contexts: DataFrame, length: int) -> DataFrame:
    """Spans relative to the anchor of strings that another context of the group holds, by suffix sorting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(n).to_pylist() for n in ("anchor", "context", "pre", "post"))))
        out: list[tuple] = []
        for anchor, group in groupby(rows, key=lambda r: r[0]):
            members = list(group)
            if len(members) > 1:
                offsets = repeated_offsets([Context(m[2], m[3]) for m in members], length)
                out += [(anchor, m[1], *run) for m, ls in zip(members, offsets) for run in _runs(ls, length)]
            if len(out) >= 10_000:
                yield _mark_batch(out)
                out = []
        if out:
            yield _mark_batch(out)

    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "anchor long, context binary, start int, end int")


def _mark_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["anchor", "context", "start", "end"])


def _marked_by_hashing(contexts: DataFrame, length: int) -> DataFrame:
    """The same spans for groups too large for one task: hashes are dealt out and counted.

    ``contexts`` should be a written table: both steps read it.
    """
    most = length - GRAM
    fields = ("anchor", "context", "pre", "post")
    digest = xxhash.xxh3_128_digest

    def fitting(pre: bytes, post: bytes, low: int, high: int) -> tuple[int, int]:
        """The part of [low, high] of bytes before the anchor for which the text has a whole string."""
        return max(low, length - len(post)), min(high, len(pre), most)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for anchor, context, pre, post in zip(*(batch.column(n).to_pylist() for n in fields)):
                for k, low in enumerate(range(0, most + 1, RANGE)):
                    high = min(low + RANGE - 1, most)
                    first, last = fitting(pre, post, low, high)
                    if first > last:
                        continue
                    at = len(pre)
                    core = digest(pre[at - low :] + post[: length - high]) if low else digest(post[: length - high])
                    whole = digest(pre[at - high :] + post[: length - low]) if (first, last) == (low, high) else None
                    out.append((anchor, context, k, core, whole))
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], ["anchor", "context", "k", "core", "whole"])

    judged = cut(contexts.mapInArrow(ranges, "anchor long, context binary, k int, core binary, whole binary"))
    cores = judged.groupBy("anchor", "k", "core").count().where("count > 1").drop("count")
    live = judged.join(cores, ["anchor", "k", "core"])
    wholes = live.where("whole is not null").groupBy("anchor", "k", "whole").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("context"))
    wholes = cut(wholes.where("n > 1"))
    same = live.join(wholes.select("anchor", "k", "whole"), ["anchor", "k", "whole"], "left_semi").select("anchor", "context", "k")
    low, high = F.col("k") * RANGE, F.least(F.col("k") * RANGE + RANGE - 1, F.lit(most))
    all_of = same.select("anchor", "context", (-high).alias("start"), (length - low).alias("end"))
    # one context stands for those with an equal range; the others are compared with it string by string
    open_ranges = live.join(wholes.select("anchor", "k", "whole"), ["anchor", "k", "whole"], "left_anti").select("anchor", "context", "k")
    asked = open_ranges.unionByName(wholes.select("anchor", "context", "k")).groupBy("anchor", "context").agg(F.collect_set("k").alias("ks"))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for anchor, context, pre, post, ks in zip(*(batch.column(n).to_pylist() for n in (*fields, "ks"))):
                both, at = pre + post, len(pre)
                for k in ks:
                    first, last = fitting(pre, post, k * RANGE, k * RANGE + RANGE - 1)
                    out += [(anchor, context, x, digest(both[at - x : at - x + length])) for x in range(first, last + 1)]
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], ["anchor", "context", "l", "string"])

    hashed = contexts.join(asked, ["anchor", "context"]).mapInArrow(strings, "anchor long, context binary, l int, string binary")
    hashed = cut(hashed)
    twice = hashed.groupBy("anchor", "l", "string").count().where("count > 1").drop("count")
    found = hashed.join(twice, ["anchor", "l", "string"], "left_semi")
    single = found.select("anchor", "context", (-F.col("l")).alias("start"), (length - F.col("l")).alias("end"))
    return all_of.unionByName(single)


def repeated_spans(docs: DataFrame, length: int = 400, group: int = GROUP) -> DataFrame:
    """Repeated spans of the texts of ``docs`` (text): ``digest`` of the text, ``spans`` (s, e) sorted by start."""
    rows = _anchor_rows(docs, length)
    counted = rows.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("digest", "at", "before", "after")).alias("spot")
    )
    whole = Window.partitionBy("anchor")
    counted = counted.withColumn("contexts", F.count(F.lit(1)).over(whole)).withColumn("lone", F.min("n").over(whole) == 1)
    counted = cut(counted.where("n > 1 or contexts > 1"))
    wanted = counted.where("lone and contexts > 1").select("anchor", "context", "contexts", "spot.digest", "spot.at")
    few = wanted.where(F.col("contexts") <= group)
    marks = _marked_by_sorting(_with_bytes(docs, few, length), length)
    many = wanted.where(F.col("contexts") > group)
    if not many.isEmpty():
        marks = marks.unionByName(_marked_by_hashing(cut(_with_bytes(docs, many, length)), length))
    repeats = counted.where("n > 1").select("anchor", "context", (-F.col("spot.before")).alias("start"), F.col("spot.after").alias("end"))
    marks = cut(repeats.unionByName(marks))
    placed = rows.select("anchor", "context", "digest", "at").join(marks, ["anchor", "context"])
    placed = placed.select("digest", (F.col("at") + F.col("start")).alias("s"), (F.col("at") + F.col("end")).alias("e")).distinct()
    return placed.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("spans"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, group: int = GROUP) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``spans`` (start, end: maximal removed runs), ``kept`` (bytes)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = repeated_spans(docs.select("text"), length, group)
    joined = docs.withColumn("digest", text_digest(F.col("text"))).join(found, "digest", "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType(
        [T.StructField("doc_id", kind), T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(span)), T.StructField("kept", T.BinaryType())]
    )
    arrow_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                sizes, spans, kept = [], [], []
                for text, marks in zip(batch.column("text"), batch.column("spans").to_pylist()):
                    raw = text.as_buffer().to_pybytes()
                    runs = _merged([(m["s"], m["e"]) for m in marks or []])
                    ends = [0, *(e for _, e in runs)]
                    starts = [*(s for s, _ in runs), len(raw)]
                    sizes.append(len(raw))
                    spans.append([{"start": s, "end": e} for s, e in runs])
                    kept.append(b"".join(raw[a:b] for a, b in zip(ends, starts)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, arrow_span), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"],
                )

    return joined.mapInArrow(run, schema)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans joined where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for s, e in spans:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out
