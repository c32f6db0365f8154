"""N-gram Jaccard join with signature trees.

A document is the set of its distinct 3-word shingles (64-bit hashes); two documents link when
``100 * intersection >= similarity * union``. Equal sets fall together first and are one node.

* A set that reaches the similarity with another shares a shingle with it among its first
  n - ceil(similarity * n) + 1, in one order for all sets. The order is from rare to frequent, by a table of
  shingle counts with a fixed number of buckets. Each such shingle that two or more sets have makes a *bucket*.
* In a bucket a signature tree is built: members sorted by size, leaves of a few sets, and nodes with the
  OR of their members' bitmaps, their size range and the largest excess of shingles over bits. Two trees
  (or one with itself) are walked together and a pair of nodes is left when its size ranges don't meet, when
  popcount(OR & OR) + excess, the most that any two members can share, is below the needed overlap, or
  when all members are connected already. Members that meet in leaves must also pass a bound on their
  symmetric difference from parity maps, which holds for sets far larger than the bitmaps. What passes
  *may match*; only pairs that connect something new leave the task, fewer than the bucket has members.
* Buckets above ``BLOCK`` members are dealt out in blocks, and pairs of blocks are tasks of their own.
* Components of the pairs that may match are *families*. Every family's whole sets are read again from the
  documents, once each, and all its pairs are verified exactly inside tasks, again in pairs of blocks; links
  that connect something new leave the task. No pair of a family becomes a row otherwise. A family of several
  blocks is first parted by parity maps as wide as the sets, among sets of sizes near enough, and in what stays that large a set travels as its difference from one set of the family, the hub, which every cell gets once.

Nulls, empty texts and texts without words have an empty set and link with nothing. A null id takes part, but
never names a component unless the class has nothing else (then the component is null). Rows that share an
id are compared each by its own text; equal rows fall together and each keeps its row. Very long texts are
whole; a text's words are held once in a task. Only the id and text columns are read, extra columns are not.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import components, cut, fresh, row_key

COUNT_BUCKETS = 1 << 18  # of the shingle counts
COUNT_RUN = 1 << 12  # buckets that travel as one row
NAMED_BITS = 1 << 22  # of the table of documents to verify
SIGNATURE = 512  # bits of a bitmap and of a parity map
BLOCK = 512  # members of a bucket that one task compares
ELEMENTS = 1 << 20  # shingles of a family's block, about
MAP_ELEMENTS = 1 << 24  # shingles whose parity maps make a block, about
HUB_BYTES = 64 << 20  # of all families' hubs together, up to which they are broadcast
LEAF = 8
_P = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, width: int = 3) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text (the whole sequence, if it has fewer words)."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and space with \t \n \v \f \r
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    take = min(width, len(h))
    x = np.full(len(h) - take + 1, take, dtype=np.uint64)
    for k in range(take):
        x = _mix(x * _P[0] + h[k : len(h) - take + 1 + k] * _P[1] + _P[2])
    return np.unique(x)


def _rows(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _counts(docs: DataFrame, width: int) -> np.ndarray:
    """Shingle counts of all documents by hash bucket, summed in runs of COUNT_RUN; the driver gets one row a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNT_BUCKETS, dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                texts = batch.column("text").slice(start, 256).to_pylist()
                at = np.concatenate([shingle_set(t, width) for t in texts]) % np.uint64(COUNT_BUCKETS)
                total += np.bincount(at.astype(np.int64), minlength=COUNT_BUCKETS)
        parts = total.reshape(-1, COUNT_RUN)
        found = [k for k, part in enumerate(parts) if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array([parts[k].tobytes() for k in found], pa.binary())], ["k", "c"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for k, part in _rows(batches, "k", "c"):
            sums[k] = sums.get(k, 0) + np.frombuffer(part, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([c.tobytes() for c in sums.values()], pa.binary())], ["k", "c"])

    table = np.zeros((COUNT_BUCKETS // COUNT_RUN, COUNT_RUN), dtype=np.int64)
    found = docs.select("text").mapInArrow(run, "k long, c binary").repartition("k").mapInArrow(summed, "k long, c binary")
    for row in found.collect():
        table[row.k] += np.frombuffer(row.c, dtype=np.int64)
    return table.reshape(-1)


def _signature(s: np.ndarray) -> bytes:
    """Bitmap of a set and, behind it, the parity of the members of each bit."""
    counts = np.bincount(((s >> np.uint64(20)) % np.uint64(SIGNATURE)).astype(np.int64), minlength=SIGNATURE)
    return np.packbits(counts > 0).tobytes() + np.packbits(counts & 1 == 1).tobytes()


def _sets(docs: DataFrame, width: int, similarity: int) -> DataFrame:
    """One row per document: doc_id, n, node (128-bit digest of the set), prefix and bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(_counts(docs, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            n, node, prefix, bitmap = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, width)
                n.append(len(s))
                if not len(s):
                    node.append(None), prefix.append(None), bitmap.append(None)
                    continue
                node.append(xxhash.xxh3_128_digest(s.tobytes()))
                keep = len(s) - -(-similarity * len(s) // 100) + 1
                order = np.lexsort((s, counts[(s % np.uint64(COUNT_BUCKETS)).astype(np.int64)]))[:keep]
                prefix.append(s[order].astype(np.int64))
                bitmap.append(_signature(s))
            arrays = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), pa.array(bitmap, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "node", "prefix", "bitmap"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, node binary, prefix array<long>, bitmap binary")


class Tree:
    """Signature tree over members (bitmap and parity map, size), sorted by size.

    ``label`` numbers the components of all members at hand, those of this tree from ``offset`` on; walks change it.
    """

    def __init__(self, signatures: np.ndarray, size: np.ndarray, label: np.ndarray, offset: int = 0):
        self.bits, self.parity = np.split(signatures, 2, axis=1)
        self.size, self.label, self.offset = size, label, offset
        self.excess = size - np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        self.nodes: list[tuple] = []
        self.root = self._build(0, len(size))

    def _build(self, lo: int, hi: int) -> int:
        below = () if hi - lo <= LEAF else (self._build(lo, (lo + hi) // 2), self._build((lo + hi) // 2, hi))
        union = np.bitwise_or.reduce(self.bits[lo:hi], axis=0)
        self.nodes.append((lo, hi, below, union, int(self.size[lo]), int(self.size[hi - 1]), int(self.excess[lo:hi].max())))
        return len(self.nodes) - 1

    def labels(self, lo: int, hi: int) -> np.ndarray:
        return self.label[self.offset + lo : self.offset + hi]


def _needed(a: int, b: int, similarity: int) -> int:
    """The least intersection of sets of sizes a and b that reach the similarity."""
    return -(-similarity * (a + b) // (100 + similarity))


def walk(one: Tree, two: Tree, similarity: int) -> Iterator[tuple[int, int]]:
    """Pairs of members (of ``one``, of ``two``) that may match and connect two components so far apart."""
    stack = [(one.root, two.root)]
    while stack:
        i, j = stack.pop()
        a, b = one.nodes[i], two.nodes[j]
        if 100 * a[5] < similarity * b[4] or 100 * b[5] < similarity * a[4]:
            continue
        most = int(np.bitwise_count(a[3] & b[3]).sum()) + min(a[6], b[6])
        if most < _needed(a[4], b[4], similarity):
            continue
        first = one.label[one.offset + a[0]]
        if (one.labels(a[0], a[1]) == first).all() and (two.labels(b[0], b[1]) == first).all():
            continue
        if not a[2] and not b[2]:
            yield from _leaf_pairs(one, two, a, b, similarity)
        elif one is two and i == j:
            x, y = a[2]
            stack += [(x, y), (y, y), (x, x)]
        elif a[2] and (not b[2] or a[1] - a[0] >= b[1] - b[0]):
            stack += [(x, j) for x in a[2]]
        else:
            stack += [(i, y) for y in b[2]]


def _leaf_pairs(one: Tree, two: Tree, a: tuple, b: tuple, similarity: int) -> Iterator[tuple[int, int]]:
    ok = _close(one, slice(a[0], a[1]), two, slice(b[0], b[1]), similarity)
    yield from joining(one.label, np.argwhere(ok) + (a[0], b[0]), one.offset, two.offset)


def joining(label: np.ndarray, pairs: np.ndarray, left: int, right: int) -> Iterator[tuple[int, int]]:
    """Those of ``pairs`` that connect two components; ``label`` follows. Members start at ``left`` and ``right``."""
    apart = label[pairs[:, 0] + left] != label[pairs[:, 1] + right]
    for x, y in pairs[apart].tolist():
        p, q = label[x + left], label[y + right]
        if p != q:
            label[label == max(p, q)] = min(p, q)
            yield x, y


def _close(one: Tree, a, two: Tree, b, similarity: int) -> np.ndarray:
    """Matrix of pairs whose sizes and bitmaps allow the similarity."""
    na, nb = one.size[a][:, None], two.size[b][None, :]
    ba, bb = one.bits[a][:, None, :], two.bits[b][None, :, :]
    both = np.bitwise_count(ba & bb).sum(axis=2, dtype=np.int64)
    most = both + np.minimum(one.excess[a][:, None], two.excess[b][None, :])
    ok = (100 + similarity) * np.minimum(most, np.minimum(na, nb)) >= similarity * (na + nb)
    apart = np.bitwise_count(one.parity[a][:, None, :] ^ two.parity[b][None, :, :]).sum(axis=2, dtype=np.int64)
    return ok & ((100 + similarity) * apart <= (100 - similarity) * (na + nb))


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` (key, blocks, node, ...) once per cell (key, i, j), i <= j, of their block with any block.

    Side 1 holds block j where it isn't i.
    """
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cell = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    every = F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))
    cells = F.transform(every, lambda k: F.when(k < block, cell(k, block, 1)).otherwise(cell(block, k, 0)))
    return rows.withColumn("_cell", F.explode(cells)).select(key, "_cell.*", *[c for c in rows.columns if c not in (key, "blocks")])


def _found_in_cells(dealt: DataFrame, key: str, payload: str, find) -> DataFrame:
    """Pairs (a, b) of nodes that ``find`` picks: it gets both sides of a cell as lists of (node, n, payload),
    the second empty where a block meets itself, and the payload of side 2 if there is one, and gives pairs of places."""
    names = (key, "i", "j", "side", "node", "n", payload)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, bytes]]:
        for (_, i, j), cell in groupby(_rows(batches, *names), key=lambda r: r[:3]):
            sides: tuple[list, list, list] = ([], [], [])
            for row in cell:
                sides[row[3]].append(row[4:])
            left, right, hub = sides
            if not left or (i != j and not right):
                continue
            for x, y in find(left, right, *(h[2] for h in hub)):
                a, b = left[x][0], (right or left)[y][0]
                yield (a, b) if a > b else (b, a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[tuple[bytes, bytes]] = set()
        for pair in pairs(batches):
            held.add(pair)
            if len(held) >= 50_000:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in held])
                held.clear()
        if held:
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in held])

    dealt = dealt.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "side", "n", "node")
    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def _may_match(members: DataFrame, similarity: int) -> DataFrame:
    """Pairs of nodes that connect all that may match, from ``members`` (token, blocks, node, n, bitmap)."""

    def find(left: list[tuple], right: list[tuple]) -> Iterator[tuple[int, int]]:
        label = np.arange(len(left) + len(right))

        def tree(side: list[tuple], offset: int) -> Tree:
            bits = np.frombuffer(b"".join(m[2] for m in side), dtype=np.uint64).reshape(len(side), -1)
            return Tree(bits, np.array([m[1] for m in side], dtype=np.int64), label, offset)

        one = tree(left, 0)
        return walk(one, tree(right, len(left)) if right else one, similarity)

    return _found_in_cells(_dealt(members, "token"), "token", "bitmap", find)


def common_counts(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Intersection sizes of all pairs of sets, by products of 0/1 matrices over the elements both sides have."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    x, y = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(x, y)
    rows = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    at = [np.searchsorted(shared, values) for values in (x, y)]
    held = [np.minimum(a, len(shared) - 1) if len(shared) else a for a in at]
    hit = [shared[h] == v if len(shared) else np.zeros(len(v), dtype=bool) for h, v in zip(held, (x, y))]
    for start in range(0, len(shared), columns):
        m = []
        for k, side in enumerate((left, right)):
            inside = hit[k] & (held[k] >= start) & (held[k] < start + columns)
            one = np.zeros((len(side), min(columns, len(shared) - start)), dtype=np.float32)
            one[rows[k][inside], held[k][inside] - start] = 1
            m.append(one)
        out += np.rint(m[0] @ m[1].T).astype(np.int64)
    return out


def parity_map(s: np.ndarray) -> bytes:
    """Parity of the members of each bit, over about as many bits as the set has members.

    The bits that differ between two maps of one width can't outnumber the members that differ. A map of twice
    the width gives one of the width by the exclusive or of its halves.
    """
    width = 1 << max(9, (max(1, len(s)) - 1).bit_length())
    at = ((s.view(np.uint64) >> np.uint64(20)) % np.uint64(width)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=width) & 1).astype(bool), bitorder="little").tobytes()


def _near_maps(left: list[tuple], right: list[tuple], similarity: int) -> np.ndarray:
    """Places (x, y) of members (node, n, map) that sizes and maps allow to reach the similarity."""
    found = []
    views = lambda side: [np.frombuffer(m[2], dtype=np.uint64) for m in side]
    one, two = views(left), views(right)
    n2 = np.array([m[1] for m in right], dtype=np.int64)
    for words in sorted({len(v) for v in one + two}):  # each pair at the smaller of its widths
        folded = lambda side: [(k, np.bitwise_xor.reduce(v.reshape(-1, words), axis=0), len(v) == words) for k, v in enumerate(side) if len(v) >= words]
        ys = folded(two)
        if not ys:
            continue
        places, maps, own = np.array([k for k, _, _ in ys]), np.vstack([v for _, v, _ in ys]), np.array([e for _, _, e in ys])
        for x, v, exact in folded(one):
            n = left[x][1] + n2[places]
            fits = (own | exact) & ((100 + similarity) * np.minimum(left[x][1], n2[places]) >= similarity * n)
            some = np.flatnonzero(fits)
            if len(some):
                apart = np.bitwise_count(maps[some] ^ v).sum(axis=1, dtype=np.int64)
                some = some[(100 + similarity) * apart <= (100 - similarity) * n[some]]
                found += [(x, int(y)) for y in places[some]]
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def _refined(sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs of nodes that connect all that still may match in families of several blocks, by parity maps.

    A map is a sixty-fourth of its set, and as wide as it, so it tells long documents apart that small bitmaps can't.
    Only sets of sizes near enough meet: blocks are made in groups of two neighbouring bands of sizes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [parity_map(np.frombuffer(s, dtype=np.int64)) for s in batch.column("s").to_pylist()]
            arrays = [*(batch.column(c) for c in ("family", "node", "n")), pa.array(maps, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["family", "node", "n", "p"])

    def find(left: list[tuple], right: list[tuple]) -> Iterator[tuple[int, int]]:
        label = np.arange(len(left) + len(right))
        return joining(label, _near_maps(left, right or left, similarity), 0, len(left) if right else 0)

    several = sets.where("blocks > 1")
    maps = _in_bands(several.select("family", "node", "n", "s").mapInArrow(run, "family binary, node binary, n long, p binary"), similarity)
    groups = _in_bands(several.select("family", "n"), similarity).groupBy("family", "low").agg(
        F.min("band").alias("least"), F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / MAP_ELEMENTS)).cast("int").alias("blocks")
    )
    groups = cut(groups.where("least = low").drop("least"))  # else the next group has all of its pairs
    rows = maps.join(groups, ["family", "low"]).withColumn("group", F.concat("family", F.col("low").cast("string").cast("binary")))
    return _found_in_cells(_dealt(rows.select("group", "blocks", "node", "n", "p"), "group"), "group", "p", find)


def _in_bands(rows: DataFrame, similarity: int) -> DataFrame:
    """``rows`` twice, with ``band`` of their size n and ``low``, the lower of the two bands of a group.

    A band is as wide as the sizes of similar sets can differ, so these are in one band or in neighbouring ones:
    they meet in the group of the lower band. The margin is for rounding.
    """
    width = 1.000001 * max(math.log(100 / similarity), 0.01)
    banded = rows.withColumn("band", F.floor(F.log("n") / width))
    return banded.withColumn("low", F.explode(F.array(F.col("band") - 1, F.col("band"))))


def _hubs(sets: DataFrame) -> DataFrame:
    """One whole set of every family of several blocks: (family, blocks, hub)."""
    found = cut(sets.where("blocks > 1").groupBy("family", "blocks").agg(F.min_by("s", "node").alias("hub")))
    size = found.agg(F.sum(F.length("hub"))).first()[0] or 0
    return F.broadcast(found) if size <= HUB_BYTES else found


def _apart_from_hubs(sets: DataFrame) -> DataFrame:
    """Sets (family, blocks, node, n, s, hub) by what they and their hub don't share, where that is less than the set.

    A first byte tells which. Members of a family are much alike, so every copy that goes to another cell is small.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                made = []
                for s, hub in zip(batch.column("s").to_pylist(), batch.column("hub").to_pylist()):
                    apart = s if hub is None else np.setxor1d(np.frombuffer(s, np.int64), np.frombuffer(hub, np.int64), assume_unique=True).tobytes()
                    made.append(b"\x01" + apart if len(apart) < len(s) else b"\x00" + s)
                arrays = [*(batch.column(c) for c in ("family", "blocks", "node", "n")), pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["family", "blocks", "node", "n", "s"])

    kinds = ", ".join(f"{c} {sets.schema[c].dataType.simpleString()}" for c in ("family", "blocks", "node", "n"))
    return sets.select("family", "blocks", "node", "n", "s", "hub").mapInArrow(run, f"{kinds}, s binary")


def _verified(sets: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) that connect all that links connect, from ``sets`` (family, blocks, node, n, s)."""

    def find(left: list[tuple], right: list[tuple], hub: bytes = b"") -> Iterator[tuple[int, int]]:
        centre = np.frombuffer(hub, dtype=np.int64)

        def whole(payload: bytes) -> np.ndarray:
            found = np.frombuffer(payload, dtype=np.int64, offset=1)
            return np.setxor1d(centre, found, assume_unique=True) if payload[0] else found

        label = np.arange(len(left) + len(right))
        one = [whole(m[2]) for m in left]
        two = [whole(m[2]) for m in right] if right else one
        common = common_counts(one, two)
        sizes = [np.array([len(s) for s in side]) for side in (one, two)]
        union = sizes[0][:, None] + sizes[1][None, :] - common
        return joining(label, np.argwhere(100 * common >= similarity * union), 0, len(left) if right else 0)

    hubs = _hubs(sets)
    rows = sets.join(hubs.select("family", "hub"), "family", "left")
    dealt = _dealt(_apart_from_hubs(rows), "family").select("family", "i", "j", "side", "node", "n", "s")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = hubs.select("family", "blocks", "hub", every.alias("i")).select("family", "hub", "i", F.explode(F.sequence("i", F.col("blocks") - 1)).alias("j"))
    nothing = F.lit(None)
    middle = cells.select(
        "family", F.col("i").cast("int"), F.col("j").cast("int"), F.lit(2).alias("side"), nothing.cast("binary").alias("node"), nothing.cast("long").alias("n"), F.col("hub").alias("s")
    )
    return _found_in_cells(dealt.unionByName(middle), "family", "s", find)


def _bit_table(rows: DataFrame, key: Column) -> np.ndarray:
    """NAMED_BITS bits, set for the keys of ``rows``; at most NAMED_BITS / 64 numbers reach the driver, as Arrow."""
    bit = F.pmod(F.xxhash64(key), F.lit(NAMED_BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    found = rows.groupBy((bit / 64).cast("int").alias("k")).agg(F.bit_or(one).alias("v")).toArrow()
    table = np.zeros(NAMED_BITS // 64, dtype=np.int64)
    table[found["k"].to_numpy()] = found["v"].to_numpy()
    return table.view(np.uint64)


def _held(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places of those of ``at`` whose bit is set."""
    return np.flatnonzero((bits[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1))


def _whole_sets(docs: DataFrame, in_family: DataFrame, width: int) -> DataFrame:
    """Whole sets of the nodes of ``in_family``: (family, blocks, node, n, s), s the sorted hashes as bytes.

    A bit table of fixed size keeps documents that no node names from being read further. Sets are shuffled once
    here, the family comes with them.
    """
    key = F.pmod(F.xxhash64("doc_id"), F.lit(NAMED_BITS))
    shared = docs.sparkSession.sparkContext.broadcast(_bit_table(in_family, F.col("rep")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for batch in batches:
            at = batch.column("_at").to_numpy(zero_copy_only=False)
            hit = _held(bits, at)
            for start in range(0, len(hit), 256):
                texts = batch.column("text").take(pa.array(hit[start : start + 256])).to_pylist()
                raw = [shingle_set(t, width).view(np.int64) for t in texts]
                # by numbers as signed ones, the order that searches use
                made = {xxhash.xxh3_128_digest(s.tobytes()): np.sort(s).tobytes() for s in raw if len(s)}
                made = {node: s for node, s in made.items() if node not in seen}
                seen.update(made)
                yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.binary()), pa.array(list(made.values()), pa.binary())], ["node", "s"])

    sets = docs.select(key.alias("_at"), "text").mapInArrow(run, "node binary, s binary")
    return sets.join(in_family.select("family", "blocks", "node", "n"), "node").dropDuplicates(["node"]).select("family", "blocks", "node", "n", "s")


def _regrouped(sets: DataFrame, closer: DataFrame) -> DataFrame:
    """``sets`` with the families of ``closer`` (family, blocks, node) instead; sets that it doesn't hold go.

    A bit table of fixed size keeps these out of the shuffle.
    """
    shared = sets.sparkSession.sparkContext.broadcast(_bit_table(closer, F.col("node")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = _held(shared.value, batch.column("_at").to_numpy(zero_copy_only=False))
            yield batch.select(["node", "n", "s"]).take(pa.array(hit))

    key = F.pmod(F.xxhash64("node"), F.lit(NAMED_BITS))
    some = sets.select(key.alias("_at"), "node", "n", "s").mapInArrow(run, "node binary, n long, s binary")
    return some.join(closer.select("family", "blocks", "node"), "node").select("family", "blocks", "node", "n", "s")


def _sized(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of components with the number of blocks that their family is dealt in: (family, node, n, rep, blocks)."""
    members = found.toDF("node", "family").join(nodes.select("node", "n", "rep"), "node")
    parts = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / ELEMENTS)
    sizes = members.groupBy("family").agg(F.ceil(parts).cast("int").alias("blocks"))
    return members.join(sizes, "family").select("family", "node", "n", "rep", "blocks")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, similarity: int = 90) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = cut(_sets(docs, width, similarity))
    nodes = cut(
        rows.where("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bitmap").alias("bitmap"))
    )
    # dealt once: the counts and the join below read the same shuffle, as long as both take the same rows and columns
    postings = nodes.select("node", F.explode("prefix").alias("token")).where("node is not null and token is not null").repartition("token")
    shared = postings.groupBy("token").agg(F.count("node").alias("count")).where("count > 1")
    members = postings.join(shared, "token").select("token", "node", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    members = members.join(nodes.select("node", "n", "bitmap"), "node").select("token", "blocks", "node", "n", "bitmap")
    in_family = cut(_sized(components(_may_match(members, similarity)), nodes))
    sets = cut(_whole_sets(docs, in_family, width))
    closer = cut(_sized(components(_refined(sets, similarity)), nodes))
    parted = cut(_regrouped(sets.where("blocks > 1"), closer))
    links = _verified(sets.where("blocks = 1").unionByName(parted), similarity)
    joined = components(links)
    named = nodes.select("node", "rep").join(joined.withColumnRenamed("id", "node"), "node", "left")
    named = named.select("node", "rep", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "component").select("node", "component_id")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, similarity: int = 90) -> DataFrame:
    """``docs``, same columns, with one row of each component: that of the smallest id (then row key).

    Rows without words stay all; of rows equal in every column one stays.
    """
    row, copies, doc, hashed, n = fresh(docs, "_row", "_copies", "_doc", "_hash", "_n")
    keyed = docs.select(F.struct(F.col(doc_id).alias("doc"), row_key(docs).alias("row")).alias("doc_id"), F.col(text).alias("text"))
    found = classes(keyed, width=width, similarity=similarity)
    stay = found.where((F.col("n_shingles") == 0) | (F.col("doc_id") == F.col("component_id")))
    stay = stay.select(F.col("doc_id.doc").alias(doc), F.col("doc_id.row").alias(hashed), F.col("n_shingles").alias(n)).distinct()
    others = [c for c in docs.columns if c != doc_id]
    rows = docs.withColumn(row, row_key(docs)).groupBy(doc_id, row)
    rows = rows.agg(*[F.first(c).alias(c) for c in others], F.count(F.lit(1)).alias(copies))
    rows = rows.join(stay, F.col(doc_id).eqNullSafe(F.col(doc)) & (F.col(row) == F.col(hashed)))
    uses = F.when(F.col(n) == 0, F.col(copies)).otherwise(F.lit(1).cast("long"))
    return rows.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), uses))).select(*docs.columns)
