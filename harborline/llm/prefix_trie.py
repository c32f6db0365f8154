"""Conversation prefix trie by time-forward processing.

A node is a distinct sequence of first turns (role, text); the root is the empty one. It is named by its smallest
member conversation and its depth: below that name's first node a conversation runs along nodes of its own, so
ranges of (conversation, depth) hold whole stretches of the trie, and a hot conversation spans as many ranges as
its length asks for. Sequences are told apart by 128-bit sums of digests of (depth, turn), running sums that
``ordered.numbered`` carries over ranges.

Subtree totals (leaves, saved tokens) come from time-forward processing. A shard is such a range; Spark sorts its nodes
by reverse level order, externally, and they stream by: a node takes the messages that wait for it,
adds them up and leaves its total for its parent in a priority queue, which spills sorted runs to disk. What is
left for parents outside the shard goes out, summed by parent. Those parents form a much smaller trie of their own, each
below the next one that its shard's roots report to; its totals are found in the same way, across shards, and enter
the shards as messages in a second pass. Tables of up to ``size`` nodes take one shard.

Roles and texts that are null count as empty. Conversations without an id are left out. Repeated turns are turns.
Members without turns end at the root. A table without conversations gives no node. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import cut
from harborline.llm.ordered import numbered

SIZE = 20_000  # nodes that one shard takes
HELD = 1 << 18  # parents that messages wait for in memory; further ones spill
ENDS = 4_096  # conversation ids of a block of a node's ends
_LANES = ["_l0", "_l1", "_l2", "_l3"]

Key = tuple[int, int]  # (-depth, conversation): ascending is reverse level order


class Messages:
    """A priority queue of sums by node; what comes last in the order spills when there are too many."""

    def __init__(self, held: int = HELD):
        self.held = held
        self.sums: dict[Key, list[int]] = {}
        self.heap: list[Key] = []
        self.runs: list[tuple[Key, int, list[int], Iterator]] = []
        self.made = 0

    def add(self, key: Key, *values: int) -> None:
        found = self.sums.get(key)
        if found is None:
            self.sums[key] = list(values)
            heapq.heappush(self.heap, key)
            if len(self.heap) > self.held:
                self._spill()
        else:
            for k, value in enumerate(values):
                found[k] += value

    def _spill(self) -> None:
        self.heap.sort()
        keep = max(1, self.held // 2)
        file = tempfile.TemporaryFile()  # of this task only, gone with it
        for start in range(keep, len(self.heap), 1_000):
            pickle.dump([(key, self.sums.pop(key)) for key in self.heap[start : start + 1_000]], file)
        del self.heap[keep:]
        file.seek(0)
        self.made += 1
        self._next(self.made, self._read(file))

    @staticmethod
    def _read(file) -> Iterator[tuple[Key, list[int]]]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _next(self, number: int, run: Iterator) -> None:
        for key, values in run:
            heapq.heappush(self.runs, (key, number, values, run))
            return

    def first(self) -> Key | None:
        heads = ([self.heap[0]] if self.heap else []) + ([self.runs[0][0]] if self.runs else [])
        return min(heads, default=None)

    def take(self) -> tuple[Key, list[int]]:
        """The first node with the sums of its messages."""
        key = self.first()
        total = [0, 0, 0]
        if self.heap and self.heap[0] == key:
            heapq.heappop(self.heap)
            total = self.sums.pop(key)
        while self.runs and self.runs[0][0] == key:
            _, number, values, run = heapq.heappop(self.runs)
            total = [a + b for a, b in zip(total, values)]
            self._next(number, run)
        return key, total


def _passed(rows: DataFrame, outside: bool, held: int) -> DataFrame:
    """One pass over shards. ``rows``: shard, depth, conv, node (else a message), up_conv, up_depth, leaves, saved, n.

    Gives conv, depth, leaves, saved and n: totals of nodes and how many children told them, or, for ``outside``, what
    is left for nodes outside of the shard that sends it and how many of its nodes told.
    """

    names = ["conv", "depth", "leaves", "saved", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, at, found = Messages(held), None, []

        def left(until: Key | None) -> None:
            while (first := queue.first()) is not None and (until is None or first < until):
                key, total = queue.take()
                if outside:
                    found.append((key[1], -key[0], *total))

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names)
            found.clear()
            return out

        for got in batches:
            for shard, depth, conv, node, up_conv, up_depth, leaves, saved, n in zip(*(c.to_pylist() for c in got.columns)):
                if shard != at:
                    left(None)
                    at = shard
                key = (-depth, conv)
                left(key)
                if not node:
                    queue.add(key, leaves, saved, n)
                    continue
                told = 0
                if queue.first() == key:
                    _, (more, kept, told) = queue.take()
                    leaves, saved = leaves + more, saved + kept
                if not outside:
                    found.append((conv, depth, leaves, saved, told))
                if up_conv is not None:
                    queue.add((-up_depth, up_conv), leaves, saved, 1)
                if len(found) >= 10_000:
                    yield batch()
        left(None)
        while found:
            yield batch()

    rows = rows.select("shard", "depth", "conv", "node", "up_conv", "up_depth", "leaves", "saved", "n")
    rows = rows.sortWithinPartitions("shard", F.desc("depth"), "conv", "node")
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _exits(shards: DataFrame) -> DataFrame:
    """For nodes marked ``told``: conv, depth, shard, and the node outside the shard that the roots above them report to.

    Nodes of a shard come by level, so a node's parent is known before it; a shard's nodes bound what is held.
    """

    names = ["conv", "depth", "shard", "up_conv", "up_depth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, exits = None, {}
        for got in batches:
            found = []
            for shard, depth, conv, up_conv, up_depth, told in zip(*(c.to_pylist() for c in got.columns)):
                if shard != at:
                    at, exits = shard, {}
                up = (up_conv, up_depth)
                exits[conv, depth] = up = exits.get(up, up)
                if told:
                    found.append((conv, depth, shard, *up))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names)

    rows = shards.select("shard", "depth", "conv", "up_conv", "up_depth", "told").sortWithinPartitions("shard", "depth", "conv")
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def subtree_sums(tree: DataFrame, size: int = SIZE, held: int = HELD) -> DataFrame:
    """Totals over the subtree of every node of ``tree`` (conv, depth, up_conv, up_depth, leaves, saved).

    A parent has a smaller depth than its child; a root has no parent. Gives conv, depth, leaves, saved, and n,
    the number of children.
    """
    spark = tree.sparkSession
    count = tree.count()
    as_nodes = lambda t: t.select("*", F.lit(True).alias("node"), F.lit(0).cast("long").alias("n"))
    if count <= size:
        return _passed(as_nodes(tree.withColumn("shard", F.lit(0).cast("long"))).coalesce(1), False, held)
    shards = max(-(-count // size), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = tree.repartitionByRange(shards, "conv", "depth")
    dealt = cut(dealt.withColumn("shard", F.spark_partition_id().cast("long")))
    # shards are numbered from 0 on and dealt one to a task
    alone = lambda t: t.repartitionByRange(shards, "shard")
    left = _passed(alone(as_nodes(dealt)), True, held)
    told = cut(left.groupBy("conv", "depth").agg(*[F.sum(c).alias(c) for c in ("leaves", "saved", "n")]))
    marked = dealt.join(told.select("conv", "depth", F.lit(True).alias("told")), ["conv", "depth"], "left")
    exits = cut(_exits(alone(marked.withColumn("told", F.coalesce("told", F.lit(False))))))
    smaller = cut(told.join(exits, ["conv", "depth"]).select("conv", "depth", "up_conv", "up_depth", "leaves", "saved"))
    # a trie that hardly shrinks goes on with larger shards
    grown = size if smaller.count() * 2 <= count else size * 4
    totals = subtree_sums(smaller, grown, held).drop("n")
    entering = exits.select("conv", "depth", "shard").join(told.select("conv", "depth", "n"), ["conv", "depth"]).join(totals, ["conv", "depth"])
    nowhere = F.lit(None).cast("long")
    entering = entering.select("*", F.lit(False).alias("node"), nowhere.alias("up_conv"), nowhere.alias("up_depth"))
    return _passed(alone(as_nodes(dealt).unionByName(entering)), False, held)


class Trie(NamedTuple):
    nodes: DataFrame  # conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    ends: DataFrame  # conv_id, depth of a node, member: a conversation that ends there


def trie(turns: DataFrame, members: DataFrame, size: int = SIZE, held: int = HELD) -> Trie:
    """The trie of ``turns`` (conv_id, depth from 1 without gaps, said: a digest of role and text, bytes: those of the text)
    and of ``members`` (conv_id, each once), which may have no turns.

    ``saved_tokens`` sums, over the subtree, what sharing a node's text saves: its bytes for all members but one.
    """
    mixed = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.hex("said")), 256)
    lane = lambda k: F.conv(F.substring(mixed, 8 * k + 1, 8), 16, 10).cast("long")
    own = [f"_o{k}" for k in range(4)]
    rows = turns.select("conv_id", "depth", "bytes", *[lane(k).alias(c) for k, c in enumerate(_LANES)]).select("*", *[F.col(a).alias(b) for a, b in zip(_LANES, own)])
    rows = numbered(rows, "conv_id", ["depth"], _LANES)
    two = lambda a, b: F.shiftleft(a, 32).bitwiseOR(b)
    before = [F.pmod(F.col(a) - F.col(b), F.lit(1 << 32)) for a, b in zip(_LANES, own)]
    now = [F.col(c) for c in _LANES]
    rows = rows.select(
        "conv_id", "depth", "bytes", two(*now[:2]).alias("hi"), two(*now[2:]).alias("lo"), two(*before[:2]).alias("up_hi"), two(*before[2:]).alias("up_lo")
    )
    zero, nowhere = F.lit(0).cast("long"), F.lit(None).cast("long")
    last = rows.groupBy("conv_id").agg(F.max(F.struct("depth", "hi", "lo")).alias("last"))
    last = members.select("conv_id").join(last, "conv_id", "left")
    last = last.select("conv_id", *[F.coalesce(F.col(f"last.{c}"), zero).alias(c) for c in ("hi", "lo")])
    last = cut(last)
    nodes = rows.groupBy("hi", "lo").agg(
        F.min("conv_id").alias("conv"), F.max("depth").alias("depth"), F.max("up_hi").alias("up_hi"), F.max("up_lo").alias("up_lo"),
        F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("n_convs"),
    )
    root = members.agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select("*", zero.alias("hi"), zero.alias("lo"), zero.alias("depth"), nowhere.alias("up_hi"), nowhere.alias("up_lo"), zero.alias("bytes"))
    ended = last.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n_ends"))
    nodes = cut(nodes.unionByName(root).join(ended, ["hi", "lo"], "left"))
    parents = nodes.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv").alias("up_conv"))
    childless = F.coalesce("n_ends", zero) == F.col("n_convs")  # every member ends here
    tree = nodes.join(parents, ["up_hi", "up_lo"], "left").select(
        "conv",
        "depth",
        "up_conv",
        F.when(F.col("up_conv").isNotNull(), F.col("depth") - 1).alias("up_depth"),
        childless.cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        "n_convs",
    )
    tree = cut(tree)
    sums = subtree_sums(tree.drop("n_convs"), size, held)
    found = tree.select("conv", "depth", "up_conv", "n_convs").join(sums, ["conv", "depth"])
    found = found.select(
        F.col("conv").alias("conv_id"), "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs",
        F.col("n").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
    )
    named = nodes.select("hi", "lo", F.col("conv").alias("node"), "depth")
    ends = last.join(named, ["hi", "lo"]).select(F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("member"))
    return Trie(found, ends)


def ends_digests(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` of every node that conversations end at: their decimal ids, ascending, comma-joined.

    Ids are joined in blocks first; a node's blocks then stream through the digest, which only goes in sequence.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, found = None, None, []
        names = ["conv_id", "depth", "ends_sha256"]
        kinds = [pa.int64(), pa.int64(), pa.string()]

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)
            found.clear()
            return out

        for got in batches:
            for conv, depth, ids in zip(*(got.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
                if at != (conv, depth):
                    if digest is not None:
                        found.append((*at, digest.hexdigest()))
                    at, digest = (conv, depth), hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            if found:
                yield batch()
        if digest is not None:
            found.append((*at, digest.hexdigest()))
            yield batch()

    block = F.shiftright("member", ENDS.bit_length() - 1)
    blocks = ends.groupBy("conv_id", "depth", block.alias("block")).agg(F.sort_array(F.collect_list("member")).alias("ids"))
    blocks = blocks.select("conv_id", "depth", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    blocks = blocks.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "block")
    return blocks.mapInArrow(run, "conv_id long, depth long, ends_sha256 string")


def said(role: Column, text: Column) -> tuple[Column, Column]:
    """Digest of a turn, and the bytes of its text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    joined = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.sha2(joined, 256)).alias("said"), F.octet_length(text).cast("long").alias("bytes")


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns of every conversation as ``trie`` takes them, by turn (nulls first), role, text; a written table."""
    rows = turns.where(F.col(conv_id).isNotNull())
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = rows.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    rows = numbered(rows, "conv_id", [F.asc_nulls_first("turn"), "role", "text"])
    return cut(rows.select("conv_id", F.col("place").alias("depth"), *said(F.col("role"), F.col("text"))))
