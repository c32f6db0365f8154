"""Conversation structure repair over a suffix-shared automaton.

A turn is blank (no character other than separators), a duplicate (role and text seen earlier in its
conversation), truncated (its last such character isn't ``.``, ``!`` or ``?``) or sound; the first that holds
counts. Edits make the initials of the roles follow ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 2,
Delete 3 and is the only edit of blanks and duplicates, Insert of an empty turn by user or assistant 2; a
truncated turn that stays adds 1. The cheapest edits are taken; of those the ones whose initials come first.

Only a turn's initial and fault matter, so a conversation is a string over nine letters. Strings are sorted by
their ends and walked as a minimal automaton that shares suffixes: a node is a suffix, and its cost to go and best
edits are computed once for each of the four states of the grammar, whatever number of conversations runs
through it. Only the path of the string at hand is held. Long conversations are cut into strings of ``chunk``
turns. Their costs between states, a 4 by 4 matrix per distinct string, are folded from the end, which gives every string the
costs to go behind it; those then belong to its suffix nodes. So no task holds a conversation.

``repair`` returns every edit as a row. ``summary`` streams them in order, a conversation in one task without holding
it, since a digest of a whole conversation can only be made in sequence.

Turns are ordered by turn (nulls first), role, text; repeated rows are duplicates of the first. A null or empty role fits
nowhere in the grammar and null text is blank. Rows without a conversation id form a conversation. Empty
tables give empty results; other columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.llm.common import cut
from harborline.llm.ordered import numbered

CHUNK = 256  # turns of a string
FAR = 1 << 40  # the cost of what can't be
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the state that an inserted or reroled turn leads to
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
FINAL = (0, FAR, FAR, 0)
REROLE, INSERT = {USER: "U", ASSISTANT: "A"}, {USER: "u", ASSISTANT: "a"}
AUDIT = str.maketrans("uaUA", "IIRR")

Best = tuple[int, str, str, int]  # cost to go, audit, steps (audit letters with their roles), state at the end


def _inserted(best: list[Best]) -> tuple[Best, ...]:
    """The best edits of a node when turns may be inserted before anything else."""
    while True:
        more = [min(best[q], (2 + c, "I" + audit, INSERT[NEXT[q]] + steps, end)) for q in range(4) for c, audit, steps, end in [best[NEXT[q]]]]
        if more == best:
            return tuple(best)
        best = more


def _end(costs: tuple[int, ...] | None) -> tuple[Best, ...]:
    """The node of the empty suffix: the end of a conversation, or a cut with the costs to go behind it."""
    best = [(c, "", "", q) for q, c in enumerate(costs or FINAL)]
    return tuple(best) if costs else _inserted(best)


def _node(letter: str, rest: tuple[Best, ...]) -> tuple[Best, ...]:
    """The node of a suffix from the node of the suffix without its first letter."""
    then = lambda q, cost, initial, step: (cost + rest[q][0], initial + rest[q][1], step + rest[q][2], rest[q][3])
    best, cut_off = [], int(letter.isupper())
    for q in range(4):
        options = [then(q, 3, "D", "D")]
        if letter != "x":
            options.append(then(NEXT[q], 2 + cut_off, "R", REROLE[NEXT[q]]))
            if letter.lower() in KEEP[q]:
                options.append(then(KEEP[q][letter.lower()], cut_off, "K", "K"))
        best.append(min(options))
    return _inserted(best)


def solved(strings: DataFrame) -> DataFrame:
    """For distinct ``ends`` (costs to go behind the string; null: the conversation ends) and ``letters``: for every
    state before the string ``costs`` (within it), ``steps`` and ``exits`` (the state behind it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, letters, ends = [], "", ()  # nodes from the end, and the reversed string that leads through them
        for batch in batches:
            found = []
            for now, text in zip(batch.column("ends").to_pylist(), batch.column("letters").to_pylist()):
                now = tuple(now) if now else None
                back = text[::-1]
                if now != ends or not path:
                    path, letters, ends = [_end(now)], "", now
                same = next((k for k, (a, b) in enumerate(zip(back, letters)) if a != b), min(len(back), len(letters)))
                del path[same + 1 :]
                for letter in back[same:]:
                    path.append(_node(letter, path[-1]))
                letters = back
                found.append([(cost - (now[end] if now else 0), steps, end) for cost, _, steps, end in path[-1]])
            columns = [[[best[k] for best in row] for row in found] for k in range(3)]
            kinds = [pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32())]
            arrays = [batch.column("ends"), batch.column("letters"), *(pa.array(c, kind) for c, kind in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, ["ends", "letters", "costs", "steps", "exits"])

    order = [F.array_join("ends", ","), F.reverse("letters")]
    spread = strings.repartitionByRange(*order).sortWithinPartitions(*order)
    return spread.mapInArrow(run, "ends array<long>, letters string, costs array<long>, steps array<string>, exits array<int>")


def _fold_back(chunks: DataFrame) -> DataFrame:
    """``key``, ``chunk`` and ``ends`` of the chunks (key, chunk, paths) of long conversations, from the last one on.

    One row per ``CHUNK`` turns streams by; nothing but four costs is held. Costs are counted from the least of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, costs = None, None
        for batch in batches:
            ends = []
            for k, paths in zip(batch.column("key").to_pylist(), batch.column("paths").to_pylist()):
                if k != key:
                    key, costs = k, None
                ends.append(costs)
                behind = costs or [c for c, *_ in _end(None)]
                costs = [min(paths[end][q] + behind[end] for end in range(4)) for q in range(4)]
                costs = [c - min(costs) for c in costs]
            arrays = [batch.column("key"), batch.column("chunk"), pa.array(ends, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "chunk", "ends"])

    spread = chunks.repartition("key").sortWithinPartitions("key", F.desc("chunk"))
    return spread.mapInArrow(run, "key string, chunk long, ends array<long>")


def _fold_on(chunks: DataFrame) -> DataFrame:
    """``key``, ``chunk`` and the ``steps`` taken in it, from the state that the chunk before leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, START
        for batch in batches:
            taken = []
            for k, steps, exits in zip(*(batch.column(c).to_pylist() for c in ("key", "steps", "exits"))):
                if k != key:
                    key, state = k, START
                taken.append(steps[state])
                state = exits[state]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("chunk"), pa.array(taken, pa.string())], ["key", "chunk", "steps"])

    spread = chunks.select("key", "chunk", "steps", "exits").repartition("key").sortWithinPartitions("key", "chunk")
    return spread.mapInArrow(run, "key string, chunk long, steps string")


def _steps(chunks: DataFrame) -> DataFrame:
    """The steps of every chunk (key, chunk, letters)."""
    final = F.lit(None).cast("array<long>")
    long = chunks.where("chunk > 0").select("key").distinct()
    rest = cut(chunks.join(long, "key", "left_semi"))
    units = F.array(*[F.array(*[F.lit(0 if q == end else FAR).cast("long") for q in range(4)]) for end in range(4)])
    asked = rest.select("letters").distinct().select(F.explode(units).alias("ends"), "letters")
    far = lambda end: F.max(F.when(F.col("ends")[end] == 0, F.transform("costs", lambda c: F.least(c, F.lit(FAR)))))
    # costs within the string to an end it doesn't reach are those of another end: the exit tells
    reached = solved(asked).withColumn("costs", F.transform("costs", lambda c, q: F.when(F.col("ends")[F.get(F.col("exits"), q)] == 0, c).otherwise(F.lit(FAR))))
    matrices = reached.groupBy("letters").agg(F.array(*[far(end) for end in range(4)]).alias("paths"))
    ends = cut(_fold_back(rest.join(matrices, "letters").select("key", "chunk", "paths")))
    rest = rest.join(ends, ["key", "chunk"])
    short = chunks.join(long, "key", "left_anti").withColumn("ends", final)
    plans = cut(solved(rest.select("ends", "letters").unionByName(short.select("ends", "letters")).distinct()))
    same = lambda a, b: a["ends"].eqNullSafe(b["ends"]) & (a["letters"] == b["letters"])
    whole = plans.where("ends is null").select("letters", F.col("steps")[START].alias("steps"))
    whole = short.join(whole, "letters").select("key", "chunk", "steps")
    parts = rest.join(plans.alias("p"), same(rest, plans)).select("key", "chunk", plans["steps"], plans["exits"])
    return whole.unionByName(_fold_on(parts))


def _fault(text: Column, place: Column, first: Column) -> Column:
    last = F.substring(F.rtrim(text, F.lit("\x20\t\n\x0b\x0c\r")), -1, 1)
    return F.when(last == "", "blank").when(place > first, "duplicate").when(~last.isin(".", "!", "?"), "truncated")


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Every edit as a row, in order by ``place`` and ``step`` within a conversation.

    ``conv_id``; ``place``, the turn's number from 1 (inserts stand with the turn that follows, or the last one);
    ``step`` within it; ``edit`` (Keep, Rerole, Delete, Insert); ``role`` and ``text`` after the edit (of deleted turns: before);
    ``turn``, ``was`` (the role before) and ``fault`` of the turn, null for inserted ones; ``cost``.
    """
    key = F.coalesce(F.col(conv_id).cast("string"), F.lit("")).alias("key")
    rows = turns.select(key, F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("was"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = numbered(rows, "key", [F.asc_nulls_first("turn"), F.asc_nulls_first("was"), F.col("text")])
    # the first place of every text and role, by digest; combined before the shuffle
    said = F.unhex(F.sha2(F.concat(F.length(F.coalesce(F.col("was"), F.lit(""))).cast("string"), F.lit(":"), F.coalesce(F.col("was"), F.lit("")), F.col("text")), 256))
    rows = rows.withColumn("said", F.when(F.col("was").isNull(), F.concat(F.lit(b"-"), said)).otherwise(said))
    first = rows.groupBy("key", "said").agg(F.min("place").alias("first"))
    rows = rows.join(first, ["key", "said"]).withColumn("fault", _fault(F.col("text"), F.col("place"), F.col("first"))).drop("said", "first")
    rows = cut(rows)
    initial = F.substring(F.coalesce(F.col("was"), F.lit("")), 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    at = F.floor((F.col("place") - 1) / chunk).cast("long").alias("chunk")
    strings = rows.select("key", at, "place", letter.alias("letter")).groupBy("key", "chunk")
    strings = strings.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "letter"))), lambda x: x["letter"]), "").alias("letters"))
    steps = _steps(cut(strings))
    # a turn's steps: what is inserted before it, and its own; what is inserted at the very end stands with the last turn
    pieces = F.regexp_extract_all("steps", F.lit("[ua]*[KDUA](?:[ua]+$)?"), F.lit(0))
    steps = steps.select("key", "chunk", F.posexplode(pieces).alias("n", "piece"))
    steps = steps.select("key", (F.col("chunk") * chunk + F.col("n") + 1).alias("place"), F.split("piece", "").alias("each"))
    made = rows.join(steps, ["key", "place"]).select("*", F.posexplode("each").alias("step", "code")).drop("each")
    inserted, rerole = F.col("code").isin("u", "a"), F.col("code").isin("U", "A")
    own = lambda c: F.when(~inserted, c)
    named = F.when(F.lower("code") == "u", "user").otherwise("assistant")
    stays = (F.col("fault") == "truncated") & (F.col("code") != "D")
    cost = F.when(inserted | rerole, 2).when(F.col("code") == "D", 3).otherwise(0) + F.when(~inserted & F.coalesce(stays, F.lit(False)), 1).otherwise(0)
    return made.select(
        "conv_id",
        "place",
        F.col("step").cast("long").alias("step"),
        F.when(inserted, "Insert").when(rerole, "Rerole").when(F.col("code") == "D", "Delete").otherwise("Keep").alias("edit"),
        F.when(inserted | rerole, named).otherwise(F.col("was")).alias("role"),
        F.when(inserted, "").otherwise(F.col("text")).alias("text"),
        own(F.col("turn")).alias("turn"),
        own(F.col("was")).alias("was"),
        own(F.col("fault")).alias("fault"),
        cost.cast("long").alias("cost"),
    )


def summary(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s rows: ``gaps`` (turn numbers missing between the least and the
    largest), turns that are ``blank``, ``duplicate``, ``truncated``, ``illegal`` (neighbours whose initials
    are not su, ua or au, before the edits), ``cost``, ``audit`` (initials of the edits) and ``repaired_sha256`` (of
    ``role:text`` lines; a null role is empty)."""
    kind = edits.schema["conv_id"].dataType
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType(
        [T.StructField("conv_id", kind)] + [T.StructField(c, T.LongType()) for c in counts] + [T.StructField(c, T.StringType()) for c in ("audit", "repaired_sha256")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        held: _Summed | None = None
        type_of = None

        def batch() -> pa.RecordBatch:
            kinds = [type_of, *[pa.int64()] * 6, pa.string(), pa.string()]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], schema.names)
            done.clear()
            return out

        for got in batches:
            type_of = got.column("conv_id").type
            for start in range(0, got.num_rows, 512):
                part = got.slice(start, 512)
                for row in zip(*(part.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text", "turn", "was", "fault", "cost"))):
                    if held is None or held.conv_id != row[0]:
                        if held is not None:
                            done.append(held.row())
                        held = _Summed(row[0])
                    held.add(*row[1:])
                if len(done) >= 512:
                    yield batch()
        if held is not None:
            done.append(held.row())
            yield batch()

    spread = edits.repartition("conv_id").sortWithinPartitions("conv_id", "place", "step")
    return spread.mapInArrow(run, schema)


class _Summed:
    """What a conversation's edits add up to as they stream by."""

    def __init__(self, conv_id):
        self.conv_id, self.digest, self.lines, self.audit = conv_id, hashlib.sha256(), 0, []
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = self.turns = 0
        self.before = self.low = self.high = None

    def add(self, edit, role, text, turn, was, fault, cost) -> None:
        self.cost += cost
        self.audit.append(edit[0])
        if edit != "Insert":
            pair, self.before = (self.before, (was or "")[:1]), (was or "")[:1]
            self.illegal += pair[0] is not None and pair not in (("s", "u"), ("u", "a"), ("a", "u"))
            if fault:
                self.count[fault] += 1
            if turn is not None:
                self.turns += self.high != turn
                self.low, self.high = turn if self.low is None else self.low, turn
        if edit != "Delete":
            self.digest.update(("\n" * (self.lines > 0) + f"{role or ''}:{text}").encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.high is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        return (self.conv_id, gaps, *self.count.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())
