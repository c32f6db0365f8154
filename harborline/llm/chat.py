"""Chat formatting: multi-party perspective rotation.

For every participant of a dialogue the whole dialogue is rendered once, with that speaker as the assistant and
the others as named users; the mask covers what the assistant says, end marker included, so that each
speaker is learned from in turn. System turns stay system turns and aren't participants.

``dialogues`` renders whole dialogues: up to ``row_turns`` turns come in one row, longer ones in consecutive
segments, of which every participant of the dialogue gets each, silent or not, so that no row grows with the
longest conversation. A segment says how many turns and code points of the dialogue come before it for that
speaker; the segments of a speaker concatenate to the whole. Turns are numbered over ranges of their order and cut by
place, so no group of rows is larger than a row's turns, whatever their turn numbers are.

``rotations`` renders stretches of ``segment`` consecutive turn numbers as dialogues of their own, rotated by
the speakers of the stretch; turns without a number form a stretch of their own (null).

Turns are ordered by (turn, role, text), nulls first; equal rows are said twice. A null role is an unnamed user
and no participant, null text is empty. Text that looks like a marker is broken by a space. Dialogues without a
participant give no row. Null conversation ids are one conversation. Extra columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import cut
from harborline.llm.ordered import numbered

END = "<|end|>\n"


def _header(role: Column, speaker: Column) -> Column:
    named = F.concat(F.lit("<|user name="), role, F.lit("|>\n"))
    return (
        F.when(role.isNull(), F.lit("<|user|>\n"))
        .when(role == "system", F.lit("<|system|>\n"))
        .when(role == speaker, F.lit("<|assistant|>\n"))
        .otherwise(named)
    )


def _text(text: str) -> Column:
    return F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("<|"), F.lit("< |"))


def _people(turns: str) -> Column:
    return F.array_distinct(F.filter(F.transform(turns, lambda t: t["role"]), lambda r: r.isNotNull() & (r != "system")))


def _rendered(rows: DataFrame) -> DataFrame:
    """``rows`` (turns, speaker) with ``rendered`` and ``mask``."""
    piece = F.transform(
        "turns",
        lambda t: F.struct(
            _header(t["role"], F.col("speaker")).alias("head"),
            F.concat(t["text"], F.lit(END)).alias("body"),
            F.coalesce(t["role"] == F.col("speaker"), F.lit(False)).alias("own"),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(a: Column, p: Column) -> Column:
        begin = a["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        mine = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(p["own"], F.concat(a["spans"], mine)).otherwise(a["spans"]).alias("spans"))

    return rows.withColumn("pieces", piece).withColumns(
        {
            "rendered": F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), ""),
            "mask": F.aggregate("pieces", start, step, lambda a: a["spans"]),
        }
    )


def dialogues(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    row_turns: int = 1024,
) -> DataFrame:
    """One row per conversation, segment and participant of the conversation: ``conv_id``, ``segment`` (from 0, in
    order), ``speaker``, ``turns_before``, ``offset`` (code points before), ``n_turns``, ``rendered``, and ``mask``, the
    spans (start, end) in code points of ``rendered`` that the speaker says."""
    nobody = F.lit(None).cast("string")
    key = F.coalesce(F.col(conv_id).cast("string"), F.lit(""))
    rows = turns.select(key.alias("key"), F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), _text(text).alias("text"))
    rows = numbered(rows, "key", [F.asc_nulls_first("turn"), F.asc_nulls_first("role"), "text"])
    rows = rows.withColumn("segment", F.floor((F.col("place") - 1) / row_turns).cast("long"))
    said = F.struct("place", "role", "text")
    groups = rows.groupBy("key", "conv_id", "segment").agg(F.sort_array(F.collect_list(said)).alias("turns"))
    # only conversations that don't fit in a row need more than their own turns
    long = cut(rows.where("segment > 0").select("key").distinct())

    # lengths as they are for a speaker who is silent; what a speaker says has another header
    plain = F.length(F.coalesce(_header(F.col("role"), nobody), F.lit(""))) + F.length("text") + len(END)
    by_role = rows.join(long, "key", "left_semi").groupBy("key", "segment", "role")
    by_role = cut(by_role.agg(F.count(F.lit(1)).alias("n"), F.sum(plain.cast("long")).alias("chars")))
    before = lambda name, *by: F.coalesce(F.sum(name).over(Window.partitionBy(*by).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = by_role.groupBy("key", "segment").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"))
    parts = parts.select("key", "segment", before("n", "key").alias("turns_before"), before("chars", "key").alias("chars_before"))
    spoken = by_role.where("role is not null and role <> 'system'").select("key", "segment", F.col("role").alias("speaker"), F.col("n").alias("own"))
    each = parts.join(spoken.select("key", "speaker").distinct(), "key").join(spoken, ["key", "segment", "speaker"], "left")
    change = F.length(_header(F.col("speaker"), F.col("speaker"))) - F.length(_header(F.col("speaker"), nobody))
    each = each.withColumn("offset", F.col("chars_before") + before("own", "key", "speaker") * change)

    none = F.lit(0).cast("long")
    whole = groups.join(long, "key", "left_anti").withColumns({"turns_before": none, "offset": none, "speaker": F.explode(_people("turns"))})
    cuts = groups.join(each.drop("chars_before", "own"), ["key", "segment"])
    found = _rendered(whole.unionByName(cuts))
    return found.select("conv_id", "segment", "speaker", "turns_before", "offset", F.size("turns").cast("long").alias("n_turns"), "rendered", "mask")


def rotations(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    segment: int = 64,
) -> DataFrame:
    """One row per conversation, segment and participant: ``conv_id``, ``segment``, ``speaker``, ``n_turns``,
    ``rendered``, and ``mask``, the spans (start, end) in code points that the speaker says."""
    said = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), _text(text).alias("text"))
    groups = turns.select(F.col(conv_id).alias("conv_id"), F.floor(F.col(turn) / segment).cast("long").alias("segment"), said.alias("said"))
    groups = groups.groupBy("conv_id", "segment").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    rows = _rendered(groups.withColumn("speaker", F.explode(_people("turns"))))
    return rows.select("conv_id", "segment", "speaker", F.size("turns").cast("long").alias("n_turns"), "rendered", "mask")
