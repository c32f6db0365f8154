"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are matches of fixed patterns, found in whole texts with their code point offsets: the text is split
at the matches and the pieces' lengths are summed. Each candidate's value is hashed and counted over the
corpus by distinct repositories and distinct owners, level by level (value, owner, repository), so that a
value that a third of all documents hold is summed before it is gathered. Values that many owners or
many repositories hold are copied *examples*; other values of one owner that look random are *live*; the rest is *unclear*. The method adds
spans: long mixed tokens that no pattern names count as secrets of kind ``owned`` if they are live.

Null texts count as empty. Documents without candidates have no spans. Null owners are one owner, null
repositories one repository of their owner. Equal rows count each, their repository once. Offsets of
matches in very long texts are summed in blocks of the square root of their number. Extra columns aren't read;
``scan`` numbers rows in a table written once, so that repeated rows and ids stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import cut

# Kinds in order, with pattern, group that holds the value, and least length of the value.
KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
# A whole token with lower case, upper case and digits, joined to no further letter or digit.
OWNED = (
    "owned",
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])[A-Za-z0-9+/_=-]{20,}",
    0,
    20,
)


def _running(lengths: Column) -> Column:
    """Sums of an array's leading elements (0 before the first), in blocks, so that n elements take n**1.5 steps."""
    n = F.size(lengths)
    width = F.ceil(F.sqrt(F.greatest(n, F.lit(1)))).cast("int")
    block = lambda k: F.slice(lengths, k * width + 1, width)
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    ones = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int"))).otherwise(F.array().cast("array<int>"))

    def scan(xs: Column, start: Column) -> Column:
        empty = F.struct(start.alias("at"), F.array().cast("array<int>").alias("sums"))
        step = lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["sums"], F.array(a["at"])).alias("sums"))
        return F.aggregate(xs, empty, step, lambda a: a["sums"])

    starts = scan(F.transform(ones, lambda k: total(block(k))), F.lit(0))
    return F.flatten(F.transform(F.arrays_zip(ones.alias("k"), starts.alias("s")), lambda z: scan(block(z["k"]), z["s"])))


def _found(rows: DataFrame, name: str, kind: tuple[str, str, int, int], order: int) -> DataFrame:
    """``rows`` with an array column ``name`` of the spans of one kind in column ``text``."""
    _, pattern, group, least = kind
    t = F.col("text")
    parts = F.arrays_zip(
        F.split(t, pattern, -1).alias("gap"),
        F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(t, F.lit(pattern), F.lit(group)).alias("value"),
    )
    rows = rows.withColumn("_parts", F.when(t.rlike(pattern), F.filter(parts, lambda p: p["hit"].isNotNull())))
    rows = rows.withColumn("_sizes", F.transform("_parts", lambda p: F.length(p["gap"]) + F.length(p["hit"])))
    rows = rows.withColumn("_ends", F.transform(F.arrays_zip(_running(F.col("_sizes")).alias("at"), F.col("_sizes").alias("n")), lambda z: z["at"] + z["n"]))
    span = lambda p, i: F.struct(
        (F.get("_ends", i) - F.length(p["hit"])).alias("start"),
        F.lit(order).alias("kind"),
        F.get("_ends", i).alias("end"),
        F.md5(p["value"]).alias("value"),
        (F.size(F.array_distinct(F.split(p["value"], ""))) >= 8).alias("varied"),
        F.length(p["value"]).alias("size"),
    )
    spans = F.filter(F.transform("_parts", span), lambda s: s["size"] >= least)
    return rows.withColumn(name, F.coalesce(spans, F.array().cast("array<struct<start:int,kind:int,end:int,value:string,varied:boolean,size:int>>"))).drop("_parts", "_sizes", "_ends")


def ownership(candidates: DataFrame) -> DataFrame:
    """Distinct owners and repositories by value, from ``candidates`` (value, owner, repo)."""
    each = candidates.groupBy("value", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    by_owner = each.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return by_owner.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"))


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repo: str = "doc_id",
    example_owners: int = 3,
    example_repos: int = 50,
) -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``spans``, arrays of spans sorted by start and kind.

    A span has ``start``, ``end`` (code points, end exclusive), ``kind`` (name), and in ``spans`` also ``owners``,
    ``repos`` and ``class``: example (at least ``example_owners`` owners or ``example_repos`` repositories, whoever
    owns them), live (otherwise, one owner and at least eight different characters) or unclear.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(owner).alias("owner"), F.col(repo).alias("repo"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    kinds = (*KINDS, OWNED)
    for order, kind in enumerate(kinds):
        rows = _found(rows, f"_{kind[0]}", kind, order)
    base = F.sort_array(F.concat(*[F.col(f"_{k[0]}") for k in KINDS]))
    # a mixed token that overlaps a base span isn't another secret
    apart = F.filter("_owned", lambda o: ~F.exists("base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"])))
    rows = rows.withColumn("base", base).select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "owner", "repo", "base", apart.alias("more")
    )
    rows = cut(rows)
    name = F.array(*[F.lit(k[0]) for k in kinds])
    each = rows.select("uid", "owner", "repo", F.explode(F.concat("base", "more")).alias("s")).select("uid", "owner", "repo", "s.*")
    known = ownership(each.select("value", "owner", "repo"))
    kind_of = F.when((F.col("owners") >= example_owners) | (F.col("repos") >= example_repos), "example").when((F.col("owners") == 1) & F.col("varied"), "live").otherwise("unclear")
    judged = each.join(known, "value").withColumn("class", kind_of)
    judged = judged.where((F.col("kind") < len(KINDS)) | (F.col("class") == "live"))
    shown = F.struct("start", "kind", "end", "owners", "repos", "class")
    by_row = judged.groupBy("uid").agg(F.sort_array(F.collect_list(shown)).alias("spans"))
    joined = rows.join(by_row, "uid", "left")
    named = lambda s: F.get(name, s["kind"]).alias("kind")
    return joined.select(
        "doc_id",
        F.transform("base", lambda s: F.struct(named(s), s["start"].alias("start"), s["end"].alias("end"))).alias("base"),
        F.coalesce(
            F.transform("spans", lambda s: F.struct(named(s), s["start"].alias("start"), s["end"].alias("end"), s["owners"].alias("owners"), s["repos"].alias("repos"), s["class"].alias("class"))),
            F.array().cast("array<struct<kind:string,start:int,end:int,owners:bigint,repos:bigint,class:string>>"),
        ).alias("spans"),
    )


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
