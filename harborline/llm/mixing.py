r"""Mixing sources to target weights, in DataFrame functions only.

A source with the share p of all tokens gets the weight p**alpha, normalised. ``alpha`` is 1 for shares as
they are and 0 for equal weights; the exponent is bisected over multiples of 1e-6 to the largest that
reaches ``target_entropy`` (a part of the highest possible entropy) or the smallest at which no source is
repeated more than ``max_repeats`` times. Each round asks one aggregate over the sources for 32
exponents, five halvings at once; only these numbers reach the driver.

The budget in tokens defaults to the least at which every source is used at least once, so that no document
is lost. A source is realised as whole epochs and a part of one more; each epoch is a permutation of the
source's documents by a seeded md5, the part takes documents from the front of its permutation while their
tokens fit. The stream is divided into blocks of equal budget: a document's place within its source's
tokens tells its block, so that each block holds all sources in the target weights.

Running totals split every (source, epoch) at the leading hex digits of the permutation key: 4,096 totals
per source and epoch are summed first, and a window holds one slice.

Null sources are a source of their own. Null and empty texts have no tokens; they take their place in the
permutation. A source without tokens is used once and weighs nothing. Documents that share an id and a
source share their place; equal rows are scheduled each. Empty tables give empty results. ``schedule``
reads only the named columns; ``mix`` returns all columns as they were, each row as often as it is used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm.common import WORD, cut, fresh

GRID = 1_000_000  # exponents are multiples of 1 / GRID
SLICE = 3  # hex digits that split a permutation


@dataclass(frozen=True)
class Mixture:
    """Per-source table (source, tokens, weight, whole, part), the exponent and the number of blocks."""

    sources: DataFrame
    alpha: float
    blocks: int


def _search(low: int, high: int, ask) -> int:
    """The smallest k in [low, high] for which ``ask`` holds; it holds from some k on, and at ``high``."""
    while high - low > 0:
        step = max(1, (high - low) // 32)
        ks = list(range(low, high, step))
        holds = ask(ks)
        first = next((i for i, ok in enumerate(holds) if ok), None)
        if first is None:
            low = min(ks[-1] + 1, high)
            if low == high:
                break
        else:
            high, low = ks[first], (ks[first - 1] + 1 if first else low)
            if first == 0:
                break
    return high


def fit(
    rows: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = None,
    block_tokens: int = 1_000_000,
) -> Mixture:
    """Weights and epochs for ``rows`` (source, n)."""
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give a target entropy or a repetition limit, one of the two")
    totals = cut(rows.groupBy("source").agg(F.sum("n").alias("t")))
    known = totals.agg(
        F.sum("t").cast("double").alias("all"), F.count_if(F.col("t") > 0).alias("n"),
    ).first()
    total, n = known["all"] or 0.0, known["n"]
    used = totals.where("t > 0").withColumn("p", F.col("t") / F.lit(total or 1.0))

    def ask(make):
        def of(ks: list[int]) -> list[bool]:
            got = used.agg(*[c.alias(f"{k}_{i}") for k in ks for i, c in enumerate(make(k / GRID))]).first()
            return [test(k / GRID, [got[f"{k}_{i}"] for i in range(len(make(k / GRID)))]) for k in ks]

        return of

    power = lambda a: F.pow("p", F.lit(a))
    if n == 0:
        k = GRID
    elif max_repeats is not None:
        # with weights p**a / z, a source is repeated budget * p**(a-1) / (z * total) times
        make = lambda a: (F.max(F.pow("p", F.lit(a - 1))), F.min(F.pow("p", F.lit(a - 1))), F.sum(power(a)))
        most = lambda x: x[0] / x[1] if budget is None else budget * x[0] / (x[2] * total)
        test = lambda a, x: most(x) <= max_repeats + 1e-9
        k = _search(0, GRID, ask(make))
    else:
        # entropy falls as the exponent grows: find the first exponent that misses the target
        import math

        make = lambda a: (F.sum(power(a)), F.sum(power(a) * F.ln("p")))
        test = lambda a, x: math.log(x[0]) - a * x[1] / x[0] < target_entropy * math.log(n) - 1e-12 if n > 1 else False
        k = max(0, _search(0, GRID + 1, ask(make)) - 1)
    alpha = k / GRID
    z = used.agg(F.sum(power(alpha)).alias("z")).first()["z"] or 1.0
    weighed = used.withColumn("w", power(alpha) / F.lit(z))
    if budget is None:
        budget = weighed.agg(F.max(F.col("t") / F.col("w")).alias("b")).first()["b"] or 0.0
    blocks = max(1, -int(-budget // block_tokens))
    weight = F.when(F.col("t") > 0, F.pow(F.col("t") / F.lit(total or 1.0), F.lit(alpha)) / F.lit(z)).otherwise(0.0)
    repeats = F.when(F.col("t") > 0, F.col("w") * F.lit(float(budget)) / F.col("t")).otherwise(1.0)
    sources = totals.withColumn("w", weight).withColumn("r", repeats)
    whole = F.floor(F.col("r") + 1e-9)
    part = F.floor(F.greatest(F.col("r") - whole, F.lit(0.0)) * F.col("t") + 1e-6)
    return Mixture(
        cut(sources.select("source", "t", "w", whole.cast("long").alias("whole"), part.cast("long").alias("part"))),
        alpha,
        blocks,
    )


def _key(seed: str, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), epoch.cast("string"), F.lit("|"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` (source, epoch, key, n, ...) with ``upto``, the tokens of its permutation up to the row."""
    rows = rows.withColumn("slice", F.substring("key", 1, SLICE))
    sums = rows.groupBy("source", "epoch", "slice").agg(F.sum("n").alias("in_slice"))
    order = Window.partitionBy("source", "epoch").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("in_slice").over(order), F.lit(0))).drop("in_slice")
    sums = sums.toDF("_source", "_epoch", "_slice", "before")
    inside = Window.partitionBy("source", "epoch", "slice").orderBy("key", "n").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = rows["source"].eqNullSafe(sums["_source"]) & (rows["epoch"] == sums["_epoch"]) & (rows["slice"] == sums["_slice"])
    joined = rows.withColumn("inside", F.sum("n").over(inside)).join(sums, same)
    return joined.withColumn("upto", F.col("before") + F.col("inside")).drop("_source", "_epoch", "_slice", "before", "inside", "slice")


def _counted(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    n = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n.alias("n"))


def schedule(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: str = "mixture",
    **targets,
) -> DataFrame:
    """Every use of every document: ``doc_id``, ``source``, ``weight``, ``epoch``, ``block``, ``n_tokens``.

    ``targets`` are those of ``fit``.
    """
    rows = cut(_counted(docs, doc_id, source, text))
    mixture = fit(rows, **targets)
    s = mixture.sources.withColumnRenamed("source", "_source")
    epochs = F.sequence(F.lit(0).cast("long"), F.col("whole") - 1 + (F.col("part") > 0).cast("long"))
    used = rows.join(s, rows["source"].eqNullSafe(s["_source"])).withColumn("epoch", F.explode(epochs))
    placed = _placed(used.withColumn("key", _key(seed, F.col("epoch"), F.col("doc_id"))))
    start = (F.col("epoch") * F.col("t") + F.col("upto") - F.col("n")).cast("double")
    whole_run = F.col("whole") * F.col("t") + F.col("part")
    block = F.when(whole_run > 0, F.least(F.lit(mixture.blocks - 1), F.floor(F.lit(mixture.blocks) * start / whole_run))).otherwise(0)
    return placed.where("epoch < whole or upto <= part").select(
        "doc_id",
        "source",
        F.round("w", 9).alias("weight"),
        "epoch",
        block.cast("long").alias("block"),
        F.col("n").alias("n_tokens"),
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: str = "mixture",
    **targets,
) -> DataFrame:
    """``docs``, same columns, each row as often as the mixture uses it.

    The part of an epoch becomes one bound on the permutation key per source, so texts aren't shuffled
    where the table of sources is small.
    """
    rows = cut(_counted(docs, doc_id, source, text))
    sources = fit(rows, **targets).sources
    s = sources.where("part > 0").withColumnRenamed("source", "_source")
    partial = rows.join(s, rows["source"].eqNullSafe(s["_source"])).select("source", "part", "n", F.col("whole").alias("epoch"), "doc_id")
    placed = _placed(partial.withColumn("key", _key(seed, F.col("epoch"), F.col("doc_id"))))
    last = placed.where("upto <= part").groupBy("source").agg(F.max(F.struct("key", "n")).alias("last"))
    last = last.withColumnRenamed("source", "_s")
    src, whole, bound, uses = fresh(docs, "_src", "_whole", "_bound", "_uses")
    table = sources.join(last, sources["source"].eqNullSafe(last["_s"]), "left").select(
        F.col("source").alias(src), F.col("whole").alias(whole), F.col("last").alias(bound)
    )
    table = cut(table)
    count = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    mine = F.struct(_key(seed, F.col(whole), F.col(doc_id)).alias("key"), count.alias("n"))
    extra = F.coalesce(mine <= F.col(bound), F.lit(False)).cast("long")
    joined = docs.join(table, docs[source].eqNullSafe(table[src])).withColumn(uses, F.col(whole) + extra)
    return joined.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("long"), uses)).alias(uses)).drop(uses)
