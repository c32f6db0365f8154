"""Quality rules: text statistics and a learned decision list, in column expressions only.

``statistics`` counts words, symbols and repeats of whole texts inside each row. ``fit`` learns an ordered
list of threshold conjunctions that mark poor documents by sequential covering: a conjunction grows by
the condition of highest information gain on two thirds of the labelled rows, is pruned on the other third, is
kept if it is precise enough there, and the rows it covers leave before the next one grows. Every step
is one Spark aggregate whose result has at most (statistics x thresholds) rows. ``verdict`` turns the list
into one ordered ``CASE`` expression.

Nulls and empty texts: null text counts as empty; it has no words and every ratio is 0. Documents
without a label, with a null label or a null id don't take part in the fit; a document with
contradicting labels counts as poor. Without labels, or with labels of one class only, the list is
empty and only the base rule rejects. Repeated documents are judged each. Extra columns pass through;
statistics live in one struct column whose name the caller picks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import cut, fresh, words

# Characters that count as symbols, and the base rule's limits.
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

FEATURES = (
    "n_words",
    "chars_per_word",
    "symbols_per_word",
    "duplicate_line_share",
    "repeated_word_share",
    "sentence_end_share",
    "words_per_line",
    "digit_share",
    "capital_share",
)


def statistics(docs: DataFrame, text: str = "text", stats: str = "stats") -> DataFrame:
    """``docs`` with a struct column of counts and ratios of each whole text.

    Words in a 3-word window found twice are counted by sorting the row's window hashes (64 bits) with
    their positions: equal windows become neighbours, which takes n log n steps for a text of n words.
    """
    body, ws, spots, lines = fresh(docs, "_body", "_words", "_spots", "_lines")
    raw = docs.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    raw = raw.withColumn(ws, words(F.col(body)))
    at = lambda a, i: F.get(F.col(a), i)
    windows = F.sort_array(
        F.transform(
            F.slice(F.col(ws), F.lit(1), F.greatest(F.size(ws) - 2, F.lit(0))),
            lambda w, i: F.struct(F.xxhash64(w, at(ws, i + 1), at(ws, i + 2)).alias("h"), i.alias("i")),
        )
    )
    raw = raw.withColumn(spots, windows)
    same = lambda t, other: F.coalesce(t["h"] == other["h"], F.lit(False))
    twice = F.filter(F.col(spots), lambda t, i: same(t, at(spots, i - 1)) | same(t, at(spots, i + 1)))
    raw = raw.withColumn(spots, F.sort_array(F.transform(twice, lambda t: t["i"])))
    covered = F.aggregate(
        F.transform(F.col(spots), lambda p, i: F.least(F.lit(3), F.coalesce(at(spots, i + 1) - p, F.lit(3)))),
        F.lit(0),
        lambda total, n: total + n,
    )
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    raw = raw.withColumn(lines, F.filter(F.split(F.col(body), "\n", -1), has_word))
    n_words, n_lines = F.size(ws), F.size(lines)
    counts = {
        "n_words": n_words,
        "word_chars": F.length(F.array_join(F.col(ws), "")),
        "n_symbols": F.regexp_count(F.col(body), F.lit(SYMBOLS)),
        "n_dup_lines": n_lines - F.size(F.array_distinct(F.col(lines))),
        "n_repeat_words": covered,
        "n_lines": n_lines,
        "n_ends": F.regexp_count(F.col(body), F.lit(r"[.!?](?=[\x20\x09-\x0D]|\z)")),
        "n_digits": F.regexp_count(F.col(body), F.lit("[0-9]")),
        "n_capitals": F.regexp_count(F.col(body), F.lit("[A-Z]")),
    }
    kept = [c for c in docs.columns if c != stats]
    # one row each from a generator: a later filter on the counts stays above it, where they are computed
    made = F.array(F.struct(*[c.cast("long").alias(n) for n, c in counts.items()]))
    return raw.select(*kept, F.explode(made).alias(stats))


def features(stats: str = "stats") -> dict[str, Column]:
    """The ratios that rules may test, by name."""
    s = lambda n: F.col(f"{stats}.{n}").cast("double")
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return {
        "n_words": s("n_words"),
        "chars_per_word": share(s("word_chars"), s("n_words")),
        "symbols_per_word": share(s("n_symbols"), s("n_words")),
        "duplicate_line_share": share(s("n_dup_lines"), s("n_lines")),
        "repeated_word_share": share(s("n_repeat_words"), s("n_words")),
        "sentence_end_share": share(s("n_ends"), s("n_words")),
        "words_per_line": share(s("n_words"), s("n_lines")),
        "digit_share": share(s("n_digits"), s("word_chars")),
        "capital_share": share(s("n_capitals"), s("word_chars")),
    }


def base_failed(stats: str = "stats") -> Column:
    """The fixed rule: too few words, or more than half of the words repeated."""
    n, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, stats: str = "stats") -> Column:
        value = features(stats)[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Sequence[Condition], stats: str) -> Column:
    test = F.lit(True)
    for condition in rule:
        test = test & condition.column(stats)
    return test


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    quality: str = "quality",
    fit_rows: int = 20_000,
    bins: int = 32,
    max_rules: int = 8,
    max_conditions: int = 3,
    precision: float = 0.98,
    least_cover: int = 5,
) -> list[Rule]:
    """Learn rules for documents whose ``quality`` label is 0.

    ``fit_rows`` bounds the labelled rows of the fit: those of the lowest hashed ids. Their ids are the one
    thing broadcast (16 bytes each). Statistics of these rows are written once; every later step reads
    that small table.
    """
    labelled = (
        labels.where(F.col(doc_id).isNotNull() & F.col(quality).isNotNull())
        .groupBy(F.col(doc_id).alias("_id"))
        .agg((F.min(quality) == 0).alias("_poor"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(fit_rows)
    )
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(labelled), "_id")
    rows = statistics(rows, "_text").where(~base_failed())
    columns = features()
    grow = F.pmod(F.xxhash64("_id", F.lit("grow")), F.lit(3)) < 2
    sample = cut(rows.select(grow.alias("grow"), F.col("_poor").alias("poor"), "stats"))
    steps = [k / bins for k in range(1, bins)]
    cuts = sample.agg(*[F.percentile(c, F.lit(steps)).alias(n) for n, c in columns.items()]).first()
    thresholds = {n: sorted(set(cuts[n] or [])) for n in FEATURES}

    def bin_of(name: str) -> Column:
        found = F.lit(0)
        for t in thresholds[name]:
            found = found + (columns[name] > F.lit(t)).cast("int")
        return found.alias(name)

    raw = F.struct(*[c.alias(n) for n, c in columns.items()]).alias("raw")
    coded = cut(sample.select("grow", "poor", raw, *[bin_of(n) for n in FEATURES]))

    def holds(c: Condition) -> Column:
        k = thresholds[c.feature].index(c.threshold)
        return F.col(c.feature) > k if c.above else F.col(c.feature) <= k

    def all_hold(rule: Sequence[Condition]) -> Column:
        test = F.lit(True)
        for c in rule:
            test = test & holds(c)
        return test

    def best(open_rows: DataFrame) -> Condition | None:
        """The condition of highest gain on the growing rows still covered."""
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in FEATURES]))
        found = (
            open_rows.where("grow")
            .select("poor", pairs.alias("x"))
            .groupBy("x.f", "x.b")
            .agg(F.sum(F.col("poor").cast("int")).alias("p"), F.sum((~F.col("poor")).cast("int")).alias("n"))
            .collect()
        )
        counts = {n: [[0, 0] for _ in range(len(thresholds[n]) + 1)] for n in FEATURES}
        for r in found:
            counts[r.f][r.b] = [r.p, r.n]
        options = []
        for name in FEATURES:
            p_all, n_all = (sum(x[k] for x in counts[name]) for k in (0, 1))
            if not p_all or not n_all:
                continue
            before, p_low, n_low = math.log2(p_all / (p_all + n_all)), 0, 0
            for k, t in enumerate(thresholds[name]):
                p_low, n_low = p_low + counts[name][k][0], n_low + counts[name][k][1]
                for above, p, n in ((False, p_low, n_low), (True, p_all - p_low, n_all - n_low)):
                    if p >= least_cover:
                        options.append((p * (math.log2(p / (p + n)) - before), name, above, t))
        gain, name, above, t = max(options, default=(0.0, "", False, 0.0))
        return Condition(name, above, t) if gain > 0 else None

    def covered(rows: DataFrame, rule: Sequence[Condition]) -> tuple[int, int]:
        got = rows.where(all_hold(rule)).agg(
            F.sum(F.col("poor").cast("int")).alias("p"), F.sum((~F.col("poor")).cast("int")).alias("n")
        ).first()
        return got.p or 0, got.n or 0

    def midway(rows: DataFrame, rule: Sequence[Condition]) -> Rule:
        """The rule with each threshold moved halfway to the nearest poor document that it covers."""
        nearest = [(F.min if c.above else F.max)(f"raw.{c.feature}").alias(f"c{k}") for k, c in enumerate(rule)]
        found = rows.where(F.col("poor") & all_hold(rule)).agg(*nearest).first()
        return tuple(Condition(c.feature, c.above, (c.threshold + found[k]) / 2) for k, c in enumerate(rule))

    rules: list[Rule] = []
    left = coded
    while len(rules) < max_rules:
        rule: list[Condition] = []
        while len(rule) < max_conditions:
            step = best(left.where(all_hold(rule)))
            if step is None:
                break
            rule.append(step)
        scores = []
        for n in range(len(rule), 0, -1):  # prune from the end, judged on rows that didn't grow the rule
            p, wrong = covered(left.where("not grow"), rule[:n])
            scores.append(((p - wrong) / (p + wrong) if p + wrong else -1.0, p, n))
        value, p, n = max(scores, default=(-1.0, 0, 0))
        if n == 0 or p < least_cover or value < 2 * precision - 1:
            break
        rules.append(midway(left, rule[:n]))
        left = left.where(~all_hold(rule[:n]))
    return rules


def verdict(rules: Sequence[Rule], stats: str = "stats") -> Column:
    """Number of the first rule that holds: 0 for the base rule, 1... for learned ones, null for kept rows."""
    found = F.when(base_failed(stats), F.lit(0))
    for k, rule in enumerate(rules, 1):
        found = found.when(_all(rule, stats), F.lit(k))
    return found


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", stats: str = "stats") -> DataFrame:
    """``docs`` with the statistics struct and ``<stats>_rule``, the rule that rejects the row (null: kept)."""
    rules = fit(docs, labels, text, doc_id)
    return statistics(docs, text, stats).withColumn(f"{stats}_rule", verdict(rules, stats))
