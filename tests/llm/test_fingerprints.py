"""Sketches and edited texts against sets of shingles."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.llm import fingerprints, queries

DOCS = "doc_id long, text string"


def shingles(text, width=fingerprints.WIDTH):
    words = (text or "").encode().split()
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def share(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, text) in enumerate(rows):
        later, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        edited = text[: len(text) - half] + later[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, later))
    return out


def check(found, rows):
    made = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in found), key=str)
    as_text = lambda t: fingerprints.written(fingerprints.sketched(t))
    near = lambda a, b: fingerprints.shared(fingerprints.sketched(a), fingerprints.sketched(b))
    assert made == sorted(((i, n, sha, as_text(t), as_text(e), near(t, e), near(t, later)) for i, n, sha, t, e, later in expected(rows)), key=str)


def test_query_against_plain_loops(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op12_fingerprints"](spark, sf).collect()
    check(found, rows)
    true = {i: (share(shingles(t), shingles(e)), share(shingles(t), shingles(later)), len(shingles(t))) for i, _, _, t, e, later in expected(rows)}
    long = [r for r in found if true[r.doc_id][2] >= 100]
    assert len(long) > 50
    assert np.mean([abs(r.near_edited - true[r.doc_id][0]) for r in long]) < 0.06
    assert np.mean([abs(r.near_next - true[r.doc_id][1]) for r in long]) < 0.01


ODD = [
    (3, "one two three four five six seven"), (3, "one two three four five six seven"), (3, None), (None, "no id here"), (None, None),
    (1, ""), (2, " \t\n"), (5, "short"), (7, "größe 日本語 emoji 😀 text with, code points beyond bytes"), (-4, "a b c d e"), (9, "word " * 40_000),
]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, DOCS).withColumns({"range": F.lit("x"), "ahead": F.lit(1), "n_chars": F.lit(0.5), "_text": F.lit(1)})
    check(fingerprints.edits(df).collect(), ODD)
    check(fingerprints.edits(df.where("doc_id = 5")).collect(), [(5, "short")])
    check(fingerprints.edits(df.where("doc_id is null")).collect(), [r for r in ODD if r[0] is None])
    assert fingerprints.edits(df.where("false")).collect() == []
    made = fingerprints.fingerprints(df, into="range")
    assert sorted(made.columns) == sorted(df.columns)
    for r in made.collect():
        assert r.range == [int(x) for x in fingerprints.sketched(r.text).view(np.int64)]


def test_hot_id_and_many_ranges(spark):
    rnd = np.random.default_rng(3)
    rows = [(int(i), " ".join(rnd.choice(["a", "b", "c", "d"], 12))) for i in rnd.integers(0, 500, 600)] + [(77, f"same id {k % 40}") for k in range(300)]
    check(fingerprints.edits(spark.createDataFrame(rows, DOCS).repartition(7)).collect(), rows)


def test_pieces_do_not_change_a_sketch(monkeypatch):
    rnd = np.random.default_rng(4)
    text = " ".join("w" * int(k % 9 + 1) + str(k) for k in rnd.integers(0, 500, 20_000)) + " " + "x" * 5_000
    whole = fingerprints.sketched(text)
    monkeypatch.setattr(fingerprints, "PIECE", 100)
    assert np.array_equal(fingerprints.sketched(text), whole)
    assert abs(len(whole) * fingerprints.SCALE / len(shingles(text)) - 1) < 0.1


@pytest.mark.parametrize("size", [30, 300])
def test_containment_of_unequal_documents_and_merged_sketches(spark, size):
    rnd = np.random.default_rng(5)
    words = [f"v{k}" for k in rnd.integers(0, 10**6, 20_000)]
    rows = [(1, " ".join(words), "s"), (2, " ".join(words[5_000 : 5_000 + size * 10]), "t"), (3, " ".join(f"z{w}" for w in words[:500]), "s"), (4, None, "t")]
    made = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string, source string"), scale=4).cache()
    pair = made.where("doc_id = 2").select(F.col("sketch").alias("a")).crossJoin(made.where("doc_id = 1").select(F.col("sketch").alias("b")))
    r = pair.select(fingerprints.containment(F.col("a"), F.col("b")).alias("c"), fingerprints.containment(F.col("b"), F.col("a")).alias("d"), fingerprints.likeness(F.col("a"), F.col("b")).alias("l")).first()
    assert r.c == 1.0 and abs(r.d - size * 10 / 20_000) < 0.05 and abs(r.l - r.d) < 1e-9
    groups = fingerprints.merged(made, "source")
    held = {(r.doc_id, r.source): r.containment for r in fingerprints.contained(made, groups, "doc_id", "source").collect()}
    assert held[2, "s"] == 1.0 and held[1, "s"] == 1.0 and held[3, "s"] == 1.0 and (3, "t") not in held and 0 < held[1, "t"] < 0.3
    empty = spark.range(1).select(F.array().cast("array<long>").alias("a"), F.array(F.lit(1).cast("long")).alias("b"))
    c, l = fingerprints.containment, fingerprints.likeness
    assert tuple(empty.select(c(F.col("a"), F.col("a")), c(F.col("a"), F.col("b")), l(F.col("a"), F.col("a")), l(F.col("a"), F.col("b"))).first()) == (1.0, 0.0, 1.0, 0.0)
