"""The corpus pipeline at a small scale: stage by stage against what each stage promises."""

import hashlib
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from harborline.llm import line_dedup, ngram_join


def test_stages_keep_columns_and_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, found = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = line_dedup.cut(stage(spark, docs, sf))
        assert docs.columns == columns
        found.append(docs)
    raw, good, single, apart, mixed = found
    assert good.count() < raw.count()
    assert line_dedup.decisions(single).agg(F.sum("n_removed")).first()[0] == 0
    classes = ngram_join.classes(apart, width=5, similarity=80)
    assert classes.where("n_shingles > 0 and doc_id <> component_id").count() == 0
    uses = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert set(uses) == {r.doc_id for r in apart.select("doc_id").collect()} and max(uses.values()) <= 2
    last = corpus_pipeline.STAGES[-1][1](spark, mixed, sf)
    texts = {r.doc_id: r.text for r in mixed.collect()}
    for r in last.collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.token_ids)


def test_exact_copies_leave_one_document(spark, sf):
    text = " ".join(f"word{k}." for k in range(120))
    rows = [(10_000 + k, text, "en", "src0", len(text)) for k in range(5)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{sf}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf)
    assert [r.doc_id for r in docs.collect()] == [10_000]
