"""Batch document retrieval: chunk, embed, search, rerank, cite and evaluate.

Questions are scored as a batch against the stored chunks; see ``nearest`` for how the scores
stay inside tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions import text as tx
from harborline.operators.nearest import nearest
from harborline.operators.windows import top_n

# Answer texts and the search limits.
NOT_FOUND = "I could not find that in the indexed documents."
FOUND = "Relevant information from the indexed documents:\n\n"
TOP_K, MIN_SCORE = 5, 0.05
FIRST_K, FINAL_K = 10, 4


def chunk_documents(docs: DataFrame, size: int = 120, overlap: int = 25) -> DataFrame:
    """(id, text, source, page, chunk_index, ...) word chunks of (text, source, page, ...)."""
    rest = [c for c in docs.columns if c not in ("text", "source", "page")]
    split = docs.withColumn("_words", tx.words(F.col("text")))
    chunks = split.select("source", "page", *rest, F.posexplode(tx.word_windows(F.col("_words"), size, overlap)).alias("chunk_index", "text"))
    return chunks.withColumn("id", tx.chunk_id(F.col("source"), F.col("page"), F.col("chunk_index"), F.col("text")))


def chunk_by_characters(docs: DataFrame, size: int = 500, overlap: int = 80) -> DataFrame:
    rest = [c for c in docs.columns if c != "text"]
    return docs.select(*rest, F.posexplode(tx.chunk_characters(F.col("text"), size, overlap)).alias("chunk_index", "text"))


def embed(df: DataFrame, dimensions: int = 384, digest: str = "blake2b") -> DataFrame:
    """Add ``embedding`` of the column ``text``."""
    return df.withColumn("embedding", tx.hash_embed(tx.text_features(F.col("text")), dimensions, digest))


def search(questions: DataFrame, chunks: DataFrame, k: int = TOP_K, min_score: float = MIN_SCORE) -> DataFrame:
    """(question_id, rank, score, id, ...) best chunks per question; both sides carry ``embedding``."""
    found = nearest(
        questions.select(F.col("question_id").alias("query_id"), F.col("embedding").alias("vector")),
        chunks.select(F.col("id").alias("item_id"), F.col("embedding").alias("vector")),
        k,
        min_score=min_score,
    )
    hits = found.select(F.col("query_id").alias("question_id"), F.col("item_id").alias("id"), "score", "rank")
    return hits.join(chunks.drop("embedding"), "id")


def overlap_score(question: Column, passage: Column) -> Column:
    """Share of the question's distinct words that the passage holds."""
    asked = F.array_distinct(tx.tokens(question))
    shared = F.size(F.array_intersect(asked, tx.tokens(passage)))
    return F.coalesce(shared / F.nullif(F.size(asked), F.lit(0)), F.lit(0.0))


def rerank(questions: DataFrame, hits: DataFrame, threshold: float, keep: int = FINAL_K) -> DataFrame:
    """Candidates scored again by word overlap, those below ``threshold`` dropped, the best kept."""
    asked = questions.select("question_id", F.col("text").alias("_question"))
    scored = hits.drop("score", "rank").join(asked, "question_id").withColumn("score", overlap_score(F.col("_question"), F.col("text")))
    passing = scored.where(F.col("score") >= threshold).drop("_question")
    return top_n(passing, ["question_id"], [F.col("score").desc(), F.col("id")], keep)


def two_stage(questions: DataFrame, chunks: DataFrame, threshold: float, min_score: float | None = None) -> DataFrame:
    return rerank(questions, search(questions, chunks, FIRST_K, min_score), threshold)


def cite(source: Column, page: Column, score: Column, text: Column) -> Column:
    """``[Source: name, page n; relevance=0.123]`` and the text on the next line."""
    shown = F.call_function("format_number", score, F.lit("0.000"))
    where = F.concat(source, F.when(page.isNotNull(), F.concat(F.lit(", page "), page.cast("string"))).otherwise(""))
    return F.concat(F.lit("[Source: "), where, F.lit("; relevance="), shown, F.lit("]\n"), text)


def format_context(hits: DataFrame) -> DataFrame:
    """(question_id, context): cited hits in rank order. A question has at most k hits."""
    cited = hits.withColumn("_c", cite(F.col("source"), F.col("page"), F.col("score"), F.col("text")))
    ordered = F.sort_array(F.collect_list(F.struct("rank", "_c")))
    return cited.groupBy("question_id").agg(F.array_join(F.transform(ordered, lambda s: s["_c"]), "\n\n").alias("context"))


def answer(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """(question_id, answer): the context, or a refusal when nothing was found."""
    context = F.concat(F.lit(FOUND), F.col("context"))
    return questions.select("question_id").join(format_context(hits), "question_id", "left").select(
        "question_id", F.coalesce(context, F.lit(NOT_FOUND)).alias("answer")
    )


def retrieval_hits(expected: DataFrame, hits: DataFrame) -> DataFrame:
    """(question_id, hit): expected source among the hits; with none expected, no hits at all."""
    rows = expected.join(hits.select("question_id", "source"), "question_id", "left")
    inside = F.coalesce(F.bool_or(F.contains("source", "expected_source")), F.lit(False))
    return rows.groupBy("question_id", "expected_source").agg(inside.alias("_in"), F.count("source").alias("_n")).select(
        "question_id",
        F.when(F.col("expected_source").isNull(), F.col("_n") == 0).otherwise(F.col("_in")).alias("hit"),
    )


def hit_rate(expected: DataFrame, hits: DataFrame) -> DataFrame:
    return retrieval_hits(expected, hits).agg(
        F.count(F.lit(1)).alias("questions"), F.count_if("hit").alias("hits"), F.avg(F.col("hit").cast("double")).alias("hit_rate")
    )


def rank_metrics(questions: DataFrame, topic_sizes: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """Recall@k, precision@k and mean reciprocal rank; a chunk is relevant when it has the question's topic.

    ``questions`` is (question_id, topic), ``topic_sizes`` (topic, wanted) counts the chunks of a
    topic, ``hits`` carries question_id, rank and topic. Relevant pairs are never listed, so a
    topic with very many chunks costs no more than its count. A question without a relevant chunk counts as
    precision and reciprocal rank 0; its recall is undefined and left out of the mean.
    """
    good = hits.where(F.col("rank") <= k).join(questions, ["question_id", "topic"], "left_semi")
    found = good.groupBy("question_id").agg(F.count(F.lit(1)).alias("got"), F.min("rank").alias("first"))
    per = questions.join(topic_sizes, "topic", "left").join(found, "question_id", "left").fillna(0, subset=["got"])
    return per.agg(
        F.avg(F.col("got") / F.col("wanted")).alias("recall"),
        F.avg(F.col("got") / F.lit(k)).alias("precision"),
        F.avg(F.coalesce(1 / F.col("first"), F.lit(0.0))).alias("mrr"),
    )


def judge_averages(df: DataFrame, scores: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and number of the scores that are numbers."""
    value = lambda c: F.col(c).try_cast("double")
    return df.groupBy(*by).agg(
        *[f(value(c)).alias(f"{n}_{c}") for c in scores for n, f in (("mean", F.avg), ("valid", F.count))]
    )
