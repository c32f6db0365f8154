"""Retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from harborline.functions import text as tx
from harborline.operators import retrieval as ret
from harborline.operators.nearest import nearest
from harborline.plans.aggregate_queries import r
from harborline.plans.registry import query
from harborline.plans.tables import table
from harborline.session import cut


def texts(spark, sf, name="documents"):
    return table(spark, sf, name)


def documents(spark, sf):
    return texts(spark, sf).select("doc_id", "text", "source", F.lit(None).cast("int").alias("page"))


_SPACE = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_CHUNKS = rf"""w AS (SELECT doc_id, source, list_filter(regexp_split_to_array(text, '{_SPACE}'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, source, w, CAST(unnest(range(0, CASE WHEN len(w) = 0 THEN 0 WHEN len(w) <= 120 THEN 1 ELSE CAST(ceil((len(w) - 120) / 95.0) AS BIGINT) + 1 END)) AS INTEGER) AS chunk_index FROM w),
chunks AS (SELECT doc_id, source, chunk_index, array_to_string(w[chunk_index * 95 + 1 : chunk_index * 95 + 120], ' ') AS text FROM s),
ids AS (SELECT *, substr(sha256(concat_ws('|', source, 'None', CAST(chunk_index AS VARCHAR), text)), 1, 24) AS id FROM chunks)"""


@query("chunk_words", f"WITH {_CHUNKS} SELECT doc_id, chunk_index, md5(text) AS digest, length(text) AS chars FROM chunks")
def _(spark, sf):
    chunks = ret.chunk_documents(documents(spark, sf))
    return chunks.select("doc_id", "chunk_index", F.md5("text").alias("digest"), F.length("text").cast("long").alias("chars"))


@query("chunk_id", f"WITH {_CHUNKS} SELECT doc_id, chunk_index, id FROM ids")
def _(spark, sf):
    return ret.chunk_documents(documents(spark, sf)).select("doc_id", "chunk_index", "id")


_BLANKS = " || ".join(f"chr({ord(c)})" for c in tx.BLANKS)


def _chars(size: int, overlap: int) -> str:
    """CTEs of the character chunks: a level of pieces per separator, then a step per chunk in all runs of short pieces.

    ``path`` orders the runs of a document; ``ends`` are the offsets of a run's pieces, where its chunks may start and end.
    """
    levels, runs = ["l0 AS (SELECT doc_id, [] :: BIGINT[] AS path, text FROM documents)"], []
    for k, sep in enumerate(("chr(10) || chr(10)", "chr(10)", "' '")):
        levels.append(f"""c{k} AS (SELECT doc_id, path, unnest(string_split(text, {sep})) AS part, generate_subscripts(string_split(text, {sep}), 1) AS i FROM l{k}),
p{k} AS (SELECT doc_id, path, i, p, length(p) >= {size} AS long, count(*) FILTER (length(p) >= {size}) OVER (PARTITION BY doc_id, path ORDER BY i) AS run
  FROM (SELECT doc_id, path, i, CASE WHEN i = 1 THEN part ELSE {sep} || part END AS p FROM c{k}) WHERE p <> ''),
e{k} AS (SELECT *, sum(length(p)) OVER (PARTITION BY doc_id, path, run ORDER BY i) AS stop FROM p{k} WHERE NOT long),
l{k + 1} AS (SELECT doc_id, list_append(path, i) AS path, p AS text FROM p{k} WHERE long)""")
        runs.append(f"SELECT doc_id, list_append(path, min(i)) AS path, string_agg(p, '' ORDER BY i) AS text, list(CAST(stop AS BIGINT) ORDER BY i) AS ends FROM e{k} GROUP BY doc_id, path, run")
    return ",\n".join(levels) + f""",
runs AS ({" UNION ALL ".join(runs)}),
steps AS (
  SELECT doc_id, path, text, ends, CAST(0 AS BIGINT) AS start, list_max(list_filter(ends, lambda e: e <= {size})) AS stop FROM runs
  UNION ALL
  SELECT doc_id, path, text, ends, begin, list_max(list_filter(ends, lambda e: e <= begin + {size})) FROM (
    SELECT *, list_min(list_filter(ends, lambda e: e > start AND e >= stop - least({overlap}, {size} - (list_min(list_filter(ends, lambda f: f > stop)) - stop)))) AS begin
    FROM steps WHERE stop < ends[-1])),
cut AS (SELECT doc_id, path, start, trim(text[start + 1 : stop], {_BLANKS}) AS text FROM steps
  UNION ALL SELECT doc_id, path, spot, trim(text[spot + 1 : spot + {size}], {_BLANKS}) FROM (
    SELECT *, unnest(range(0, greatest(length(text) - {overlap}, 1), {size - overlap})) AS spot FROM l3)),
chars AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY path, start) - 1 AS INTEGER) AS chunk_index, text FROM cut WHERE text <> '')"""


@query(
    "chunk_chars",
    f"WITH RECURSIVE {_chars(500, 80)} SELECT doc_id, chunk_index, CAST(length(text) AS INTEGER) AS chars, md5(text) AS digest FROM chars",
)
def _(spark, sf):
    chunks = ret.chunk_by_characters(documents(spark, sf))
    return chunks.select("doc_id", "chunk_index", F.length("text").alias("chars"), F.md5("text").alias("digest"))


def _tokens(text: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '[A-Za-z0-9]+(?:[''_-][A-Za-z0-9]+)*'), lambda t: lower(t))"


_TOKENS = f"t AS (SELECT doc_id, {_tokens('text')} AS t FROM documents)"


@query("tokenize", f"WITH {_TOKENS} SELECT token, count(*) AS n FROM (SELECT unnest(t) AS token FROM t) GROUP BY 1")
def _(spark, sf):
    terms = texts(spark, sf).select(F.explode(tx.tokens(F.col("text"))).alias("token"))
    return terms.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query(
    "bigrams",
    f"WITH {_TOKENS} SELECT bigram, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || '_' || t[i + 1])) AS bigram FROM t) GROUP BY 1",
)
def _(spark, sf):
    terms = tx.sliced(texts(spark, sf).select("text"), "text").select(tx.tokens(F.col("text")).alias("t"))
    pairs = terms.select(F.explode(tx.bigrams(F.col("t"))).alias("bigram"))
    return pairs.groupBy("bigram").agg(F.count(F.lit(1)).alias("n"))


def _vectors(name: str, source: str) -> str:
    """CTEs of unit vectors as (id, bucket, u), hashed with md5, from a relation with id and text."""
    return f"""{name}_t AS (SELECT id, {_tokens('text')} AS t FROM {source}),
{name}_f AS (SELECT id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || '_' || t[i + 1]))) AS f FROM {name}_t),
{name}_h AS (SELECT id, md5(f) AS h, count(*) AS n FROM {name}_f GROUP BY 1, 2),
{name}_b AS (SELECT id, CAST('0x' || h[7:8] || h[5:6] || h[3:4] || h[1:2] AS BIGINT) % 384 AS bucket, sum(CASE WHEN CAST('0x' || h[9:10] AS BIGINT) % 2 = 1 THEN n ELSE -n END) AS v FROM {name}_h GROUP BY 1, 2),
{name} AS (SELECT id, bucket, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS u FROM {name}_b WHERE v <> 0)"""


# The 8-byte blake2b digest is not available in SQL: this run is checked in the tests.
@query("hash_embed")
def _(spark, sf):
    vectors = ret.embed(table(spark, sf, "documents").select("doc_id", "text"))
    cells = vectors.select("doc_id", F.posexplode("embedding").alias("bucket", "value"))
    return cells.where("value <> 0").select("doc_id", "bucket", r("value", 8))


@query(
    "hash_embed_md5",
    f"WITH src AS (SELECT doc_id AS id, text FROM documents), {_vectors('d', 'src')} SELECT id AS doc_id, CAST(bucket AS INTEGER) AS bucket, round(u, 8) AS value FROM d",
)
def _(spark, sf):
    vectors = ret.embed(texts(spark, sf).select("doc_id", "text"), digest="md5")
    cells = vectors.select("doc_id", F.posexplode("embedding").alias("bucket", "value"))
    return cells.where("value <> 0").select("doc_id", "bucket", r("value", 8))


@query(
    "vector_topk",
    """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
       m AS (SELECT label, i, round(avg(x), 9) AS x FROM (SELECT label, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY 1, 2),
       c AS (SELECT label, list(x ORDER BY i) AS c FROM m GROUP BY 1),
       s AS (SELECT c.label, vec_id, round(list_dot_product(c, v), 9) AS score FROM c, e)
       SELECT label, vec_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM s WHERE score >= 0.0) WHERE rank <= 5""",
)
def _(spark, sf):
    # The mean vector of each label asks for its nearest vectors.
    df = table(spark, sf, "embeddings")
    cells = df.select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 9).alias("x"))
    queries = means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("vector")
    )
    items = df.select(F.col("vec_id").alias("item_id"), F.col("embedding").cast("array<double>").alias("vector"))
    found = nearest(queries, items, 5, min_score=0.0)
    return found.select(F.col("query_id").alias("label"), F.col("item_id").alias("vec_id"), r("score", 6), "rank")


# Retrieval over conversations: a user turn asks, the assistant turns are the stored chunks, and
# the right source is the conversation itself (none where the assistant never replied).
_TALK = f"""turns AS (SELECT conv_id * 1000 + turn AS key, conv_id, role, text FROM conversations),
q AS (SELECT key AS id, conv_id, text FROM turns WHERE role = 'user'), c AS (SELECT key AS id, conv_id, concat('conv', CAST(conv_id AS VARCHAR), '.') AS source, text FROM turns WHERE role = 'assistant'),
{_vectors('qv', 'q')}, {_vectors('cv', 'c')},
sc AS (SELECT qv.id AS question_id, cv.id AS id, round(sum(qv.u * cv.u), 9) AS score FROM qv JOIN cv USING (bucket) GROUP BY 1, 2)"""
_HITS = f"""{_TALK}, hits AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) AS rank FROM sc WHERE score >= 0.05 QUALIFY rank <= 5),
full_hits AS (SELECT h.*, c.source, c.text FROM hits h JOIN c ON h.id = c.id)"""


def talk(spark, sf):
    """(questions, chunks) with embeddings; each is written once, because hashing is the slow step."""
    turns = texts(spark, sf, "conversations").withColumn("key", F.col("conv_id") * 1000 + F.col("turn"))
    questions = turns.where("role = 'user'").select(F.col("key").alias("question_id"), "conv_id", "text")
    source = F.concat(F.lit("conv"), F.col("conv_id").cast("string"), F.lit("."))
    chunks = turns.where("role = 'assistant'").select(
        F.col("key").alias("id"), "conv_id", source.alias("source"), F.lit(None).cast("int").alias("page"), "text"
    )
    return cut(ret.embed(questions, digest="md5")), cut(ret.embed(chunks, digest="md5"))


def _hits(spark, sf):
    questions, chunks = talk(spark, sf)
    return questions, chunks, ret.search(questions, chunks)


@query("search_documents", f"WITH {_HITS} SELECT question_id, rank, id, round(score, 6) AS score FROM full_hits")
def _(spark, sf):
    return _hits(spark, sf)[2].select("question_id", "rank", "id", r("score", 6))


_OVERLAP = f"coalesce(len(list_intersect(list_distinct({_tokens('q.text')}), {_tokens('c.text')})) / nullif(len(list_distinct({_tokens('q.text')})), 0), 0)"


@query(
    "two_stage_rerank",
    f"""WITH {_TALK}, first AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) AS rank FROM sc WHERE score >= 0.05 QUALIFY rank <= 10),
        again AS (SELECT question_id, f.id, {_OVERLAP} AS score FROM first f JOIN q ON q.id = question_id JOIN c ON c.id = f.id)
        SELECT question_id, id, round(score, 8) AS score, row_number() OVER (PARTITION BY question_id ORDER BY again.score DESC, id) AS rank FROM again WHERE again.score >= 0.1 QUALIFY rank <= 4""",
)
def _(spark, sf):
    questions, chunks = talk(spark, sf)
    found = ret.two_stage(questions, chunks, threshold=0.1, min_score=0.05)
    return found.select("question_id", "id", r("score", 8), "rank")


_CONTEXT = "string_agg(concat('[Source: ', source, '; relevance=', printf('%.3f', score), ']', chr(10), text), concat(chr(10), chr(10)) ORDER BY rank)"


@query("format_context", f"WITH {_HITS} SELECT question_id, {_CONTEXT} AS context FROM full_hits GROUP BY 1")
def _(spark, sf):
    return ret.format_context(_hits(spark, sf)[2])


@query(
    "refuse_when_empty",
    f"""WITH {_HITS}, x AS (SELECT question_id, {_CONTEXT} AS context FROM full_hits GROUP BY 1)
        SELECT q.id AS question_id, coalesce(concat('Relevant information from the indexed documents:', chr(10), chr(10)) || context, 'I could not find that in the indexed documents.') AS answer FROM q LEFT JOIN x ON q.id = question_id""",
)
def _(spark, sf):
    questions, _, hits = _hits(spark, sf)
    return ret.answer(questions, hits)


@query(
    "retrieval_hit_rate",
    f"""WITH {_HITS}, e AS (SELECT q.id AS question_id, CASE WHEN conv_id IN (SELECT conv_id FROM c) THEN concat('conv', CAST(conv_id AS VARCHAR), '.') END AS expected FROM q),
        h AS (SELECT e.question_id, CASE WHEN expected IS NULL THEN count(source) = 0 ELSE coalesce(bool_or(contains(source, expected)), false) END AS hit FROM e LEFT JOIN full_hits f ON e.question_id = f.question_id GROUP BY e.question_id, expected)
        SELECT count(*) AS questions, count(*) FILTER (hit) AS hits, round(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END), 8) AS hit_rate FROM h""",
)
def _(spark, sf):
    questions, chunks, hits = _hits(spark, sf)
    known = chunks.select("conv_id", F.col("source").alias("expected_source")).distinct()
    expected = questions.select("question_id", "conv_id").join(known, "conv_id", "left").drop("conv_id")
    return ret.hit_rate(expected, hits).select("questions", "hits", r("hit_rate", 8))


@query(
    "recall_precision_mrr",
    f"""WITH {_HITS}, rel AS (SELECT q.id AS question_id, c.id FROM q JOIN c USING (conv_id)), w AS (SELECT question_id, count(*) AS wanted FROM rel GROUP BY 1),
        g AS (SELECT question_id, count(*) AS got, min(rank) AS first FROM hits JOIN rel USING (question_id, id) GROUP BY 1)
        SELECT round(avg(coalesce(got, 0) / wanted), 8) AS recall, round(avg(coalesce(got, 0) / 5), 8) AS precision, round(avg(coalesce(1 / first, 0)), 8) AS mrr
        FROM (SELECT id AS question_id FROM q) LEFT JOIN w USING (question_id) LEFT JOIN g USING (question_id)""",
)
def _(spark, sf):
    questions, chunks, hits = _hits(spark, sf)
    sizes = chunks.groupBy(F.col("conv_id").alias("topic")).agg(F.count(F.lit(1)).alias("wanted"))
    found = ret.rank_metrics(
        questions.select("question_id", F.col("conv_id").alias("topic")), sizes, hits.withColumnRenamed("conv_id", "topic"), 5
    )
    return found.select(r("recall", 8), r("precision", 8), r("mrr", 8))


@query(
    "judge_averages",
    """WITH j AS (SELECT event_type, CASE WHEN event_type = 'error' AND value > 100 THEN NULL WHEN value > 200 THEN 'not valid' ELSE json_extract_string(props, '$.k') END AS faithfulness FROM events)
       SELECT event_type, round(avg(TRY_CAST(faithfulness AS DOUBLE)), 8) AS mean_faithfulness, count(TRY_CAST(faithfulness AS DOUBLE)) AS valid_faithfulness FROM j GROUP BY 1""",
)
def _(spark, sf):
    given = F.get_json_object("props", "$.k")
    text = F.when((F.col("event_type") == "error") & (F.col("value") > 100), None).when(F.col("value") > 200, "not valid").otherwise(given)
    df = table(spark, sf, "events").select("event_type", text.alias("faithfulness"))
    found = ret.judge_averages(df, ["faithfulness"], ["event_type"])
    return found.select("event_type", r("mean_faithfulness", 8), "valid_faithfulness")
