"""Queries of the training-data operators, with SQL where SQL can state them.

Each query applies its operator to the whole table and derives the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import bpe, chat, embedding_dedup, fingerprints, line_dedup, mixing, ngram_join, prefix_trie, quality, repair, secrets, suffix_dedup, warc
from harborline.llm.common import table
from harborline.session import configure, drop_at_end, scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of every document in the mixture: epoch and block; no source repeats more than 4 times."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.schedule(docs, max_repeats=4.0, block_tokens=100_000)


OP1_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n FROM documents),
s AS (SELECT source, sum(n)::BIGINT AS t FROM d GROUP BY source),
a AS (SELECT CASE WHEN max(t) = min(t) THEN 0 ELSE
        greatest(0, ceil((1 - ln(4) / ln(max(t)::DOUBLE / min(t))) * 1e6) / 1e6) END AS alpha, sum(t)::DOUBLE AS total FROM s),
w AS (SELECT source, t, pow(t / total, alpha) / sum(pow(t / total, alpha)) OVER () AS w FROM s, a),
r AS (SELECT source, t, w, w * max(t / w) OVER () / t AS r, max(t / w) OVER () AS budget FROM w),
f AS (SELECT source, t, w, CAST(floor(r + 1e-9) AS BIGINT) AS whole,
        CAST(floor(greatest(r - floor(r + 1e-9), 0) * t + 1e-6) AS BIGINT) AS part,
        CAST(ceil(budget / 100000) AS BIGINT) AS blocks FROM r),
e AS (SELECT d.doc_id, d.source, n, t, w, whole, part, blocks, unnest(range(0, whole + CASE WHEN part > 0 THEN 1 ELSE 0 END)) AS epoch
      FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
k AS (SELECT *, md5(concat('mixture|', epoch, '|', doc_id)) AS key FROM e),
c AS (SELECT *, sum(n) OVER (PARTITION BY source, epoch ORDER BY key, n RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM k)
SELECT doc_id, source, round(w, 9) AS weight, CAST(epoch AS BIGINT) AS epoch,
  CAST(least(blocks - 1, floor(blocks * (epoch * t + upto - n)::DOUBLE / (whole * t + part))) AS BIGINT) AS block, CAST(n AS BIGINT) AS n_tokens
FROM c WHERE epoch < whole OR upto <= part
"""


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding among those of its label."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document under Jaccard 0.9 on 3-word shingles."""
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base spans, and those that corpus-wide ownership adds."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    of_class = lambda name: F.size(F.filter("spans", lambda s: s["class"] == name)).cast("long").alias(f"n_{name}")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
        of_class("live"),
        of_class("example"),
    )


def op5_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each participant, with the spans to learn from."""
    made = chat.dialogues(table(spark, sf_dir, "conversations"))
    place = lambda x: (F.col("offset") + x).cast("string")
    spans = F.transform("mask", lambda m: F.concat_ws(":", place(m["start"]), place(m["end"])))
    return made.select("conv_id", "segment", "speaker", "n_turns", "rendered", F.array_join(spans, ",").alias("mask"))


OP5_SQL = """
WITH t AS (SELECT conv_id, turn, role, replace(coalesce(text, ''), '<|', '< |') AS said FROM conversations),
n AS (SELECT conv_id, role, said || '<|end|>' || chr(10) AS body, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, said) AS k FROM t),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role IS NOT NULL AND role <> 'system'),
r AS (SELECT n.*, speaker, coalesce(role = speaker, false) AS own,
    CASE WHEN role IS NULL THEN '<|user|>' WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>'
         ELSE '<|user name=' || role || '|>' END || chr(10) AS head
  FROM n JOIN p ON n.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (SELECT *, (k - 1) // 1024 AS segment, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker ORDER BY k) AS stop FROM r)
SELECT conv_id, segment, speaker, count(*) AS n_turns, string_agg(head || body, '' ORDER BY k) AS rendered,
  coalesce(string_agg((stop - length(body)) || ':' || stop, ',' ORDER BY k) FILTER (WHERE own), '') AS mask
FROM o GROUP BY conv_id, segment, speaker
"""


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the bytes they decode to, as digests."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    vocabulary = bpe.Vocabulary(spark, path, pattern)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, vocabulary).drop("text")
    return bpe.decode(coded, vocabulary).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the decision list's verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id",
        *[F.col(f"stats.{n}").alias(n) for n in names],
        quality.base_failed().alias("base_failed"),
        F.col("stats_rule").isNull().alias("kept"),
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without strings of 400 bytes that start elsewhere too."""
    found = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("spans") > 0).alias("lost"),
    )


def op9_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record reads in the archives."""
    folder = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    drop_at_end(spark, folder)
    found = warc.read(spark, folder, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
k AS (SELECT digest, max(page_id) AS keep FROM p WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN keep > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keep > page_id THEN keep END AS refers_to
FROM p LEFT JOIN k ON p.digest = k.digest
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines of every document go, and which, because an earlier line is similar."""
    return line_dedup.decisions(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of conversations that start with turns of another one."""
    turns = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    members = turns.groupBy("conv_id").agg(F.max("depth").alias("own"))
    borrowed = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).alias("borrowed")
    members = members.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), borrowed, "own")
    # how many turns the other conversation really lends
    lenders = members.select(F.col("conv_id").alias("base"), F.col("own").alias("has"))
    members = members.join(lenders, "base", "left").withColumn("lent", F.least("borrowed", F.coalesce("has", F.lit(0))))
    heads = turns.where("depth <= 8 and conv_id % 5 = 0").withColumnRenamed("conv_id", "base")
    heads = members.select("conv_id", "base", "lent").join(heads, "base").where("depth <= lent")
    rest = turns.join(members.select("conv_id", "borrowed", "lent"), "conv_id").where("depth > borrowed")
    rest = rest.withColumn("depth", F.col("depth") - F.col("borrowed") + F.col("lent"))
    names = ("conv_id", "depth", "said", "bytes")
    found = prefix_trie.trie(heads.select(*names).unionByName(rest.select(*names)), members.select("conv_id"))
    digests = prefix_trie.ends_digests(found.ends)
    digest = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    rows = found.nodes.join(digests, ["conv_id", "depth"], "left")
    return rows.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and its edited text, with their likeness and that to the next document."""
    return fingerprints.edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _damaged(turns: DataFrame) -> DataFrame:
    """Conversations with planted faults, by a checksum of conversation and turn."""
    known = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after planted damage."""
    turns = table(spark, sf_dir, "conversations")
    found = repair.summary(repair.repair(_damaged(turns))).withColumnRenamed("conv_id", "_id")
    every = turns.select("conv_id").distinct()
    rows = every.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce(F.col("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return rows.select("conv_id", *numbers, F.coalesce(F.col("audit"), F.lit("")).alias("audit"), digest)


_ALL: dict[str, Query] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_secret_scan": op4_secret_scan,
    "op5_chat_rotation": op5_chat_rotation,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_warc_shards": op9_warc_shards,
    "op10_line_dedup": op10_line_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fingerprints": op12_fingerprints,
    "op13_structure_repair": op13_structure_repair,
}
SQL: dict[str, str] = {
    "op1_source_mixing": OP1_SQL,
    "op5_chat_rotation": OP5_SQL,
    "op9_warc_shards": OP9_SQL,
}


def _configured(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__name__ = fn.__name__
    return run


QUERIES: dict[str, Query] = {name: _configured(fn) for name, fn in _ALL.items()}
