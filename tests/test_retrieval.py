"""Chunking, hashing, search and its evaluation."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.functions import text as tx
from harborline.operators import retrieval as ret
from harborline.operators.nearest import nearest

LEAVE = "Employees may take annual leave after ninety days. Leave requests need manager approval."
SECURITY = "Passwords must be rotated. Report security incidents to the help desk at once."


# Stored vectors of single words: position and sign from the digest's bytes.
STORED = {"one": [(52, 1.0)], "annual": [(335, 1.0)]}


def docs(spark, *pairs):
    return spark.createDataFrame([(t, s, None) for t, s in pairs], "text string, source string, page int")


def test_overlapping_chunks(spark):
    chunks = ret.chunk_documents(docs(spark, ("ash birch cedar oak pine", "trees.txt")), 3, 1).orderBy("chunk_index").collect()
    assert [c.text for c in chunks] == ["ash birch cedar", "cedar oak pine"]
    expected = [hashlib.sha256(f"trees.txt|None|{i}|{c.text}".encode()).hexdigest()[:24] for i, c in enumerate(chunks)]
    assert [c.id for c in chunks] == expected


@pytest.mark.parametrize("size,overlap", [(0, 0), (4, 4), (4, -1)])
def test_bad_chunk_sizes(spark, size, overlap):
    with pytest.raises(ValueError):
        ret.chunk_documents(docs(spark, ("a", "b")), size, overlap)


def test_chunk_counts_equal_a_plain_loop(spark):
    cases = [(n, size, overlap) for n in (0, 1, 3, 4, 5, 7, 8, 20) for size, overlap in ((4, 2), (4, 0), (5, 4), (1, 0))]
    for size, overlap in {(s, o) for _, s, o in cases}:
        texts = [" ".join(f"w{i}" for i in range(n)) for n, s, o in cases if (s, o) == (size, overlap)]
        frame = spark.createDataFrame([(i, t, "s", None) for i, t in enumerate(texts)], "k int, text string, source string, page int")
        got = ret.chunk_documents(frame, size, overlap).orderBy("k", "chunk_index").collect()
        for k, text in enumerate(texts):
            words, expected, start = text.split(), [], 0
            while start < len(words):
                expected.append(" ".join(words[start : start + size]))
                if start + size >= len(words):
                    break
                start += size - overlap
            assert [c.text for c in got if c.k == k] == expected


def test_words_split_like_python(spark):
    text = "a b c　d\te\x0bf\x1cg\x85h  i\n"
    row = spark.createDataFrame([(text,)], "t string").select(tx.words(F.col("t"))).first()
    assert row[0] == text.split()


def packed_by_loop(text, size, overlap, separators=("\n\n", "\n", " ")):
    """Chunks by the rule of the docstring, over offsets: cut, mark the long pieces, pack every run of short ones."""
    if not separators:
        return [text[i : i + size] for i in range(0, max(len(text) - overlap, 1), size - overlap)]
    ends = [m.start() for m in re.finditer(re.escape(separators[0]), text) if m.start()] + [len(text)]
    spans = list(zip([0, *ends], ends))
    chunks, begin, starts = [], None, []
    for a, b in spans:
        if begin is not None and (b - a >= size or b - begin > size):
            chunks.append(text[begin:a])
            room = min(overlap, size - (b - a))
            begin = None if b - a >= size else min([c for c in starts if c >= begin and a - c <= room], default=a)
        if b - a >= size:
            chunks += packed_by_loop(text[a:b], size, overlap, separators[1:])
            starts = []
        else:
            begin = a if begin is None else begin
            starts.append(a)
    return chunks + ([text[begin:]] if begin is not None else [])


def split_chars(spark, texts, size, overlap):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    rows = frame.select("i", tx.chunk_characters(F.col("t"), size, overlap).alias("c")).collect()
    return [r.c for r in sorted(rows)]


@pytest.mark.parametrize("size, overlap", [(500, 80), (20, 5), (7, 6), (5, 0), (2, 1)])
def test_character_chunks_equal_a_loop(spark, size, overlap):
    rng = np.random.default_rng(size)
    alphabet = ["a", "bc", "é😀", " ", " ", "\n", "\n\n", "\t", "word", "x" * 9]
    texts = ["".join(rng.choice(alphabet, n)) for n in rng.integers(0, 80, 120)]
    texts += ["".join(rng.choice(alphabet[:5] + ["word"], 900)), "y" * 1300 + "\n\nend", "", " \n\n ", "\n\n\nab\n\n\n\ncd"]
    got = split_chars(spark, [*texts, None], size, overlap)
    assert got.pop() is None
    for text, chunks in zip(texts, got):
        assert chunks == [c for c in map(str.strip, packed_by_loop(text, size, overlap)) if c]
        assert all(0 < len(c) <= size for c in chunks)
        if not overlap:  # no character but white space is lost, and order is kept
            assert re.sub(r"\s", "", "".join(chunks)) == re.sub(r"\s", "", text)


def test_character_chunks_prefer_paragraphs_and_overlap(spark):
    text = "first paragraph here\n\nsecond one\n\nthird and last paragraph"
    assert split_chars(spark, [text], 35, 12) == [["first paragraph here\n\nsecond one", "third and last paragraph"]]
    assert split_chars(spark, ["aaa bbb ccc ddd eee"], 11, 4) == [["aaa bbb ccc", "ccc ddd", "ddd eee"]]
    assert split_chars(spark, ["x" * 25], 10, 0) == [["x" * 10, "x" * 10, "x" * 5]]
    assert split_chars(spark, ["a b"], 1, 0) == [["a", " ", "b"]]


def test_character_chunks_close_before_a_long_piece(spark):
    long = "a rather long paragraph that has far more than sixty characters in it"
    chunks = ["short para", "a rather long paragraph that has far more than sixty", "characters in it", "end"]
    assert split_chars(spark, [f"short para\n\n{long}\n\nend"], 60, 0) == [chunks]
    assert split_chars(spark, ["abcde\n\nf"], 5, 0) == [["abcde", "f"]]


def test_character_chunks_of_a_very_long_text(spark):
    words = " ".join(f"w{i}" for i in range(60_000))
    (chunks, bare) = split_chars(spark, [words, "z" * 400_000], 500, 80)
    assert all(a.split()[-1] in b.split() for a, b in zip(chunks, chunks[1:]))
    assert list(dict.fromkeys(w for c in chunks for w in c.split())) == words.split()
    assert [len(c) for c in bare[:-1]] == [500] * (len(bare) - 1) and len(bare) == -(-(400_000 - 500) // 420) + 1
    with pytest.raises(ValueError):
        tx.chunk_characters(F.col("t"), 10, 10)


def test_hash_vectors(spark):
    texts = [LEAVE, "leave leave", "leave", "", "!!!", "Señor Ünïcode 123", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for digest in ("blake2b", "md5"):
        rows = {r.i: r.embedding for r in ret.embed(frame, digest=digest).collect()}
        assert rows[3] == rows[4] == [0.0] * 384 and rows[6] is None
        for i in (0, 1, 2, 5):
            assert len(rows[i]) == 384 and np.linalg.norm(rows[i]) == pytest.approx(1)
        # one word is one position; said twice it weighs two against its one pair of neighbours
        (at,) = np.flatnonzero(rows[2])
        assert abs(rows[2][at]) == 1 and rows[1][at] == pytest.approx(rows[2][at] * 2 / np.sqrt(5))
    vectors = ret.embed(spark.createDataFrame([("one",), ("annual",)], "text string"))
    places = {r.text: [(k, v) for k, v in enumerate(r.embedding) if v] for r in vectors.collect()}
    assert places == STORED
    with pytest.raises(ValueError):
        tx.hash_embed(F.col("x"), 4)


def test_hash_embed_query_reads_documents(spark, tmp_path):
    from harborline.plans.registry import all_queries

    rows = [(1, "one"), (2, "annual"), (3, "one annual")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {}
    for r in all_queries()["hash_embed"](spark, str(tmp_path)).collect():
        found.setdefault(r[0], []).append((r[1], float(r[2])))
    assert found[1] == STORED["one"] and found[2] == STORED["annual"]
    both = dict(found[3])  # both words, and the pair of them
    assert len(both) == 3 and {52, 335} < set(both) and sum(v * v for v in both.values()) == pytest.approx(1.0, abs=1e-6)


def test_question_finds_its_document(spark):
    chunks = ret.embed(ret.chunk_documents(docs(spark, (LEAVE, "leave.txt"), (SECURITY, "security.txt"))))
    asked = ret.embed(spark.createDataFrame([(1, "When may employees take annual leave?"), (2, "?!")], "question_id int, text string"))
    hits = ret.search(asked, chunks)
    best = hits.where("question_id = 1 and rank = 1").first()
    assert best.source == "leave.txt"
    answers = {r.question_id: r.answer for r in ret.answer(asked, hits).collect()}
    assert answers[1].startswith(f"{ret.FOUND}[Source: leave.txt; relevance={best.score:.3f}]\n{LEAVE}")
    assert answers[2] == ret.NOT_FOUND
    expected = spark.createDataFrame([(1, "leave"), (2, None)], "question_id int, expected_source string")
    row = ret.hit_rate(expected, hits).first()
    assert (row.questions, row.hits, row.hit_rate) == (2, 2, 1.0)


def test_rerank_drops_weak_candidates(spark):
    chunks = ret.embed(ret.chunk_documents(docs(spark, (LEAVE, "leave.txt"), (SECURITY, "security.txt"))))
    asked = ret.embed(spark.createDataFrame([(1, "annual leave after ninety days")], "question_id int, text string"))
    rows = ret.two_stage(asked, chunks, threshold=0.5).collect()
    assert [(r.source, r.score, r["rank"]) for r in rows] == [("leave.txt", 1.0, 1)]


@pytest.mark.parametrize("metric", ["dot", "l2"])
def test_nearest_equals_brute_force(spark, metric, monkeypatch):
    import harborline.operators.nearest as module

    monkeypatch.setattr(module, "QUERY_BLOCK", 7)
    monkeypatch.setattr(module, "ITEM_BLOCK", 13)
    rng = np.random.default_rng(3)
    q, items = rng.integers(-2, 3, (20, 3)).astype(float), rng.integers(-2, 3, (45, 3)).astype(float)
    frame = lambda m, name: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{name} int, vector array<double>")
    rows = nearest(frame(q, "query_id"), frame(items, "item_id"), 4, metric, other_only=True).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.item_id, r.score))
    for i, v in enumerate(q):
        score = items @ v if metric == "dot" else -((items - v) ** 2).sum(axis=1)
        order = sorted((j for j in range(len(items)) if j != i), key=lambda j: (-score[j], j))[:4]
        assert got[i] == [(j, score[j]) for j in order]


def test_nearest_with_no_queries_and_with_floor(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0])], "item_id int, vector array<double>")
    none = spark.createDataFrame([], "query_id int, vector array<double>")
    assert nearest(none, items, 3).count() == 0
    asked = spark.createDataFrame([(5, [0.0, 1.0])], "query_id int, vector array<double>")
    assert nearest(asked, items, 3, min_score=0.05).count() == 0
    with pytest.raises(ValueError):
        nearest(asked, items, 0)


def test_nearest_skips_null_vectors_and_refuses_ragged_ones(spark):
    asked = spark.createDataFrame([(5, [1.0, 0.0]), (6, None)], "query_id int, vector array<double>")
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.5, 0.5])]
    items = spark.createDataFrame(rows, "item_id int, vector array<double>")
    assert [(r.query_id, r.item_id, r.score) for r in nearest(asked, items, 3).orderBy("rank").collect()] == [(5, 1, 1.0), (5, 3, 0.5)]
    for bad in ([3.0, 0.0, 0.0, 0.0], [None, 1.0]):
        ragged = spark.createDataFrame([*rows, (4, bad)], "item_id int, vector array<double>")
        with pytest.raises(Exception, match="different lengths|null or NaN"):
            nearest(asked, ragged, 3).collect()


def test_rank_metrics(spark):
    questions = spark.createDataFrame([(1, "a"), (2, "b")], "question_id int, topic string")
    sizes = spark.createDataFrame([("a", 2), ("b", 1)], "topic string, wanted long")
    hits = spark.createDataFrame([(1, 1, "x"), (1, 2, "a"), (2, 1, "a")], "question_id int, rank int, topic string")
    row = ret.rank_metrics(questions, sizes, hits, 2).first()
    assert (row.recall, row.precision, row.mrr) == (0.25, 0.25, 0.25)
    more = questions.union(spark.createDataFrame([(3, "none"), (4, "none")], questions.schema))
    row = ret.rank_metrics(more, sizes, hits, 2).first()
    assert (row.recall, row.precision, row.mrr) == (0.25, 0.125, 0.125)


@pytest.mark.parametrize("metric", ["dot", "l2"])
def test_pruned_search_equals_brute_force_and_meets_few_parts(spark, metric, monkeypatch):
    import harborline.operators.nearest as module

    rng = np.random.default_rng(12)
    middles = rng.normal(size=(24, 8)) * 6
    draw = lambda n: middles[rng.integers(0, 24, n)] + rng.normal(size=(n, 8)) * 0.3
    items, q = draw(3_000), draw(150)
    items[100:160] = items[100]  # ties
    q[:20] = rng.normal(size=(20, 8)) * 6
    monkeypatch.setattr(module, "ITEM_BLOCK", 60)
    monkeypatch.setattr(module, "QUERY_BLOCK", 32)
    frame = lambda x, name, at=0: spark.createDataFrame([(k + at, v.tolist()) for k, v in enumerate(x)], f"{name} long, vector array<double>")
    asked, stored = frame(q, "query_id"), frame(items, "item_id")
    for floor, others in ((None, True), (-2.0 if metric == "l2" else 30.0, False)):
        rows = nearest(asked, stored, 5, metric, min_score=floor, other_only=others).collect()
        scores = np.round(q @ items.T, 9) if metric == "dot" else np.round(-((q[:, None] - items[None]) ** 2).sum(axis=2), 9)
        if others:
            scores[np.arange(len(q)), np.arange(len(q))] = -np.inf
        want = []
        for i, row in enumerate(scores):
            best = [j for j in np.lexsort((np.arange(len(row)), -row))[:5] if row[j] > -np.inf and (floor is None or row[j] >= floor)]
            want += [(i, int(j), n + 1) for n, j in enumerate(best)]
        assert sorted((r.query_id, r.item_id, r["rank"]) for r in rows) == sorted(want)
    table, parts = module.parted(stored, 50)
    once = module.visits(asked, parts, 5, metric, False)
    fifth = np.sort(scores, axis=1)[:, -5]
    floors = spark.createDataFrame([(k, float(v)) for k, v in enumerate(fifth)], "query_id long, floor double")
    more = module.visits(asked.join(floors, "query_id"), parts, 5, metric, True)
    assert parts.counts.sum() == 3_000 and (once.count() + more.count()) < 0.5 * len(q) * len(parts.counts)


def test_wide_vectors_meet_in_large_cells(spark, monkeypatch):
    import harborline.operators.nearest as module

    # copies of a vector are as many as the other side has blocks: 100,000 queries were 98 blocks
    assert module._side(100_000, module.WIDE_QUERIES) == 8 and module._side(10, module.WIDE_ITEMS) == 1
    rng = np.random.default_rng(4)
    q, items = rng.normal(size=(60, 40)), rng.normal(size=(300, 40))
    items[200:280] = items[200]  # ties, also beyond one block
    q[:5] = items[200]
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    frame = lambda x, name: spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], f"{name} long, vector array<double>")
    for name, value in (("WIDE_QUERIES", 20), ("WIDE_ITEMS", 70), ("TILE", 500)):
        monkeypatch.setattr(module, name, value)
    monkeypatch.setattr(module, "ITEM_BLOCK", 10)  # many components are not parted by centres, however many items there are
    monkeypatch.setattr(module, "_pruned", None)
    for others in (False, True):
        rows = nearest(frame(q, "query_id"), frame(items, "item_id"), 5, min_score=0.1, other_only=others).collect()
        scores = np.round(q @ items.T, 9)
        if others:
            scores[np.arange(60), np.arange(60)] = -np.inf
        want = []
        for i, row in enumerate(scores):
            want += [(i, int(j), n + 1) for n, j in enumerate(np.lexsort((np.arange(300), -row))[:5]) if row[j] >= 0.1]
        assert sorted((r.query_id, r.item_id, r["rank"]) for r in rows) == sorted(want)


def test_cell_without_queries_of_its_block(spark, monkeypatch):
    import harborline.operators.nearest as module

    monkeypatch.setattr(module, "QUERY_BLOCK", 1)
    asked = spark.createDataFrame([(k, [1.0, 0.0]) for k in range(3)] + [(None, [1.0, 0.0])], "query_id int, vector array<double>")
    items = spark.createDataFrame([("a", [1.0, 0.0])], "item_id string, vector array<double>")
    assert sorted((r.query_id, r.item_id) for r in nearest(asked, items, 2).collect()) == [(0, "a"), (1, "a"), (2, "a")]


@pytest.mark.parametrize("metric", ["dot", "l2"])
def test_tied_items_of_a_cell_do_not_add_up(metric):
    import tracemalloc

    from harborline.operators.nearest import _best

    x, y = np.ones((2_000, 2)), np.ones((8_192, 2))
    tracemalloc.start()
    at_x, at_y, score = _best(x, y, 3, metric, None, None)
    top = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(at_y) == [0, 1, 2] * 2_000 and list(at_x[::3]) == list(range(2_000)) and len(set(score)) == 1
    assert top < 700e6  # all scores and pairs at once took several GB


def test_hashing_takes_few_features_at_a_time(spark, monkeypatch):
    rows = [(k, " ".join(f"w{(k * j) % 50}" for j in range(k % 7)) if k % 5 else None) for k in range(60)]
    frame = spark.createDataFrame(rows, "k int, text string").coalesce(1)
    whole = {r.k: r.embedding for r in ret.embed(frame).collect()}
    monkeypatch.setattr(tx, "FEATURES", 3)
    assert {r.k: r.embedding for r in ret.embed(frame).collect()} == whole
    assert all((whole[k] is None) == (text is None) for k, text in rows)
    assert sum(v != 0 for v in whole[2]) == 3  # two words and their pair


def test_hashing_keeps_no_batch_of_python_strings():
    import tracemalloc

    import pyarrow as pa

    column = {}
    with pytest.MonkeyPatch.context() as patch:  # the function that tasks run, without Spark
        patch.setattr(tx.F, "arrow_udf", lambda kind: lambda f: column.update(f=f) or (lambda c: c))
        tx.hash_embed(None)
    words = pa.array([[f"w{i}_{j}" for j in range(500)] for i in range(2_000)])
    tracemalloc.start()
    made = column["f"](words)
    top = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(made) == 2_000 and top < 60e6  # a million strings at once took more than that


def test_terms_are_counted_in_slices_of_text(spark, monkeypatch):
    monkeypatch.setattr(tx, "SLICE", 100)
    df = spark.createDataFrame([("ab cd " * 10,)] * 30 + [(None,), ("",)], "text string").coalesce(1)
    found = tx.sliced(df, "text")
    assert found.rdd.getNumPartitions() == 18 and found.columns == ["text"]
    assert max(found.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 10
    assert sorted(found.collect(), key=str) == sorted(df.collect(), key=str)
    assert tx.sliced(df.where("text is null"), "text").count() == 1
