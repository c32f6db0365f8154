"""Mixing, embeddings, chat and WARC: against SQL, brute force or a round trip, with odd rows."""

import gzip
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.llm import chat, embedding_dedup, mixing, queries, warc
from harborline.session import scratch_path


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, duck, sf, name):
    from oracle import compare

    assert compare(queries.QUERIES[name](spark, sf), duck, queries.SQL[name]) is None


# mixing

MIX = "doc_id long, source string, text string"


def mix_rows():
    rnd = random.Random(1)
    rows = [(k, "big", "w " * rnd.randint(1, 40)) for k in range(200)] + [(k, "small", "w " * rnd.randint(1, 40)) for k in range(200, 230)]
    return rows + [(300, None, "a b c"), (None, "big", "x y"), (301, "small", None), (302, "bare", ""), (303, "bare", None), (304, "small", "p q"), (304, "small", "p q")]


def test_mixture_keeps_every_document_and_its_limits(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, MIX).withColumns({"epoch": F.lit(9), "n": F.lit("x"), "_whole": F.lit(0)})
    found = mixing.schedule(df, max_repeats=3.0, block_tokens=500).collect()
    uses, tokens = Counter((r.doc_id, r.source) for r in found), defaultdict(int)
    assert set(uses) == {(i, s) for i, s, _ in rows}
    for r in found:
        tokens[r.source] += r.n_tokens
    assert max(uses.values()) <= 6 and max(v for k, v in uses.items() if k[0] != 304) <= 3
    weights = {r.source: r.weight for r in found}
    total = sum(tokens.values())
    for source in ("big", "small"):
        assert abs(tokens[source] / total - weights[source]) < 0.02
    blocks = defaultdict(lambda: defaultdict(int))
    for r in found:
        blocks[r.block][r.source] += r.n_tokens
    shares = [b["big"] / sum(b.values()) for b in blocks.values()]
    assert len(blocks) > 4 and max(shares) - min(shares) < 0.2
    mixed = mixing.mix(df, max_repeats=3.0)
    assert mixed.columns == df.columns
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == uses


def test_mixture_reaches_the_target_entropy(spark):
    rows = mixing._counted(spark.createDataFrame(mix_rows(), MIX), "doc_id", "source", "text")
    made = mixing.fit(rows, target_entropy=0.9)
    w = [r.w for r in made.sources.collect() if r.w > 0]
    entropy = -sum(x * math.log(x) for x in w)
    assert abs(sum(w) - 1) < 1e-9 and 0.9 * math.log(len(w)) <= entropy < 0.9001 * math.log(len(w))
    assert 0 < made.alpha < 1


def test_mixture_of_nothing(spark):
    empty = spark.createDataFrame([], MIX)
    assert mixing.schedule(empty, max_repeats=2.0).count() == 0 and mixing.mix(empty, target_entropy=0.5).count() == 0
    with pytest.raises(ValueError):
        mixing.schedule(empty)


def test_search_finds_the_first_number():
    for high in (0, 1, 5, 32, 33, 1_000, 1_000_000):
        for want in {0, 1, high // 3, high - 1, high} & set(range(high + 1)):
            assert mixing._search(0, high, lambda ks: [k >= want for k in ks]) == want


# embeddings

VEC = "vec_id long, embedding array<float>, label int"


def test_embedding_links_and_components(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "WINDOW", 6)
    rng = np.random.default_rng(3)
    rows = []
    for f in range(30):
        centre = rng.standard_normal(24)
        for k in range(40 if f == 0 else int(rng.integers(1, 5))):
            rows.append((len(rows), (centre + 0.03 * rng.standard_normal(24)).astype("float32").tolist(), f % 2))
    rows += [(1000 + k, rows[5][1], rows[5][2]) for k in range(6)] + [(2000, rows[5][1], 1 - rows[5][2]), (2000, rows[5][1], None)]
    odd = [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 24, 0), (3003, [float("nan")] + [1.0] * 23, 0), (3004, [float("inf")] * 24, 0), (3005, [None] + [1.0] * 23, 0), (3006, [1.0, 2.0], 0), (3007, [2.0, 4.0], 0)]
    df = spark.createDataFrame(rows + odd, VEC).withColumns({"node": F.lit(1), "v": F.lit(2), "size": F.lit(3)}).repartition(5)
    found = [r for r in embedding_dedup.near_duplicates(df).collect()]
    x = np.array([r[1] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([-1 - k if r[2] is None else r[2] for k, r in enumerate(rows)])
    near = (x @ x.T >= 0.98) & (labels[:, None] == labels[None, :])
    reach = np.linalg.matrix_power(near.astype(float), 8) > 0
    want = Counter((rows[k][0], int(near[k].sum()) - 1, min(rows[j][0] for j in np.flatnonzero(reach[k]))) for k in range(len(rows)))
    want += Counter((i, 0, i) for i, *_ in odd[:6]) + Counter([(3006, 1, 3006), (3007, 1, 3006)])
    # a vector without a label reaches only itself
    want = Counter({(i, 0 if n < 0 else n, c): k for (i, n, c), k in want.items()})
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in found) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_embedding_dedup_of_nothing_and_null_ids(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VEC)).count() == 0
    rows = [(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)]
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VEC)).collect())
    assert got == Counter({(None, 1, 4, False): 1, (4, 1, 4, True): 1, (None, 0, None, False): 1})


def test_embedding_recall_on_planted_links(spark, sf):
    """The given tables hold hardly a link, so near copies of their vectors are planted; every fiftieth row is looked up."""
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    rnd = np.random.default_rng(9)
    x = np.array([r.embedding for r in rows], dtype=float)
    near = x + rnd.normal(size=x.shape) * np.linalg.norm(x, axis=1, keepdims=True) * rnd.uniform(0, 0.04, (len(x), 1))
    x, labels = np.vstack([x, near]).astype(np.float32), [r.label for r in rows] * 2
    df = spark.createDataFrame([(k, v.tolist(), label) for k, (v, label) in enumerate(zip(x, labels))], VEC)
    found = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    asked = np.arange(0, len(x), 50 if len(x) > 5_000 else 5)
    true = {int(k): int(sum(unit[k] @ unit[j] >= 0.98 and labels[k] == labels[j] for j in range(len(x)) if j != k)) for k in asked}
    assert sum(true.values()) > 10
    assert all(found[k] <= n for k, n in true.items()) and sum(found[k] for k in true) >= 0.99 * sum(true.values())


def test_long_dialogues_without_turn_numbers_come_in_bounded_rows(spark):
    rnd = random.Random(4)
    rows = [(c, t, rnd.choice(["ann", "bob", "system", None]), f"{rnd.random()}") for c, t in [(1, None)] * 3_000 + [(2, 7)] * 3_000]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = chat.dialogues(df, row_turns=250).collect()
    assert len(found) == 2 * 12 * 2 and {r.n_turns for r in found} == {250}
    for conv in (1, 2):
        said = sorted(((r[2] or "", r[2] is not None, r[3]) for r in rows if r[0] == conv), key=lambda x: (x[1], x[0], x[2]))
        for speaker in ("ann", "bob"):
            mine = sorted((r for r in found if r.conv_id == conv and r.speaker == speaker), key=lambda r: r.segment)
            text = "".join(r.rendered for r in mine)
            assert [r.offset for r in mine] == [sum(len(p.rendered) for p in mine[:k]) for k in range(12)]
            assert [r.turns_before for r in mine] == [250 * k for k in range(12)]
            spans = [text[r.offset + m.start : r.offset + m.end] for r in mine for m in r["mask"]]
            assert spans == [f"{t}{chat.END}" for name, known, t in said if name == speaker]


def counted_by_hand(x, threshold=0.98):
    x = np.asarray(x, dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    component = np.arange(len(x))
    while True:
        least = np.minimum(component, np.where(near, component[None, :], len(x)).min(axis=1))
        if (least == component).all():
            return near.sum(axis=1), component
        component = least


@pytest.mark.parametrize("kind", ["dense", "pairs"])
def test_embedding_links_are_whole_in_large_dense_labels(spark, kind):
    rng = np.random.default_rng(5)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    centre = unit(rng.standard_normal((1, 64)))
    noise = unit(rng.standard_normal((4_000, 64)))
    if kind == "dense":  # all about 0.965 to each other, some above 0.98
        x = unit(centre + noise * math.sqrt(1 / 0.965 - 1))
    else:  # about 0.9 to each other, and planted pairs at 0.981
        x = unit(centre + noise * math.sqrt(1 / 0.9 - 1))
        side = rng.standard_normal((100, 64))
        side = unit(side - (side * x[:100]).sum(axis=1, keepdims=True) * x[:100])
        x = np.concatenate([x, 0.981 * x[:100] + math.sqrt(1 - 0.981**2) * side])
    links, component = counted_by_hand(x)
    assert links.sum() >= 200
    df = spark.createDataFrame([(k, v, 1) for k, v in enumerate(x.astype("float32").tolist())], VEC)
    found = embedding_dedup.near_duplicates(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == {k: (n, c) for k, (n, c) in enumerate(zip(links.tolist(), component.tolist()))}


def test_exact_search_and_passes_find_the_same(spark, monkeypatch):
    """Windows far smaller than the labels, over many partitions, against the exact search of whole labels."""
    monkeypatch.setattr(embedding_dedup, "NEXT", 40)
    monkeypatch.setattr(embedding_dedup, "SORTED_ROWS", 400)
    rng = np.random.default_rng(12)
    x = rng.standard_normal((900, 32))
    x = np.concatenate([x, x[:120] + 0.1 * rng.standard_normal((120, 32)), x[:1] + 0.1 * rng.standard_normal((180, 32))])
    rows = [(k, v, None if k % 97 == 0 else k % 2 if k < 900 else int(rng.integers(2))) for k, v in enumerate(x.astype("float32").tolist())]
    df = spark.createDataFrame(rows, VEC)
    whole = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df, exact=True).collect()}
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
    links = sum(n for n, _ in whole.values())
    assert links > 200 and sum(n for n, _ in found.values()) >= 0.99 * links
    assert all(found[k][0] <= n for k, (n, _) in whole.items())


# chat


def test_rotations_put_each_speaker_first(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "<|end|>"), (1, 3, "ann", None), (1, 2, None, "who"), (2, 0, "system", "x"), (3, None, "ann", "late"), (None, 0, "bob", "n"), (1, 70, "bob", "far")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"turns": F.lit(1), "speaker": F.lit(2), "said": F.lit(3)})
    found = {(r.conv_id, r.segment, r.speaker): r for r in chat.rotations(df).collect()}
    assert set(found) == {(1, 0, "ann"), (1, 0, "bob"), (1, 1, "bob"), (3, None, "ann"), (None, 0, "bob")}
    ann = found[1, 0, "ann"]
    assert ann.rendered == "<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|user|>\nwho<|end|>\n<|user name=bob|>\n< |end|><|end|>\n<|assistant|>\n<|end|>\n"
    assert [ann.rendered[m.start : m.end] for m in ann.mask] == ["hi<|end|>\n", "<|end|>\n"]
    bob = found[1, 0, "bob"]
    assert [bob.rendered[m.start : m.end] for m in bob.mask] == ["< |end|><|end|>\n"]
    assert chat.rotations(df.limit(0)).count() == 0


def rotated_by_hand(rows):
    """(conversation, speaker): whole rendering and what the speaker says."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == conv), key=lambda t: [(x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in t])
        for speaker in {t[1] for t in turns} - {None, "system"}:
            whole, said = "", []
            for _, role, text in turns:
                head = "<|user|>" if role is None else "<|system|>" if role == "system" else "<|assistant|>" if role == speaker else f"<|user name={role}|>"
                body = (text or "").replace("<|", "< |") + "<|end|>\n"
                said += [body] if role == speaker else []
                whole += f"{head}\n{body}"
            out[conv, speaker] = whole, said
    return out


@pytest.mark.parametrize("row_turns", [70, 1024])
def test_dialogues_are_whole_for_every_participant(spark, row_turns):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 1, "", "x")] + [(1, k, "bob" if k % 3 else None, f"<|é{k}") for k in range(2, 300)]
    rows += [(1, None, "cy", "first"), (2, 0, "system", "x"), (3, None, "ann", "late"), (None, 0, "bob", "n"), (None, 500, "ann", "m"), (4, 70, "bob", "far")]
    rows += [(None, k, "bob", "b") for k in range(64, 200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"part": F.lit(1), "offset": F.lit(2)}).repartition(4)
    found = chat.dialogues(df, row_turns=row_turns).collect()
    want = rotated_by_hand(rows)
    for key, (whole, said) in want.items():
        parts = sorted((r for r in found if (r.conv_id, r.speaker) == key), key=lambda r: r.segment)
        assert [r.segment for r in parts] == list(range(len(parts)))
        assert (len(parts) > 1) == (row_turns == 70 and key[0] in (1, None))
        assert "".join(r.rendered for r in parts) == whole
        assert [whole[r.offset + m.start : r.offset + m.end] for r in parts for m in r.mask] == said
        assert all(r.turns_before == sum(p.n_turns for p in parts[: r.segment]) for r in parts)
    assert {(r.conv_id, r.speaker) for r in found} == set(want)


def test_chat_query_gives_one_whole_row_for_turns_over_63(spark, tmp_path):
    rows = [(1, k, "system" if k == 0 else "ann" if k == 1 else "bob", f"t{k}") for k in range(100)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.speaker: r for r in queries.QUERIES["op5_chat_rotation"](spark, str(tmp_path)).collect()}
    want = rotated_by_hand(rows)
    assert {k: (r.segment, r.n_turns, r.rendered) for k, r in found.items()} == {k: (0, 100, want[1, k][0]) for k in ("ann", "bob")}


# WARC

PAGE = "page_id long, url string, html string"


def page_rows():
    rnd = random.Random(2)
    long = "<p>é " + "x" * 1200
    rows = [(k, f"http://h{k % 3}/{k}", "".join(rnd.choice("abc <>é\r\n") for _ in range(rnd.randint(0, 2500)))) for k in range(80)]
    rows += [(k, f"http://c/{k}", long) for k in (100, 103, 101)] + [(200, None, "short"), (201, "u", "short"), (202, "u\r\nX: y", None), (None, "n", long), (None, "m", "z" * 1500), (103, "again", long)]
    return rows


def pages_by_hand(rows):
    best = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 1000 and i is not None:
            best[raw] = max(best.get(raw, i), i)
    out = Counter()
    for i, _, html in rows:
        raw = (html or "").encode()
        keep = best.get(raw)
        revisit = keep is not None and keep != i
        out[i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", keep if revisit else None] += 1
    return out


def test_warc_round_trip_and_determinism(spark):
    rows = page_rows()
    sums = []
    for parts in (1, 5):
        folder = scratch_path(spark, "warc-test")
        df = spark.createDataFrame(rows, PAGE).withColumns({"digest": F.lit(1), "keep": F.lit(2), "shard": F.lit(3)}).repartition(parts)
        manifest = warc.write(df, folder, shard_bytes=20_000, roll_bytes=6_000).orderBy("name").collect()
        sums.append([(r.name, r.bytes, r.records, r.sha256) for r in manifest])
        found = warc.read(spark, folder).collect()
        got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found)
        assert got == pages_by_hand(rows)
        for r in found:
            if r.record_type == "response":
                assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest
    assert sums[0] == sums[1] and len(sums[0]) > 5 and sum(r[2] for r in sums[0]) == len(rows)


def test_warc_files_are_plain_gzip_members_and_nothing_temporary_stays(spark):
    import os

    folder = scratch_path(spark, "warc-test")
    warc.write(spark.createDataFrame(page_rows(), PAGE), folder)
    root = folder.removeprefix("file://")
    names = [n for n in os.listdir(root) if n != "manifest"]
    assert names and all(n.endswith(".warc.gz") for n in names)
    with gzip.open(f"{root}/{names[0]}") as file:
        assert file.read(8) == b"WARC/1.1"


def test_warc_of_nothing(spark):
    folder = scratch_path(spark, "warc-test")
    assert warc.write(spark.createDataFrame([], PAGE), folder).count() == 0
    assert warc.read(spark, folder).count() == 0
