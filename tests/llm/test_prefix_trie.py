"""The prefix trie against nested dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from harborline.llm import prefix_trie, queries

TURNS = "conv_id long, turn long, role string, text string"


def in_order(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [r[2:] for r in sorted(g)] for c, g in groups.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = c % 5 if c >= 0 else -(-c % 5)
        out[c] = convs.get(c - rest, [])[:h] + own[h:]
    return out


def expected(convs):
    members, children = defaultdict(list), defaultdict(set)
    for c, said in convs.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
            if d:
                children[tuple(said[: d - 1])].add(tuple(said[:d]))
    total = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below = [total[c] for c in children[node]]
        total[node] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    out = {}
    for node, at in members.items():
        ends = ",".join(str(c) for c in sorted(at) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out[min(at), len(node)] = (parent, len(at), len(children[node]), *total[node], hashlib.sha256(ends.encode()).hexdigest())
    return out


NAMES = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def found(df):
    rows = df.collect()
    made = {(r.conv_id, r.depth): tuple(r[n] for n in NAMES) for r in rows}
    assert len(made) == len(rows)
    return made


def made(spark, rows, **bounds):
    df = spark.createDataFrame(rows, TURNS).withColumns({"depth": F.lit("x"), "place": F.lit(0), "said": F.lit(1), "hi": F.lit(2)})
    turns = prefix_trie.sequences(df.repartition(5))
    got = prefix_trie.trie(turns, turns.select("conv_id").distinct(), **bounds)
    return found(got.nodes.join(prefix_trie.ends_digests(got.ends), ["conv_id", "depth"], "left").fillna(hashlib.sha256(b"").hexdigest(), "ends_sha256"))


def test_query_against_dictionaries(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.QUERIES["op11_prefix_trie"](spark, sf)) == expected(rebuilt(in_order(rows)))


def test_query_with_odd_rows(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "größe", "", None])) for c in range(-12, 40) if c not in (5, -5, 20) for t in range(rnd.randint(1, 12))]
    rows += [(3, 2, "user", "a"), (3, 2, "user", "a"), (4, None, "user", "first"), (None, 1, "user", "no id"), (60, 0, "user", "z" * 300_000)]
    spark.createDataFrame(rows, TURNS).withColumn("lent", F.lit(9)).write.parquet(f"{tmp_path}/conversations.parquet")
    want = expected(rebuilt(in_order(rows)))
    assert found(queries.QUERIES["op11_prefix_trie"](spark, str(tmp_path))) == want
    assert any(key[1] == 0 and v[0] is None for key, v in want.items())


@pytest.mark.parametrize("size, held", [(10, 2), (40, 5), (10_000, 3), (10_000, 1 << 18)])
def test_shards_and_spills_of_any_size(spark, size, held):
    rnd = random.Random(size)
    rows = []
    for c in range(300):
        shared = ["hello"] * rnd.choice([0, 1, 1, 1, 4])
        for t, text in enumerate(shared + [rnd.choice("abc") for _ in range(rnd.randint(0, 5))]):
            rows.append((rnd.choice([1, -1]) * 10**9 + c * 7_919 % 300, t, "user", text))
    assert made(spark, rows, size=size, held=held) == expected(in_order(rows))


def test_hot_conversation_first_turn_and_copies(spark):
    rnd = random.Random(8)
    rows = [(50, t, "user", rnd.choice("ab")) for t in range(700)]
    rows += [(c, t, "user", "same") for c in range(100, 400) for t in range(3)]
    rows += [(c, t, "user", text) for c in range(1_000, 1_300) for t, text in enumerate(["hi", f"own {c % 200}", "end"])]
    # every conversation goes one turn further than the one with the next id
    rows += [(3_000 - k, t, "user", f"step {t}") for k in range(30) for t in range(k + 1)]
    assert made(spark, rows, size=60, held=4) == expected(in_order(rows))


def test_empty_table(spark):
    assert made(spark, []) == {}


def test_messages_spill_in_order():
    rnd, queue, want = random.Random(1), prefix_trie.Messages(held=3), defaultdict(lambda: [0, 0, 0])
    for _ in range(500):
        key = (-rnd.randint(0, 9), rnd.randint(0, 9))
        queue.add(key, 1, 2, 3)
        want[key] = [a + b for a, b in zip(want[key], (1, 2, 3))]
    assert queue.made > 5
    got = []
    while queue.first() is not None:
        got.append(queue.take())
    assert got == sorted(want.items())
