"""Conversation repair against a search over whole edit strings."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from harborline.llm import queries, repair
from harborline.llm.ordered import numbered

TURNS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(turns):
    """(cost, audit, repaired lines) over all edit strings: minimum of cost, then of the audit."""

    @lru_cache(None)
    def best(k, state, inserts):
        grammar = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        options = [(0, "", ())] if k == len(turns) and state in ("", "a") else []
        follow = lambda cost, letter, line, nxt: (cost + nxt[0], letter + nxt[1], line + nxt[2])
        if inserts < 3:
            for c in grammar.replace("s", ""):
                options.append(follow(2, "I", ({"u": "user", "a": "assistant"}[c] + ":",), best(k, c, inserts + 1)))
        if k < len(turns):
            role, text, fault = turns[k]
            options.append(follow(3, "D", (), best(k + 1, state, 0)))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                if role and role[0] in grammar:
                    options.append(follow(more, "K", (f"{role}:{text}",), best(k + 1, role[0], 0)))
                for c in grammar.replace("s", ""):
                    options.append(follow(2 + more, "R", ({"u": "user", "a": "assistant"}[c] + ":" + text,), best(k + 1, c, 0)))
        return min(options, default=(10**9, "", ()))

    return best(0, "", 0)


def expected(rows, every):
    groups = {c: [] for c in every}
    for r in rows:
        groups[r[0]].append(r[1:])
    out = {}
    for conv, said in groups.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", r[2] or ""))
        seen, turns = set(), []
        for turn, role, text in said:
            kept = (text or "").strip(SPACE)
            fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None
            seen.add((role, text))
            turns.append((role or "", text or "", fault))
        count = lambda f: sum(t[2] == f for t in turns)
        pairs = [(a[0][:1] + b[0][:1]) for a, b in zip(turns, turns[1:])]
        numbers = [t[0] for t in said if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit, lines = cheapest(tuple(turns))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, count("blank"), count("duplicate"), count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(df):
    rows = df.collect()
    made = {r.conv_id: tuple(r[n] for n in NAMES) for r in rows}
    assert len(made) == len(rows)
    return made


def test_query_against_search(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.QUERIES["op13_structure_repair"](spark, sf)) == expected(damaged(rows), {r[0] for r in rows})


def planted(n, seed, longest=14):
    rnd, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rnd.randint(1, longest)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rnd.choice(["Hi.", "What? ", "cut off", "", " \n", None, f"said {rnd.random()}!", "same", "日本語。"])
            rows.append((conv, rnd.choice([turn, turn, turn + 3, None]), role, text))
    return rows


@pytest.mark.parametrize("chunk", [1, 3, 5, 256])
def test_strings_of_any_length_give_the_same_repair(spark, chunk):
    rows = planted(150, chunk)
    rows += [(None, 1, "user", "no id."), (None, 1, "user", "no id."), (None, None, "assistant", "ok.")]
    df = spark.createDataFrame(rows, TURNS).withColumns({"key": F.lit(1), "place": F.lit("x"), "chunk": F.lit(0), "_part": F.lit(2)})
    made = repair.repair(df.repartition(5), chunk=chunk)
    assert found(repair.summary(made)) == expected(rows, {r[0] for r in rows})
    assert made.columns == ["conv_id", "place", "step", "edit", "role", "text", "turn", "was", "fault", "cost"]


def test_one_conversation_over_many_ranges(spark):
    rnd = random.Random(5)
    rows = [(7, k // 2, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b", f"{k}?", ""])) for k in range(1_500)] + [(8, 0, "user", "x" * 200_000 + "."), (9, 2**63 - 1, "user", "a."), (9, -(2**63), "assistant", "b.")]
    df = spark.createDataFrame(rows, TURNS).repartition(6)
    cells = repair.repair(df, chunk=64)
    made = found(repair.summary(cells))
    want = _by_table(rows)
    for conv in (7, 8):
        assert made[conv][5:7] == want[conv]
    assert made[9][0] == 2**63 - 1
    kept = cells.where("conv_id = 7 and edit <> 'Delete'").orderBy("place", "step").collect()
    assert "".join(r.role[0] for r in kept).lstrip("s").replace("ua", "") == ""


def _by_table(rows):
    """Cost and audit by a table over positions, which holds for conversations too long to recurse over."""
    out = {}
    for conv in (7, 8):
        said = sorted(((r[1], r[2], r[3]) for r in rows if r[0] == conv))
        seen, turns = set(), []
        for _, role, text in said:
            turns.append((role[0], 2 if not text or (role, text) in seen else int(text[-1] not in ".!?")))
            seen.add((role, text))
        after = {"": (0, ""), "s": (4, "II"), "u": (2, "I"), "a": (0, "")}
        for initial, fault in reversed(turns):
            now = {}
            for state, grammar in (("", "su"), ("s", "u"), ("u", "a"), ("a", "u")):
                options = [(3 + after[state][0], "D" + after[state][1])]
                if fault < 2:
                    options += [(fault + after[initial][0], "K" + after[initial][1])] if initial in grammar else []
                    options.append((2 + fault + after[grammar[-1]][0], "R" + after[grammar[-1]][1]))
                now[state] = min(options)
            for _ in range(3):
                now = {q: min(now[q], (2 + now[g][0], "I" + now[g][1])) for q, g in (("", "u"), ("s", "u"), ("u", "a"), ("a", "u"))}
            after = now
        out[conv] = after[""]
    return out


def test_empty_tables_and_places(spark):
    none = spark.createDataFrame([], TURNS)
    assert repair.repair(none).collect() == [] and repair.summary(repair.repair(none)).collect() == []
    rows = [("a", 1, k % 7) for k in range(3_000)] + [("b", 1, 2**32 - 1)] * 3 + [("c", 1, 5)]
    df = spark.createDataFrame(rows, "k string, o long, x long").repartition(9)
    made = numbered(df, "k", ["o", "x"], ["x"]).collect()
    assert sorted(r.place for r in made if r.k == "a") == list(range(1, 3_001))
    by_place = {(r.k, r.place): r.x for r in made}
    total = 0
    for place, x in enumerate(sorted(k % 7 for k in range(3_000)), 1):
        total += x
        assert by_place["a", place] == total
    assert [by_place["b", k] for k in (1, 2, 3)] == [2**32 - 1, 2**32 - 2, 2**32 - 3] and by_place["c", 1] == 5
