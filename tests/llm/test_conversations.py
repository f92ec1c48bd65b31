import hashlib
import random
import re
import zlib

import pytest
import xxhash

from linkhoard.llm import conversations

ROWS = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def text_hash(text):
    value = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return value - (1 << 64) if value >> 63 else value


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out.setdefault(conv, []).extend([(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1))
    return out


def cheapest(rows, faults):
    """Cost, audit and repaired rows, by trying all edits forward from state to state."""

    def better(states, state, value):
        if state not in states or value[:2] < states[state][:2]:
            states[state] = value

    def inserted(states):
        for _ in range(2):
            for state, (cost, audit, left) in list(states.items()):
                after = 3 if state == 2 else 2
                better(states, after, (cost + 3, audit + "I", left + ((("user:", "assistant:")[after == 3]),)))
        return states

    states = inserted({0: (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        following = {}
        for state, (cost, audit, left) in states.items():
            better(following, state, (cost + 4, audit + "D", left))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, role[:1]))
            if kept:
                better(following, kept, (cost + more, audit + "K", left + (f"{role}:{text}",)))
            after = 3 if state == 2 else 2
            better(following, after, (cost + more + 3, audit + "R", left + (f"{('user', 'assistant')[after == 3]}:{text}",)))
        states = inserted(following)
    cost, audit, left = min(value for state, value in states.items() if state in (0, 3))
    return cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()


def plain(rows):
    out = {}
    for conv, kept in damaged(rows).items():
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), text_hash(x[2])))
        faults, seen = [], set()
        for _, role, text in kept:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {t for t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, *cheapest(kept, faults))
    return out


def repaired(df, block=conversations.BLOCK):
    rows = conversations.repair(conversations.damage(df), block).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r)[1:] for r in rows}


def test_query_table_matches_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert repaired(df) == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("block", [7, 4096])
def test_odd_and_long_conversations_match_brute_force(spark, block):
    rng = random.Random(3)
    texts = ["a.", "b", "c!", " ", "", "d?  ", "e \n", None, "é.", "x", "\x1f", ".", "word " * 3000] + [f"t{k}." for k in range(30)]
    roles = ["user", "assistant", "system", "tool", None, "", "u", "User"]
    rows = [(c, rng.choice([None, *range(20)]), rng.choice(roles), rng.choice(texts)) for c in [*range(25), None] for _ in range(rng.randint(1, 30))]
    rows += [(999, k // 3, rng.choice(["user", "assistant"]), f"{rng.randint(0, 400)}" + rng.choice(".,")) for k in range(900)]
    rows += [(1000, 5, "user", "same.")] * 300 + [(1001, None, "system", "s."), (1001, None, "user", "u.")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{ROWS}, conv string, t int").repartition(5)
    assert repaired(df, block) == plain(rows)


def test_conversations_without_rows_and_empty_tables(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert repaired(spark.createDataFrame([(gone, 0, "user", "Hello.")], ROWS)) == {gone: (0, 0, 0, 0, 0, 0, "", EMPTY)}
    assert repaired(spark.createDataFrame([], ROWS)) == {}


def test_pieces_chain_to_the_cost_of_the_whole():
    import numpy as np

    rng = np.random.default_rng(2)
    codes = rng.integers(0, 4, 60) + rng.choice([0, 4, 8, 16], 60)
    (whole,), _ = conversations.solve([codes])
    after = conversations._inserted(conversations._ACCEPT[None])[0]
    for at in (40, 20, 0):
        after = (conversations.matrix(codes[at : at + 20]) + after).min(axis=1)
    assert after[0] == whole
