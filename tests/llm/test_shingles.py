import random

import pytest

import corpus_pipeline
from linkhoard.llm import shingles

from .conftest import documents, prose
from .test_simhash import plain_fingerprint


def plain_set(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def plain_components(texts, linked):
    name = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if name[b] < name[a] and linked(a, b):
                    name[a], changed = name[b], True
    return name


def near_copies(rng):
    """Copies with a few words exchanged, chains of them, copies of other lengths, and texts that share one passage."""
    passage = prose(rng, 40)
    texts = {}
    for group in range(8):
        base = prose(rng, rng.choice((6, 30, 120, 300))).split()
        for _ in range(9):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 60))):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            base = words if rng.random() < 0.4 else base
            texts[len(texts)] = " ".join(words[: rng.choice((len(words), len(words) - len(words) // 8))])
    texts |= {1000 + k: f"{prose(rng, 60)} {passage} {prose(rng, rng.randint(1, 60))}" for k in range(20)}
    texts |= {2000: None, 2001: "", 2002: "one", 2003: "One", 2004: "a b c d", 2005: "a b c d e"}
    return texts


@pytest.mark.parametrize("sample", [1, 10**9])
def test_components_are_those_of_brute_force(spark, monkeypatch, sample):
    monkeypatch.setattr(shingles, "SAMPLE", sample)
    texts = near_copies(random.Random(11))
    sets = {i: plain_set(t) for i, t in texts.items()}
    want = plain_components(texts, lambda a, b: bool(sets[a]) and len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4)
    found = {r["doc_id"]: r["component_id"] for r in shingles.near_copies(documents(spark, texts, extra=True)).collect()}
    assert found == {i: want[i] for i in texts if sets[i]}
    assert len(set(want.values())) < len(texts) - 40


def test_pipeline_drops_near_copies_that_simhash_keeps(spark):
    rng = random.Random(12)
    base = [f"word{rng.randrange(10**4)}" for _ in range(200)]
    texts = {1: " ".join(base), 2: " ".join([*base[:50], "new", *base[51:120], "more", *base[121:]]), 3: prose(rng, 200)}
    prints = {i: plain_fingerprint(t, 5) for i, t in texts.items()}
    assert (prints[1] ^ prints[2]).bit_count() > 2 and len(plain_set(texts[1]) & plain_set(texts[2])) >= 0.8 * len(plain_set(texts[1]) | plain_set(texts[2]))
    docs = documents(spark, texts)
    for name, stage in corpus_pipeline.STAGES:
        if name.endswith("near-dedup"):
            docs = stage(spark, docs, "")
    assert sorted(r["doc_id"] for r in docs.collect()) == [1, 3]


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (3, "A b c d e f"), (3, "its own text"), (2, "x y z"), (4, None), (5, "")]
    kept = shingles.drop_near_copies(documents(spark, rows))
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, rows[2][1]), (1, rows[0][1]), (1, rows[1][1]), (2, "x y z"), (3, "its own text"), (4, ""), (5, "")]
    assert shingles.drop_near_copies(documents(spark, {})).count() == 0
