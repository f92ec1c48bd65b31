import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from linkhoard.llm import collocations


def plain(rows, longest=5, least=100, top=2000):
    """Rows by (lang, rank), from the definition."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if a >= f[p[i : i + k]]}
        found = []
        for p in candidates.keys() - covered:
            score, k = min((1000 * f[p] * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out[lang, rank] = (p.decode(), -a, left, right, total[lang], -score)
    return out


def rows_of(df):
    return {(r["lang"], r["rank"]): tuple(r)[2:] for r in df.collect()}


def sentences(rng, count):
    frequent = ["a", "b", "the", "xé", "中", "of", "Q", "z\x1fq"]
    words = frequent + [f"r{k}" for k in range(50)]
    for _ in range(count):
        text = " ".join(rng.choice(frequent if rng.random() < 0.7 else words) + rng.choice(["", "", "", ", ", "\n"]) for _ in range(rng.randint(1, 60)))
        yield rng.choice(["en", "fr", None, "und"]), rng.choice([None, "", text, text])
    yield from [("en", "a a a a a a a b of the a")] * 40


@pytest.mark.parametrize("settings, budget", [({"least": 5}, 40), ({"least": 5}, 1 << 19), ({"least": 3, "longest": 3, "top": 20}, 100)])
def test_collocations_match_brute_force(spark, settings, budget):
    rows = list(sentences(random.Random(1), 150))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, n int").repartition(3)
    assert rows_of(collocations.collocations(df, budget=budget, **settings)) == plain(rows, **settings)


def test_empty_tables_and_texts(spark):
    for rows in ([], [(None, None), ("en", ""), ("en", " ,\t")]):
        assert collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), least=1).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000_000_007
    phrases = spark.createDataFrame([([1, 2], big - 5)], "phrase array<long>, n long")
    counted = spark.createDataFrame([(1, "en", "a", big), (2, "en", "b", big + 1), (3, "en", "c", 7 * big)], "sym long, lang string, word string, n long")
    row = collocations.score(phrases, counted).first()
    assert row["score"] == 1000 * (big - 5) * (9 * big + 1) // (big * (big + 1)) and row["n"] == 9 * big + 1


def test_groups_stay_within_the_budget(spark):
    """Prefixes above the budget are replaced, so that no group holds more suffixes, whatever is frequent."""
    leaves = spark.createDataFrame([(k * 7919 * (1 << 40), 30) for k in range(1000)], "key long, n long")
    bounds = collocations._bounds(leaves, 0, 100)
    keys = np.array([k * 7919 * (1 << 40) for k in range(1000)], dtype=np.uint64)
    held = np.bincount(np.searchsorted(bounds, keys, side="right")) * 30
    assert held.max() <= 100 and held.sum() == 30_000


@pytest.mark.parametrize("distinct, common", [(40, 10), (40, 0), (70_000, 20), (300, 60_000)])
def test_packed_suffixes_come_back(distinct, common):
    rng = np.random.default_rng(1)
    names = np.sort(np.append(rng.integers(1, 1 << 63, distinct).astype(np.uint64), np.uint64(0)))
    often = np.concatenate((rng.permutation(names[1:])[: common // 2], rng.integers(1, 1 << 63, common - common // 2).astype(np.uint64)))
    rows, counts, lengths = rng.integers(0, len(names), (distinct // 4, 5)), rng.integers(1, 1 << 40, distinct // 4), rng.integers(1, 5, distinct // 4)
    numbers = collocations._numbered(names, often)
    blobs = [collocations._packed(names, numbers, len(often), rows[at], counts[at], lengths[at]) for at in (slice(0, 7), slice(7, None))]
    back = collocations._gathered(blobs, often)
    assert (back[0][back[1]] == names[rows]).all() and (back[2] == counts).all() and (back[3] == lengths).all()


def test_driver_collects_no_rows_of_words(spark, monkeypatch):
    """What comes to the driver is packed or of fixed size, and the split prefixes are told apart by their counts, without a join."""
    frame, split, fetched, plans = type(spark.range(1)), collocations._split, [], []

    def collect(self, plain=frame.collect):
        rows = plain(self)
        fetched.append(len(rows))
        return rows

    def planned(*given):
        found = split(*given)
        plans.append((len(found[0]), found[1]._jdf.queryExecution().optimizedPlan().toString()))
        return found

    rows = [("en", " ".join(f"w{a} w{b} w{a}" for a in range(40) for b in range(20)))] * 2
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    monkeypatch.setattr(frame, "collect", collect)
    monkeypatch.setattr(collocations, "_split", planned)
    monkeypatch.setattr(collocations, "_COMMON", 15)
    phrases, _ = collocations.count_phrases(df, longest=3, least=2, budget=60)
    assert phrases.count() > 100
    assert len(plans) == 1 and plans[0][0] > 10 and "Join" not in plans[0][1]
    assert max(fetched, default=0) <= 10


def test_most_frequent_words(spark):
    rng = random.Random(2)
    words = [(rng.getrandbits(63) - (1 << 62), rng.choice([1, 2, 3, 4, 5, 8, 9, 1 << 40])) for _ in range(400)]
    df = spark.createDataFrame(words, "sym long, n long").repartition(5)
    for most in (1, 60, 61, 399, 400, 1000):
        names, rows = collocations._most_frequent(df, most)
        assert rows == 400 and names.view(np.int64).tolist() == [s for s, _ in sorted(words, key=lambda w: (-w[1], w[0]))[:most]]
    names, rows = collocations._most_frequent(df.limit(0), 10)
    assert rows == 0 and len(names) == 0 and names.dtype == np.uint64
