import random
import re
from collections import Counter, defaultdict

import pytest

from linkhoard.llm import mixing
from linkhoard.llm.queries import all_queries
from linkhoard.sources import tables

from .conftest import documents


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Deal the total by weight; whoever gets too much stops, and the others share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    stopped, total = set(), sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in stopped]
        level = (total - sum(most * sizes[s] for s in stopped)) / max(1, sum(weight[s] for s in open_))
        over = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in stopped else weight[s] * level for s in order}
        stopped |= over


def test_fit_finds_the_nearest_sum():
    rng = random.Random(4)
    for _ in range(300):
        lengths = rng.sample(range(1, 40), rng.randint(1, 6))
        counts = [rng.randint(1, 4) for _ in lengths]
        budget = rng.random() * sum(n * c for n, c in zip(lengths, counts))
        taken = mixing.fit(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        # The share of every size that is taken first is fixed; the rest is the best of what is left.
        total = sum(n * c for n, c in zip(lengths, counts))
        fixed = [c * int(budget) // total for c in counts]
        sums = {sum(n * f for n, f in zip(lengths, fixed))}
        for n, c, f in zip(lengths, counts, fixed):
            sums = {s + n * k for s in sums for k in range(c - f + 1)}
        assert abs(sum(n * t for n, t in zip(lengths, taken)) - budget) == pytest.approx(min(abs(s - budget) for s in sums))


def test_fit_of_large_budgets():
    rng = random.Random(5)
    lengths = rng.sample(range(1, 20_000), 3000)
    counts = [rng.randint(1, 10**6) for _ in lengths]
    budget = 0.37 * sum(n * c for n, c in zip(lengths, counts))
    assert abs(sum(n * t for n, t in zip(lengths, mixing.fit(lengths, counts, budget))) - budget) <= 0.5
    assert mixing.fit([1000, 10**6], [3, 2], 1_002_000.4) == [2, 1]
    assert mixing.fit([7], [5], 0.0) == [0]


def odd_rows():
    rng = random.Random(6)
    rows = [(k, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 300))), rng.choice(["a", "B", "é", None, "zz", "tiny"] if k % 50 == 0 else ["a", "B", None, "zz"])) for k in range(900)]
    rows += [(None, None, "a"), (1, "", "a"), (5000, "same words here", "hot"), (5001, None, "none")] + [(6000 + k, "same words here", "hot") for k in range(600)] + [(7000, "twice the same", "hot")] * 3
    return [(i, t, "en", s, None) for i, t, s in rows]


@pytest.mark.parametrize("small", [tables.SMALL_ROWS, -1])
def test_mix_meets_its_targets(spark, monkeypatch, small):
    monkeypatch.setattr(tables, "SMALL_ROWS", small)
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1, 1.0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, key string, no int, target double").repartition(7)
    found = mixing.mix(df).collect()
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += size(text)
    want, got = plain_targets(sizes), defaultdict(int)
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in found) == Counter((i, size(t), s) for i, t, _, s, _ in rows)
    for r in found:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["copies"] <= 3
        got[r["source"]] += r["copies"] * r["size"]
    assert all(abs(got[s] - want[s]) <= (2 if s == "hot" else 1) for s in sizes)
    again = mixing.mix(df.repartition(3)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_mixed_documents_repeat_rows(spark):
    df = documents(spark, {k: "w " * (k + 1) for k in range(30)}, extra=True)
    taken = Counter({r["doc_id"]: r["copies"] for r in mixing.mix(df, share=1.7).collect()})
    out = mixing.mixed_documents(df, share=1.7)
    assert out.columns == [*df.columns, "copy"]
    assert Counter(r["doc_id"] for r in out.collect()) == +taken
    assert mixing.mix(documents(spark, {})).count() == 0 == mixing.mixed_documents(documents(spark, {})).count()


def test_query_takes_near_its_targets(spark):
    rows = all_queries()["op13_mixing"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r["taken"] <= 3 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) == pytest.approx(total, rel=0.01)
