import numpy as np
import pytest

from linkhoard.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA).selectExpr("*", "'x' as vec", "1 as part")


def exact(rows, every, k):
    ids = np.array([i for i, _ in rows])
    v = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    out = {}
    for q in sorted({int(i) for i in ids if i % every == 0}):
        scores = {}
        for at in np.flatnonzero(ids == q):
            for i, s in zip(ids.tolist(), (u * u[at]).sum(axis=1).tolist()):
                if i != q:
                    scores[i] = max(s, scores.get(i, -2))
        out[q] = sorted(((-round(s, 9), i) for i, s in scores.items()))[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((-round(r["score"], 9), r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(1)
    x = ann._unit(np.concatenate([rng.normal(c, 0.3, (64, 8)) for c in np.eye(8)[:4] * 4]))
    graph = ann.neighbour_graph(x, 5)
    part = ann.balanced_parts(x, graph, 4, rng)
    assert np.bincount(part).tolist() == [64] * 4
    assert (part[graph] == part[:, None]).mean() > 0.9


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    rows = [(i, centres[rng.integers(20)] + rng.normal(0, 0.6, 16)) for i in range(6000)]
    settings = ann.Settings(sample_rows=2000, block=500, epochs=15)
    usable = ann.usable(table(spark, rows))
    model = ann.train(usable, settings)
    assert model.parts >= 8 and model.probes < model.parts
    got, want = found(ann.nearest(table(spark, rows), 50, 5, settings)), exact(rows, 50, 5)
    assert got.keys() == want.keys() and all(len(g) == 5 for g in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_ties_repeats_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4)) for i in range(30)]
    rows += [(100 + i, [1, 2, 3, 4]) for i in range(40)] + [(200, [1, 2, 3, 4]), (200, [1, 2, 3, 4]), (7, [2, 4, 6, 8]), (300, [-1, -2, -3, -4])]
    odd = [(50, None), (150, []), (250, [0, 0, 0, 0]), (350, [1, None, 1, 1]), (400, [1, float("nan"), 0, 0]), (450, [float("inf"), 0, 0, 0]), (500, [1, 2, 3]), (None, [1, 2, 3, 4])]
    got = found(ann.nearest(table(spark, rows + odd), 50, 5, ann.Settings(block=8)))
    want = exact(rows, 50, 5)
    assert got == want
    assert [i for _, i in got[200]] == [7, 100, 101, 102, 103]


def test_few_candidates_and_empty_tables(spark):
    got = found(ann.nearest(table(spark, [(0, [1, 0]), (1, [0, 1]), (2, [1, 1])])))
    assert [i for _, i in got[0]] == [2, 1]
    assert ann.nearest(table(spark, [(0, [1, 0])])).count() == 0
    assert ann.nearest(table(spark, [])).count() == 0


@pytest.mark.parametrize("scale", [1e-30, 1e30])
def test_very_small_and_large_numbers(spark, scale):
    rows = [(0, np.array([1, 2, 3]) * scale), (1, np.array([1, 2, 2]) * scale), (2, np.array([3, 1, 1]) * scale)]
    assert [i for _, i in found(ann.nearest(table(spark, rows)))[0]] == [1, 2]
