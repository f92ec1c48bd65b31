import hashlib
import re

import pytest

from linkhoard.llm import decontamination as D

from .conftest import documents, prose


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(texts, items, size):
    forms = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            forms.setdefault(tuple(w[k : k + size]), set()).add(str(item))
    out = []
    for doc_id, text in texts:
        w, hit, found = words(text), set(), set()
        for form, names in forms.items():
            for k in range(len(w) - len(form) + 1):
                if tuple(w[k : k + len(form)]) == form:
                    hit |= set(range(k, k + len(form)))
                    found |= names
        out.append((doc_id or 0, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("block", [100_000, 7])
def test_report_matches_brute_force(spark, rng, block):
    items = [(i, prose(rng, rng.randint(1, 25))) for i in range(12)] + [(20, None), (21, ""), (22, "..."), (3, "Été 7 ok"), (None, "the of")]
    usable = [x for x in items if x[0] is not None]
    texts = [(i, prose(rng, rng.randint(0, 50))) for i in range(30)]
    texts += [(100 + i, f"{prose(rng, 9)} {items[i][1].upper()}! {items[i + 1][1]} {prose(rng, 4)}") for i in range(9)]
    texts += [(200, None), (201, ""), (202, "Été, 7-OK"), (203, "été 7"), (None, items[2][1]), (5, items[1][1]), (5, items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as terms")
    got = D.report(documents(spark, texts, extra=True), bench, 5, block).collect()
    rows = sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got)
    assert rows == expected(texts, usable, 5)
    assert any(r[5] for r in rows)


def test_runs_do_not_join_across_documents(spark):
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    docs = documents(spark, {1: "x a b", 2: "c d a b c d", 3: "a b c d"}).coalesce(1)
    got = {r["doc_id"]: (r["starts"], r["ends"]) for r in D.exact_matches(docs, bench, 4).collect()}
    assert got == {1: ([], []), 2: ([2], [6]), 3: ([0], [4])}


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    docs = documents(spark, {1: "the blue and red green car", 2: "red one two three green blue", 3: "green blue red", 4: "red red green", 5: None})
    got = {(r["doc_id"], r["item_id"], r["start"], r["end"]) for r in D.proximity(docs, bench, slop=1, size=3).collect()}
    assert got == {(1, "1", 1, 5), (3, "1", 0, 3)}


def test_empty_tables_and_filter(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    docs = documents(spark, [(1, "a b c d"), (2, "a b c"), (None, "a b c d"), (3, None)])
    assert D.report(documents(spark, {}), bench).count() == 0
    assert {r["n_hit"] for r in D.report(docs, none).collect()} == {0}
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 3]


def test_rows_of_one_id_with_other_texts_are_decided_by_their_own(spark):
    bench = spark.createDataFrame([("q", "a b c d")], "item_id string, text string")
    kept = D.drop_contaminated(documents(spark, [(1, "a b c d"), (1, "its own text")], extra=True), bench)
    assert [(r["doc_id"], r["text"]) for r in kept.collect()] == [(1, "its own text")]
