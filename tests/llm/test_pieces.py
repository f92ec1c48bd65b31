import itertools

import numpy as np
import pandas as pd
import pytest
import sentencepiece
from pyspark.sql import functions as F

from linkhoard.llm import base, pieces, quality
from linkhoard.llm.base import tokenizer_file

from .conftest import documents, prose

PATH = tokenizer_file("piece_bpe_32k.model")
TEXTS = [
    "a  b", " lead", "trail ", "x\ny", "\n\n", "", "é́ ﬁ  ", "a\tb", "▁x", "   ", "a    b     c\n  d", "日本語 テキスト 🙂🙂", " a b",
    "Hello world's    12345 !!! ....", " " * 37 + "x", "\r\n;\r\n}\r", "İıſ", "antidisestablishmentarianism", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "=" * 100,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_texts_are_those_of_the_library(library, rng):
    model = pieces.Model.load(PATH)
    texts = TEXTS + [prose(rng, 80) for _ in range(30)] + ["".join(rng.choice("abcdefghi ▁\n.é") for _ in range(60)) for _ in range(200)]
    for text, packed in zip(texts, model.encode([library.normalize(t) if t else "" for t in texts])):
        ids = np.frombuffer(packed, "<i4").tolist()
        assert ids == library.encode(text), text
        assert model.decode(ids) == library.decode(ids), text


def test_a_neighbour_follows_exactly_if_merging_leaves_the_border(rng):
    model = pieces.Model.load(PATH)
    some = rng.sample(sorted(p for p in model.ids if len(p) < 6), 120)
    for first, second in itertools.product(some[:60], some[60:]):
        if pieces.MARK * 2 not in first + second:
            assert model.follows(first, second) == ([p for p, _ in model.merge(first + second)] == [first, second])


def test_unigram_models_take_the_best_sum_of_scores(rng):
    vocabulary = {p: -rng.random() * 4 for p in ("a", "b", "c", "ab", "bc", "abc", "ca", "cab", "aa", "bb")}
    model = pieces.Model([("<unk>", 0.0, 2), *((p, s, 1) for p, s in vocabulary.items())])

    def best(word):
        if not word:
            return 0.0
        heads = [(vocabulary[word[:k]], k) for k in range(1, len(word) + 1) if word[:k] in vocabulary] + [(model.unknown_score, 1)]
        return max(score + best(word[k:]) for score, k in heads)

    words = {"".join(rng.choice("abcx") for _ in range(rng.randint(1, 9))) for _ in range(150)}
    for word, found in model.segment(words):
        assert "".join(found) == word
        assert sum(vocabulary.get(p, model.unknown_score) for p in found) == pytest.approx(best(word))


def test_tables_round_trip(spark, library):
    texts = dict(enumerate(TEXTS)) | {100: None, 101: "word " * 30_000}
    docs = documents(spark, texts, extra=True)
    encoded = pieces.encode(docs, PATH)
    assert encoded.columns == [*(c for c in docs.columns if c != "ids"), "ids"]
    rows = {r["doc_id"]: r for r in pieces.decode(encoded, PATH, text="decoded").collect()}
    for i, text in texts.items():
        assert rows[i]["ids"] == library.encode(text or "")
        assert rows[i]["decoded"] == library.decode(rows[i]["ids"])
    together = {r["doc_id"]: (r["ids"], r["text"]) for r in pieces.encode(docs, PATH, decoded=True).collect()}
    assert together == {i: (r["ids"], r["decoded"]) for i, r in rows.items()}
    report = {r["doc_id"]: r for r in pieces.round_trip(docs, PATH).collect()}
    assert all(report[i]["n_tokens"] == len(rows[i]["ids"]) and report[i]["same"] == (rows[i]["decoded"] == (t or "")) for i, t in texts.items())
    assert report[100]["n_tokens"] == 0 and report[101]["same"]


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "one two"), (1, "one two"), (None, "x")]
    got = [(r["doc_id"], r["same"]) for r in pieces.round_trip(documents(spark, rows), PATH).collect()]
    assert sorted(got, key=str) == [(1, True), (1, True), (None, True)]
    assert pieces.encode(documents(spark, {}), PATH).count() == 0
    nulls = documents(spark, {1: "a"}).withColumn("ids", F.lit(None).cast("array<int>"))
    assert pieces.decode(nulls, PATH).first()["text"] == ""


def test_words_are_worked_out_without_the_signs_at_their_end(library):
    model, normalise = pieces._loaded(PATH)
    texts = ["sealword sealword, sealword. sealword!!! (sealword) 'sealword' sealword's", "c# c#, x.y.z... ===, ,,,a #", "…, a…… naïve-, 12,345.67."]
    ids = [np.frombuffer(p, dtype="<i4").tolist() for p in model.encode(list(map(normalise, texts)))]
    assert ids == [library.encode(t) for t in texts]
    assert {w for w in model.known.recent if w.startswith("▁sealword")} == {"▁sealword", "▁sealword's"}


def test_workers_keep_the_model_of_one_operator_only():
    model = pieces._loaded(PATH)
    assert pieces._loaded(PATH) is model
    base.kept("another operator", list)
    assert pieces._loaded(PATH) is not model and len(base._KEPT) == 1
    quality._fit(pd.DataFrame({"text": ["a b"], "label": [1], "pick": [0]}), quality.Settings())
    assert not base._KEPT
