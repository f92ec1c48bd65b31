"""The registered queries, and the pipeline stage by stage, on the smallest tables."""

import random

import duckdb
import numpy as np
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from linkhoard.llm import oracles, queries, quality
from linkhoard.llm.base import read, tokenizer_file

from ..compare import difference
from .conftest import documents
from .test_decontamination import words as index_words
from .test_linededup import plain_dropped
from .test_linededup import words as line_words
from .test_shingles import plain_components, plain_set
from .test_simhash import plain_classes, plain_fingerprint

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", list(oracles.all_oracles()))
def test_query_matches_its_sql(spark, key):
    assert difference(queries.all_queries()[key](spark, SF_DIR), SF_DIR, oracles.all_oracles()[key]) is None


def test_all_are_registered():
    names = set(entry.queries())
    assert names >= {*queries.all_queries(), "pipeline"}
    assert {int(n[2:].split("_")[0]) for n in queries.all_queries()} == set(range(1, 14))


def test_simhash_query(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall())
    prints = {i: plain_fingerprint(t, 3) for i, t in texts.items()}
    names = plain_classes(prints)
    got = {tuple(r) for r in queries.op2_simhash(spark, SF_DIR).collect()}
    assert got == {(i, f"{prints[i]:016x}", names[i]) for i in texts}


def test_neighbour_query_is_exact_on_few_rows(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_DIR}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = {}
    for r in queries.op4_neighbours(spark, SF_DIR).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for at in np.flatnonzero(ids % 50 == 0):
        near = u @ u[at]
        near[at] = -2
        hits += len(set(ids[np.lexsort((ids, -near))[:5]].tolist()) & got[ids[at]])
    assert hits >= 0.9 * 5 * len(got)


def test_pipeline_stages_match_brute_force(spark):
    docs = read(spark, SF_DIR, "documents").cache()
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)

    def texts(df):
        return {r["doc_id"]: r["text"] for r in df.collect()}

    model = quality.train(docs, read(spark, SF_DIR, "labels"))
    good = {r["doc_id"] for r in quality.score(docs, model).collect() if r["score"] >= 0.3}
    kept = stages[names[0]](spark, docs, SF_DIR)
    assert set(texts(kept)) == good and kept.schema == docs.schema

    given = texts(docs)
    dropped = plain_dropped(given, 5)
    want = {}
    for i, text in given.items():
        lines = text.split("\n")
        left = [line for k, line in enumerate(lines) if (i, k) not in dropped]
        if len(left) == len(lines) or any(line_words(line) for line in left):
            want[i] = "\n".join(left)
    lines = stages[names[1]](spark, docs, SF_DIR)
    assert texts(lines) == want and lines.columns == docs.columns

    classes = plain_classes({i: plain_fingerprint(t, 5) for i, t in given.items()})
    firsts = {i: plain_set(given[i]) for i in set(classes.values())}
    alike = plain_components(firsts, lambda a, b: firsts[a] and 5 * len(firsts[a] & firsts[b]) >= 4 * len(firsts[a] | firsts[b]))
    assert set(texts(stages[names[2]](spark, docs, SF_DIR))) == set(alike.values()) < set(firsts)
    assert len(stages) == 5

    bench = [index_words(t) for (t,) in duckdb.sql(f"SELECT text FROM '{SF_DIR}/benchmark.parquet'").fetchall()]
    forms = {" ".join(w[k : k + 10]) for w in bench for k in range(max(1, len(w) - 9))}
    clean = {i for i, t in given.items() if not any(f" {f} " in f" {' '.join(index_words(t))} " for f in forms)}
    assert set(texts(stages[names[3]](spark, docs, SF_DIR))) == clean and len(clean) < len(given)

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    for r in stages[names[4]](spark, docs, SF_DIR).collect():
        assert r["ids"] == library.encode(given[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
        assert r["text"] == library.decode(r["ids"])


def test_pipeline_stages_take_odd_tables(spark):
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (2, ""), (None, "no id"), (None, None), (3, "word " * 5000), (4, "\n\n")] + [(10 + k, " ".join(rng.choice("abcdef") * 3 for _ in range(30))) for k in range(9)]
    for _, stage in corpus_pipeline.STAGES:
        for df in (documents(spark, rows, extra=True), documents(spark, {}, extra=True)):
            out = stage(spark, df, SF_DIR)
            assert set(df.columns) <= set(out.columns)
            assert (out.count() == 0) == (df.count() == 0)


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert 0 < out.count() < read(spark, SF_DIR, "documents").count()
    assert {"doc_id", "text", "ids", "n_tokens"} <= set(out.columns)
