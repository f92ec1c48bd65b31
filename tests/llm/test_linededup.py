import itertools
import random

import pytest

from linkhoard.llm import linededup

from .conftest import documents, prose


def words(line):
    for c in "\t\r\x0b\x0c":
        line = line.replace(c, " ")
    return tuple(w for w in line.lower().split(" ") if w)


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def plain_dropped(texts, least):
    lines = [(i, k, words(line)) for i in sorted(texts) if texts[i] is not None for k, line in enumerate(texts[i].split("\n"))]
    lines = [x for x in lines if x[2]]
    return {(i, k) for n, (i, k, w) in enumerate(lines) if any(w == v or min(len(w), len(v)) >= least and near(w, v) for _, _, v in lines[:n])}


def varied(rng, line):
    w = line.split(" ")
    at = rng.randrange(len(w))
    return " ".join(rng.choice((w[:at] + w[at + 1 :], w[:at] + ["NEW"] + w[at:], w[:at] + ["other"] + w[at + 1 :], w[::-1], w)))


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_lines_match_brute_force(spark, broadcast):
    rng = random.Random(5)
    base = [prose(rng, rng.randint(1, 14)) for _ in range(25)]
    texts = {i: "\n".join(varied(rng, rng.choice(base)) for _ in range(rng.randint(1, 6))) for i in range(60)}
    texts |= {100: None, 101: "", 102: "\n\n", 103: "A  b\tc d E\na B c d e\r", 104: "x " * 3000 + "y", 105: "x " * 3000 + "z"}
    found = linededup.dropped_lines(documents(spark, texts, extra=True), 5, broadcast)
    assert {(r["doc_id"], r["line_no"]) for r in found.collect()} == plain_dropped(texts, 5)


def test_lines_that_share_a_deleted_form_may_be_two_edits_apart(spark):
    # "q a b c d e" and "a b c d e q" both lose q to the same words, but are two edits apart.
    texts = {1: "q a b c d e", 2: "a b c d e q", 3: "a b c d e"}
    found = {(r["doc_id"], r["line_no"]) for r in linededup.dropped_lines(documents(spark, texts)).collect()}
    assert found == {(3, 0)}


def test_one_edit_agrees_with_the_definition(spark):
    cases = [(list(a), list(b)) for a, b in itertools.product(["abcd", "abc", "bcd", "abxd", "abcde", "dcba", "a", "", "abcd"], repeat=2)]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, a array<string>, b array<string>")
    from pyspark.sql import functions as F

    got = {r["k"]: r["e"] for r in df.select("k", linededup._one_edit(F.col("a"), F.col("b")).alias("e")).collect()}
    assert got == {k: near(tuple(a), tuple(b)) for k, (a, b) in enumerate(cases)}


def test_documents_keep_their_other_lines(spark):
    texts = {1: "one two three four five\nshort\nsix seven eight nine ten", 2: "one two three four six\nown words of this one here", 3: "One two three four five\nshort", 4: "short", 5: None}
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in linededup.deduplicate(documents(spark, texts, extra=True)).collect()}
    own = "own words of this one here"
    assert got == {1: (texts[1], len(texts[1])), 2: (own, len(own)), 5: (None, None)}


def test_repeated_rows_null_ids_and_empty_tables(spark):
    line = "one two three four five"
    rows = [(1, line), (1, line), (None, line), (2, line)]
    report = sorted((r["doc_id"] or 0, r["n_lines"], r["n_dropped"]) for r in linededup.line_report(documents(spark, rows)).collect())
    assert report == [(0, 1, 0), (1, 1, 0), (1, 1, 0), (2, 1, 1)]
    assert linededup.line_report(documents(spark, {})).count() == 0
    assert linededup.deduplicate(documents(spark, {})).count() == 0


def test_documents_with_short_lines_of_their_own_stay(spark):
    line = "one two three four five"
    texts = {1: f"{line}\nRefrain", 2: f"{line}\na poem in\nshort lines", 3: f"short lines\n{line}\n\nrefrain", 4: f"{line}\n我们不用空格", 5: line, 6: f"{line}\n \n"}
    got = {r["doc_id"]: r["text"] for r in linededup.deduplicate(documents(spark, texts, extra=True)).collect()}
    assert got == {1: texts[1], 2: "a poem in\nshort lines", 4: "我们不用空格"}
