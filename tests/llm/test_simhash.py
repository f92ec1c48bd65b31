import random
import re

import pytest
import xxhash

from linkhoard.llm import simhash
from linkhoard.llm.components import components

from .conftest import documents, prose


def plain_fingerprint(text, words):
    tokens = [w for w in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[k : k + words]) for k in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    """Smallest id reachable over links of at most 2 bits."""
    name = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 2 and name[b] < name[a]:
                    name[a], changed = name[b], True
    return name


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_set_of_bits(radius):
    masks = simhash.covering_masks(radius)
    rng = random.Random(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(2000):
        bits = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not m & bits for m in masks)


def test_links_connect_exactly_what_is_near(spark):
    rng = random.Random(3)
    values = {0, (1 << 64) - 1}
    for _ in range(12):  # clusters: a centre, its neighbours, and chains that leave it
        centre = rng.getrandbits(64)
        values.add(centre)
        for _ in range(12):
            near = centre
            for _ in range(rng.randint(1, 3)):
                near ^= 1 << rng.randrange(64)
            values.add(near)
            values.add(near ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    found = simhash.links(spark.createDataFrame([(v,) for v in signed.values()], "fp long"))
    pairs = found.collect()
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in pairs)
    roots = {r["node"]: r["root"] for r in components(found).collect()}
    want = plain_classes({s: v for v, s in signed.items()})
    assert {s: roots.get(s, s) for s in signed.values()} == want


def test_near_duplicates_match_brute_force(spark, rng):
    texts = {i: prose(rng, rng.randint(1, 60)) for i in range(40)}
    texts |= {100 + i: texts[i] for i in range(10)}
    texts |= {200 + i: texts[i] + " tail" for i in range(10)}
    texts |= {300: None, 301: "", 302: " \t\n", 303: "One", 304: "ONE", 305: "é É", 306: "word " * 70_000}
    prints = {i: plain_fingerprint(t, 3) for i, t in texts.items()}
    want = plain_classes(prints)
    got = simhash.near_duplicates(documents(spark, texts, extra=True), 3).collect()
    assert {(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got} == {(i, prints[i], want[i]) for i in texts}
    assert want[301] == want[302] == 300 and want[304] == 303


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "x y z")]
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in got) == [(0, 1), (1, 1), (1, 1), (2, 2)]
    kept = simhash.drop_near_duplicates(documents(spark, [*rows, (3, "A B c d")]))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 1, 2]
    assert simhash.near_duplicates(documents(spark, {})).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k + 1, k) for k in range(60)]
    star = [(1000, 1001 + k) for k in range(50)] + [(5000, 5000)]
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert roots == {k: 0 for k in range(1, 61)} | {1001 + k: 1000 for k in range(50)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rows_of_one_id_with_other_texts_are_decided_by_their_own(spark):
    kept = simhash.drop_near_duplicates(documents(spark, [(1, "a b c d"), (2, "a b c d"), (2, "its own text")], extra=True))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "a b c d"), (2, "its own text")]
