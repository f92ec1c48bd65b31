"""Tables that stages write for themselves are gone when the stage is defined, and sketches exclude no similar sets."""

import random
from pathlib import Path

from linkhoard.llm import linededup, shingles, simhash
from linkhoard.sources import tables


def documents(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(60)) + "\nsame line of some words" for _ in range(20)]
    texts += [t.replace("a", "a a", 1) for t in texts[:5]]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_stages_leave_their_result_only(spark):
    folder = Path(tables.work_folder(spark))
    docs = tables.materialize(documents(spark), "given")
    for stage in (linededup.deduplicate, simhash.drop_near_duplicates, shingles.drop_near_copies):
        before = {p.name for p in folder.iterdir()}
        left = stage(docs)
        new = {p.name.rsplit("-", 1)[0] for p in folder.iterdir()} - {n.rsplit("-", 1)[0] for n in before}
        assert new <= {"dropped-lines", "near-duplicates", "near-copies"} and len(new) == 1
        assert 0 < left.count() <= 25


def test_sketches_keep_all_similar_pairs(spark):
    rng = random.Random(5)
    rows, similar = [], set()
    sets = [[rng.getrandbits(62) for _ in range(rng.randint(1, 900))] for _ in range(30)]
    sets += [s[: len(s) - len(s) // 9] + [rng.getrandbits(62) for _ in range(len(s) // 20)] for s in sets]
    texts = [" ".join(f"w{x}" for x in s) for s in sets]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    none = shingles.np.array([], dtype="int64")
    found = {r["doc_id"]: r for r in shingles._sets(given, 1, none, none).collect()}
    pairs = [(a, b) for a in found for b in found if a < b]
    for a, b in pairs:
        x, y = set(found[a]["shingles"]), set(found[b]["shingles"])
        if len(x & y) * 5 >= len(x | y) * 4:
            similar.add((found[a]["node"], found[b]["node"]))
    named = spark.createDataFrame([(found[a]["node"], found[b]["node"]) for a, b in pairs], "a long, b long")
    rows = spark.createDataFrame([(r["node"], r["n"], r["sketch"]) for r in found.values()], "node long, n int, sketch array<long>").dropDuplicates(["node"])
    kept = set(map(tuple, shingles._plausible(named, rows).collect()))
    assert similar and similar <= kept and len(kept) < len(pairs) / 4
