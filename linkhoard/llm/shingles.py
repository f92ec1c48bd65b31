"""Near copies: documents whose sets of word shingles have a Jaccard similarity of at least 0.8, by a prefix filter.

Shingles are those of ``simhash``, as XXH64 hashes; similarity is exact on these. Documents with one set are one node.

1. All sets are sorted by one order of the shingles: rare ones first, by their count in a sample of the documents, then by
   hash. Two sets of similarity 0.8 share a shingle among the first n - ceil(0.8 n) + 1 of each, whatever the order is, so
   the sample decides about the cost and never about the result.
2. Each node is compared with the smallest node of each of its prefix shingles; what is similar is united. This unites
   large groups of near copies with a row for each member and shingle.
3. What is left are nodes that share a prefix shingle and are not united. Per shingle, those outside its largest class are
   paired with all of other classes; so each pair not settled yet is compared.

Before sets are compared, pairs are told apart by sketches of 1,024 bits, where bit i is the parity of the shingles whose hash ends in
i. A shingle that only one of two sets has changes one bit, so sketches that differ in more bits than similar sets of their sizes have shingles of their own
exclude the pair. Whole sets are worked out, and moved, for the other pairs only.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import is_small, materialize, measure, passing
from . import base
from .components import components
from .simhash import SEED

_SKETCH_BITS = 1024
#: One document of so many is in the sample that the order comes from, and at most so many shingles have a count.
SAMPLE = 8
MAX_COUNTED = 500_000


def shingles(text: bytes, words: int) -> np.ndarray:
    """Distinct hashes of the shingles of one UTF-8 text, ascending; none for a text without words."""
    tokens = text.lower().split()
    if not tokens:
        return np.array([], dtype=np.int64)
    columns = [tokens[k:] for k in range(min(words, len(tokens)))]
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*columns))], dtype=np.uint64)
    return np.unique(hashes.view(np.int64))


def _sets(docs: DataFrame, words: int, common: np.ndarray, counts: np.ndarray) -> DataFrame:
    """``(doc_id, row, node, n, sketch, shingles)`` of every row with words; shingles rare in ``common`` (ascending) and ``counts`` come first."""

    def run(batches):
        base.forget()
        for batch in batches:
            ids, kept, nodes, sizes, sketches, found = [], [], [], [], [], []
            for doc_id, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
                hashes = shingles(text or b"", words)
                if not len(hashes):
                    continue
                nodes.append(int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).astype(np.int64)))
                odd = np.bincount(hashes & (_SKETCH_BITS - 1), minlength=_SKETCH_BITS) & 1
                sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                if len(common):
                    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
                    hashes = hashes[np.lexsort((hashes, np.where(common[at] == hashes, counts[at], 0)))]
                ids.append(doc_id)
                kept.append(row)
                sizes.append(len(hashes))
                found.append(hashes)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            flat = np.concatenate(found) if found else np.array([], dtype=np.int64)
            arrays = [pa.array(ids, pa.int64()), pa.array(kept, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.list_(pa.int64())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "row", "node", "n", "sketch", "shingles"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, row long, node long, n int, sketch array<long>, shingles array<long>")


def _common(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that the sample repeats, ascending, and their counts there; the rarest are left out if they are too many."""
    none = np.array([], dtype=np.int64)
    sampled = _sets(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0), words, none, none)
    counts = sampled.select(F.explode("shingles").alias("shingle")).groupBy("shingle").count().filter("count > 1")
    counts = materialize(counts, "shingle-counts")
    least, room = 2, MAX_COUNTED
    for count, rows in sorted(counts.groupBy(F.least("count", F.lit(10_000)).alias("count")).agg(F.count("*").alias("n")).collect(), reverse=True):
        room -= rows
        if room < 0:
            least = count + 1
            break
    rows = counts.filter(F.col("count") >= least).toArrow().sort_by("shingle")
    return rows["shingle"].to_numpy(), rows["count"].to_numpy()


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of ``(a, b)``, distinct pairs of nodes, whose sets have a similarity of at least 0.8."""
    a, b = (sets.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("shingles").alias(f"of_{k}")) for k in "ab")
    joined = pairs.join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return joined.filter(common * 9 >= (F.col("n_a") + F.col("n_b")) * 4).select("a", "b")


def _sizes_fit(n: Column, m: Column) -> Column:
    return F.least(n, m) * 5 >= F.greatest(n, m) * 4


def _prefix() -> Column:
    """The shingles of which similar sets share at least one."""
    return F.slice("shingles", 1, F.col("n") - F.floor((F.col("n") * 4 + 4) / 5).cast("int") + 1)


def _plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The rows of ``(a, b)``, distinct pairs of nodes, that their ``(node, n, sketch)`` do not exclude."""
    a, b = (sketches.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(f"of_{k}")) for k in "ab")
    joined = pairs.join(a, "a").join(b, "b")
    differing = F.aggregate(F.zip_with("of_a", "of_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda done, k: done + k)
    # Sets share 4/9 of both sizes at least, so they have 1/9 of them at most that the other lacks.
    return joined.filter(differing * 9 <= F.col("n_a") + F.col("n_b")).select("a", "b")


def similar_links(rows: DataFrame, sets_of: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Links ``(a, b)`` that connect all nodes of similarity 0.8 or more, and only those.

    ``rows`` are ``(node, n, shingles)``, all shingles in one order, and may have the ``sketch`` of a set; nodes may be repeated. Not every pair is a row. With ``sets_of``,
    rows have their ``prefix`` only, and the sets ``(node, n, shingles)`` of the nodes it is given, each once, are worked out when they are wanted.
    """
    spread = rows.select("node", "n", F.explode("prefix" if sets_of else _prefix()).alias("shingle"))
    least = F.min(F.struct("node", "n")).alias("least")
    shared = spread.groupBy("shingle").agg(least, F.max("node").alias("most")).filter("most > least.node").select("shingle", "least")
    members = materialize(spread.join(shared, "shingle").distinct(), "shared-shingles")
    sketches = rows.select("node", "n", "sketch").dropDuplicates(["node"]) if "sketch" in rows.columns else None

    def similar(pairs: DataFrame, label: str) -> DataFrame:
        if sketches is not None:
            pairs = _plausible(pairs, sketches)
        pairs = materialize(pairs, f"{label}-pairs")
        involved, seen = measure(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{label}-nodes", rows=F.count("*"))
        if is_small(seen["rows"]):
            involved = F.broadcast(involved)
        given = sets_of(involved) if sets_of else rows.select("node", "n", "shingles").join(involved, "node", "left_semi").dropDuplicates(["node"])
        return _similar(pairs, materialize(given, f"{label}-sets"))

    stars = members.filter((F.col("node") > F.col("least.node")) & _sizes_fit(F.col("n"), F.col("least.n")))
    near = materialize(similar(stars.select(F.col("node").alias("a"), F.col("least.node").alias("b")).distinct(), "star"), "similar-stars")
    roots = components(near)
    classed = members.select("shingle", "node", "n").join(roots, "node", "left").select("shingle", "node", "n", F.coalesce("root", "node").alias("class"))
    sizes = classed.groupBy("shingle", "class").agg(F.count("*").alias("nodes"))
    largest = sizes.groupBy("shingle").agg(F.max(F.struct("nodes", "class"))["class"].alias("largest"), F.count("*").alias("classes"))
    open_ = materialize(classed.join(largest.filter("classes > 1").select("shingle", "largest"), "shingle"), "open-shingles")
    ours = open_.filter(F.col("class") != F.col("largest"))
    theirs = open_.select("shingle", *[F.col(k).alias(f"other_{k}") for k in ("node", "n", "class", "largest")])
    # Of two nodes outside the largest class only one makes the pair.
    once = (F.col("other_class") == F.col("other_largest")) | (F.col("node") > F.col("other_node"))
    pairs = ours.join(theirs, "shingle").filter((F.col("class") != F.col("other_class")) & once & _sizes_fit(F.col("n"), F.col("other_n")))
    pairs = pairs.select(F.greatest("node", "other_node").alias("a"), F.least("node", "other_node").alias("b")).distinct()
    return near.unionByName(similar(pairs, "open"))


def near_copies(docs: DataFrame, words: int = 5) -> DataFrame:
    """``(doc_id, row, component_id)`` of every row with words: the smallest doc_id reachable over similarities of 0.8 or more.

    ``row`` is a hash of the text, which tells texts of one doc_id apart. Rows with a NULL doc_id take part but never
    name a component. Texts without words have no shingles and are left out.
    """
    common = _common(docs, words)
    rows = materialize(_sets(docs, words, *common).select("doc_id", "row", "node", "n", "sketch", _prefix().alias("prefix")), "shingle-prefixes")

    def sets_of(involved: DataFrame) -> DataFrame:
        """The whole sets of the nodes: of one text for each."""
        texts, seen = measure(rows.join(involved, "node", "left_semi").groupBy("node").agg(F.min("row").alias("_row")).select("_row"), "involved-texts", rows=F.count("*"))
        texts = F.broadcast(texts) if is_small(seen["rows"]) else texts
        chosen = docs.withColumn("_row", F.xxhash64("text")).join(texts, "_row", "left_semi")
        # Texts are shorter than their sets, so repeated ones go before sets are made.
        once = chosen.groupBy("_row", "text").agg(F.min("doc_id").alias("doc_id"))
        return _sets(once, words, *common).select("node", "n", "shingles")

    roots = components(similar_links(rows, sets_of))
    firsts = rows.groupBy("node").agg(F.min("doc_id").alias("first"))
    rooted = materialize(firsts.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), "shingle-set-roots")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = materialize(rooted.join(named, "root").select("node", "component_id"), "shingle-set-classes")
    return rows.select("doc_id", "row", "node").join(classes, "node").select("doc_id", "row", "component_id")


def drop_near_copies(docs: DataFrame, words: int = 5) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component. Rows without a doc_id can't be told apart and are kept."""
    with passing() as keep:
        gone = near_copies(docs, words).filter("doc_id <> component_id").select(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).distinct()
        gone, seen = measure(gone, "near-copies", rows=F.count("*"))
        keep(gone)
    if is_small(seen["rows"]):
        gone = F.broadcast(gone)
    keyed = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_row": F.xxhash64("text")})
    return keyed.join(gone, ["_id", "_row"], "left_anti").select(docs.columns)
