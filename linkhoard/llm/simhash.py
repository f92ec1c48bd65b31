"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: 64 bits; bit i is set if it is set in over half of the XXH64 hashes (seed 42) of the text's
shingles, repeats included. Words are what ASCII white space separates, with A-Z lower-cased; a text
with fewer words than a shingle is one shingle, and one without words (or NULL) has fingerprint zero.

Covering tables: for radius r, bit i gets a nonzero label m(i) of r+1 bits, and each nonzero vector v of r+1
bits is a table whose mask has the bits with <m(i), v> odd. For any r bits some v is orthogonal to their
labels, so every pair within the radius agrees on some mask and meets in that table; none is missed.

Inside a bucket members differ in the bits outside the mask only. For radius 2 they are matched without pairs: each member offers itself and its neighbours at one flipped bit, and members that offer one point are
linked to the smallest of them. Two of them are at most 2 bits apart, and any two that are 2 bits apart share a
point. A bucket of n members makes n * (1 + bits outside) rows, however large it is, and a point holds at most one
member more than there are bits. All steps work on distinct fingerprints, so copies cost nothing here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import is_small, materialize, measure, passing
from . import base
from .components import components

BITS = 64
SEED = 42
_BLOCK = 1 << 14


def fingerprint(text: bytes, words: int = 3) -> int:
    """Fingerprint of one UTF-8 text, as an unsigned number."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    columns = [tokens[k:] for k in range(min(words, len(tokens)))]
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*columns))], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at : at + _BLOCK].view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``(doc_id, row, fp)`` of every row, ``fp`` as a signed 64-bit number; ``row`` is a hash of the text, which tells rows of one doc_id apart."""

    def run(batches):
        base.forget()
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            values = np.array([fingerprint(t or b"", words) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values)], names=["doc_id", "row", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, row long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def covering_masks(radius: int = 2, bits: int = BITS) -> list[int]:
    """The masks of the tables: any ``radius`` bits are all outside at least one of them."""
    width = radius + 1
    labels = [1 + i % (2**width - 1) for i in range(bits)]
    return [
        sum(1 << i for i in range(bits) if (labels[i] & v).bit_count() % 2) for v in range(1, 2**width)
    ]


def _offers(mask: int) -> Column:
    """What a member of a bucket offers: itself and its neighbours at one flipped bit outside the mask."""
    flips = [0] + [_signed(1 << i) for i in range(BITS) if not mask >> i & 1]
    return F.array(*[F.col("fp").bitwiseXOR(F.lit(f)) for f in flips])


def links(distinct: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints of the column ``fp`` within 2 bits, and only those.

    ``distinct`` holds each fingerprint once. Not every pair is a row, but any two within 2 bits are
    linked to a common third or to each other.
    """
    masks = covering_masks(2)
    table = F.explode(F.array(*[
        F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(masks)
    ]))
    keyed = distinct.select("fp", table.alias("x")).select("fp", "x.t", "x.key")
    full = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1").select("t", "key")
    offers = F.lit(None).cast("array<bigint>")
    for k, m in enumerate(masks):
        offers = F.when(F.col("t") == k, _offers(m)).otherwise(offers)
    points = keyed.join(full, ["t", "key"]).select("t", "fp", F.explode(offers).alias("point"))
    # A point and its table name the bucket: the bits of the mask are never flipped.
    stars = points.groupBy("t", "point").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("members"))
    return stars.filter(F.size("members") > 1).select(F.explode("members").alias("a"), "b").filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """``(doc_id, row, fp, component_id)``: component_id is the smallest doc_id reachable over links of at most 2 bits.

    Repeated rows stay; rows with a NULL doc_id take part but never name a component.
    """
    prints = materialize(fingerprints(docs, words), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    roots = components(links(distinct)).withColumnsRenamed({"node": "fp"})
    rooted = distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = materialize(rooted.join(named, "root").select("fp", "component_id"), "components")
    return prints.join(classes, "fp").select("doc_id", "row", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = 5) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component.

    Rows of one doc_id with other texts are decided by their own texts.

    Rows without a doc_id can't be told apart and are kept.
    """
    with passing() as keep:
        found = near_duplicates(docs, words)
        gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).distinct()
        gone, seen = measure(gone, "near-duplicates", rows=F.count("*"))
        keep(gone)
    gone = F.broadcast(gone) if is_small(seen["rows"]) else gone
    keyed = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_row": F.xxhash64("text")})
    return keyed.join(gone, ["_id", "_row"], "left_anti").select(docs.columns)
