"""Benchmark decontamination with a distributed positional inverted index.

Words are runs of bytes outside ``00-2F 3A-60 7B-7F`` after lower-casing A-Z. A window is ``size`` consecutive words of a
benchmark item; an item with fewer words, but not none, is one window.

Index: for every document the positions of each word that occurs in a window, grouped by word, as a stored table. It
is sharded by document: a shard answers for its documents alone, so no word, however frequent, is gathered anywhere, and
nothing is shuffled. Search: the words of each window are ordered by their count in the whole corpus; the positions of
the rarest, moved by its place in the window, are the first candidates, and are intersected with the moved
positions of the next rarest and so on. What remains are exact phrase matches. ``proximity`` finds windows whose words
lie close together in any order from the same index.

Windows reach the tasks in blocks of about ``block`` windows and items, whatever the size of the benchmark: each
block has its index, and the hits of all blocks are merged per document. NULL texts and texts without words have no
words and no hits; NULL items and items without words have no windows. Repeated document rows each get their own result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from . import base

WINDOW = 10
BLOCK = 100_000
_SHIFT = 40
_SLICE = 1 << 20
_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

INDEX = "doc_id long, row_hash long, n_words long, terms array<int>, counts array<int>, positions array<int>"
MATCHES = "doc_id long, row_hash long, n_words long, starts array<int>, ends array<int>, items array<string>"


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(_WORD_BYTES).split()


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(item_id, terms)`` of the windows of all items; item_id as text, terms joined by spaces."""

    def run(batches):
        base.forget()
        for batch in batches:
            ids, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                w = words(text)
                mine = {b" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else ()
                found += mine
                ids += [item] * len(mine)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.binary())], names=["item_id", "terms"])

    rows = benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "item_id string, terms binary")


@dataclass
class Block:
    """Windows of one block: their words as numbers, and the items of each."""

    vocabulary: dict[bytes, int]
    windows: list[list[int]]
    items: list[list[str]]

    @staticmethod
    def of(rows) -> "Block":
        by_terms: dict[bytes, set[str]] = {}
        for item, terms in rows:
            by_terms.setdefault(bytes(terms), set()).add(item)
        vocabulary: dict[bytes, int] = {}
        split = [[vocabulary.setdefault(w, len(vocabulary)) for w in terms.split()] for terms in by_terms]
        return Block(vocabulary, split, [sorted(v) for v in by_terms.values()])


def blocks(benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK) -> Iterator[Block]:
    found = materialize(windows(benchmark, size), "benchmark-windows")
    parts = max(1, -(-found.count() // block))
    for k in range(parts):
        part = found.filter(F.pmod(F.xxhash64("terms"), F.lit(parts)) == k)
        yield Block.of(part.collect())  # about `block` rows, a parameter


# Index


def index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """The postings of the words of ``vocabulary``, a row per document, stored as a table."""

    def run(batches):
        base.forget()
        for batch in batches:
            rows = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                w = words(text)
                ids = np.fromiter(map(vocabulary.get, w, repeat(-1)), dtype=np.int32, count=len(w))
                places = np.flatnonzero(ids >= 0).astype(np.int32)
                ids = ids[places]
                order = np.argsort(ids, kind="stable")
                terms, counts = np.unique(ids, return_counts=True)
                rows.append((len(w), terms, counts.astype(np.int32), places[order]))
            n_words, *lists = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_hash"), pa.array(n_words, pa.int64()), *map(_list_array, lists)],
                names=["doc_id", "row_hash", "n_words", "terms", "counts", "positions"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_hash"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, INDEX), "positional-index")


def _list_array(lists) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64))).astype(np.int32)
    values = np.concatenate(lists) if len(lists) else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def term_counts(postings: DataFrame, terms: int) -> np.ndarray:
    """Occurrences of each word in the whole corpus."""

    def run(batches):
        total = np.zeros(terms, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch, "terms"), _flat(batch, "counts"), minlength=terms).astype(np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["term", "n"])

    out = np.zeros(terms, dtype=np.int64)
    for row in postings.select("terms", "counts").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]  # one row per word of the block
    return out


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


@dataclass
class _Search:
    """Windows in the order of the rarity of their words: row w, column r has the r-th rarest word and its place."""

    terms: np.ndarray
    places: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(block: Block, counts: np.ndarray) -> "_Search":
        width = max(map(len, block.windows), default=0)
        terms = np.full((len(block.windows), width), -1, dtype=np.int64)
        places = np.zeros_like(terms)
        for w, window in enumerate(block.windows):
            order = sorted(range(len(window)), key=lambda k: (counts[window[k]], k))
            terms[w, : len(window)] = [window[k] for k in order]
            places[w, : len(window)] = order
        return _Search(terms, places, np.array([len(w) for w in block.windows], dtype=np.int64))


def _postings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ``word << 40 | place`` of a batch, and where its documents begin; a gap follows each document."""
    n_words = batch.column("n_words").to_numpy()
    bases = np.concatenate(([0], np.cumsum(n_words + 1)))
    per_doc = pa.compute.list_value_length(batch.column("positions")).to_numpy(zero_copy_only=False)
    places = _flat(batch, "positions") + np.repeat(bases[:-1], per_doc)
    keys = np.repeat(_flat(batch, "terms").astype(np.int64), _flat(batch, "counts")) << _SHIFT | places
    keys.sort()
    return keys, bases


def _candidates(keys: np.ndarray, search: _Search) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(window, place of its rarest word)``, in slices of bounded size."""
    if not search.terms.size or not len(keys):
        return
    low = np.searchsorted(keys, search.terms[:, 0] << _SHIFT)
    high = np.searchsorted(keys, search.terms[:, 0] + 1 << _SHIFT)
    ends = np.cumsum(high - low)
    total = int(ends[-1]) if len(ends) else 0
    for at in range(0, total, _SLICE):
        rank = np.arange(at, min(total, at + _SLICE))
        window = np.searchsorted(ends, rank, side="right")
        place = keys[low[window] + rank - (ends[window] - (high - low)[window])] & (1 << _SHIFT) - 1
        yield window, place


def _contains(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(keys, wanted)
    return (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == wanted)


def phrases(keys: np.ndarray, search: _Search) -> tuple[np.ndarray, np.ndarray]:
    """``(window, place of its first word)`` of all exact occurrences."""
    windows_, starts = [], []
    for window, place in _candidates(keys, search):
        start = place - search.places[window, 0]
        window, start = window[start >= 0], start[start >= 0]
        for r in range(1, search.terms.shape[1]):
            term = search.terms[window, r]
            kept = (term < 0) | _contains(keys, term << _SHIFT | start + search.places[window, r])
            window, start = window[kept], start[kept]
        windows_.append(window)
        starts.append(start)
    return (np.concatenate(windows_), np.concatenate(starts)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _matches(postings: DataFrame, block: Block, search: _Search) -> DataFrame:
    """For every document the runs of hit words and the items with an occurring window."""

    def run(batches):
        for batch in batches:
            keys, bases = _postings(batch)
            window, start = phrases(keys, search)
            depth = np.zeros(int(bases[-1]) + 1, dtype=np.int64)
            np.add.at(depth, start, 1)
            np.add.at(depth, start + search.sizes[window], -1)
            edges = np.diff(np.concatenate(([0], (np.cumsum(depth) > 0).astype(np.int8), [0])))
            first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            doc = np.searchsorted(bases, first, side="right") - 1
            offsets = pa.array(np.searchsorted(doc, np.arange(len(batch.column(0)) + 1)).astype(np.int32))
            items: list[set[str]] = [set() for _ in range(batch.num_rows)]
            pairs = np.unique(np.stack([np.searchsorted(bases, start, side="right") - 1, window], axis=1), axis=0)
            for d, w in pairs.tolist():
                items[d].update(block.items[w])
            runs = [pa.ListArray.from_arrays(offsets, pa.array((x - bases[doc]).astype(np.int32))) for x in (first, last)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in ("doc_id", "row_hash", "n_words")), *runs, pa.array(map(sorted, items), pa.list_(pa.string()))],
                names=["doc_id", "row_hash", "n_words", "starts", "ends", "items"],
            )

    return postings.mapInArrow(run, MATCHES)


def exact_matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: ``n_words``, the runs ``[starts, ends)`` of hit words and the ``items`` that hit them."""
    found = []
    for part in blocks(benchmark, size, block):
        postings = index(docs, part.vocabulary)
        found.append(_matches(postings, part, _Search.of(part, term_counts(postings, len(part.vocabulary)))))
    if len(found) == 1:
        return found[0]
    merged = found[0]
    for other in found[1:]:
        merged = merged.union(other)
    # Equal rows have equal hits: they are merged together and given back as often as they came.
    together = merged.groupBy("doc_id", "row_hash", "n_words").agg(
        *[F.flatten(F.collect_list(k)).alias(k) for k in ("starts", "ends", "items")], (F.count("*") / len(found)).cast("int").alias("rows")
    )
    return together.select("*", F.explode(F.sequence(F.lit(1), "rows"))).drop("rows", "col")


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` of every row of ``docs``."""

    def run(batches):
        for batch in batches:
            rows = []
            for starts, ends, items in zip(batch["starts"], batch["ends"], batch["items"]):
                hit, reach = 0, 0
                for a, b in sorted(zip(starts, ends)):
                    hit += max(0, b - max(a, reach))
                    reach = max(reach, b)
                names = sorted(set(items))
                rows.append((hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0))
            made = pd.DataFrame(rows, columns=["n_hit", "n_items", "items_sha256", "contaminated"])
            yield pd.concat([batch[["doc_id", "n_words"]].reset_index(drop=True), made], axis=1)

    # An id that is NULL would turn the column into floating-point, so ids pass as text.
    rows = exact_matches(docs, benchmark, size, block).withColumn("doc_id", F.col("doc_id").cast("string")).drop("row_hash")
    schema = "doc_id string, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return rows.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def _closest(places: list[np.ndarray], around: int) -> tuple[int, int] | None:
    """Shortest ``[start, end)`` that holds a different place of each list, and the place ``around``."""
    events = sorted({int(p) for ps in places for p in ps})
    need: dict[tuple[int, ...], int] = {}
    for ps in places:
        key = tuple(ps.tolist())
        need[key] = need.get(key, 0) + 1
    best = None
    for i, a in enumerate(events):
        if a > around:
            break
        for b in events[i:]:
            if b >= around and all(sum(a <= p <= b for p in ps) >= n for ps, n in need.items()):
                if best is None or b + 1 - a < best[1] - best[0]:
                    best = (a, b + 1)
                break
    return best


def proximity(docs: DataFrame, benchmark: DataFrame, slop: int = 2, size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``(doc_id, item_id, start, end)``: words ``[start, end)`` hold all words of a window of the item, in any order, with at most ``slop`` others.

    For each place of the rarest word the shortest such run around it; equal rows come once.
    """
    found = None
    for part in blocks(benchmark, size, block):
        postings = index(docs, part.vocabulary)
        search = _Search.of(part, term_counts(postings, len(part.vocabulary)))
        rows = postings.mapInArrow(_near(part, search, slop), "doc_id long, item_id string, start int, end int")
        found = rows if found is None else found.union(rows)
    return found.distinct()


def _near(block: Block, search: _Search, slop: int):
    def run(batches):
        for batch in batches:
            keys, bases = _postings(batch)
            ids, rows = batch.column("doc_id").to_pylist(), []
            for window, place in _candidates(keys, search):
                reach = search.sizes[window] + slop - 1
                for r in range(1, search.terms.shape[1]):
                    term = search.terms[window, r]
                    low = np.searchsorted(keys, term << _SHIFT | np.maximum(place - reach, 0))
                    high = np.searchsorted(keys, (term << _SHIFT | place + reach) + 1)
                    kept = (term < 0) | (high > low)
                    window, place, reach = window[kept], place[kept], reach[kept]
                doc = np.searchsorted(bases, place, side="right") - 1
                for w, p, span, d in zip(window.tolist(), place.tolist(), reach.tolist(), doc.tolist()):
                    left, right = max(int(bases[d]), p - span), min(int(bases[d + 1]) - 2, p + span)
                    lists = []
                    for term in block.windows[w]:
                        a, b = np.searchsorted(keys, [term << _SHIFT | left, (term << _SHIFT | right) + 1])
                        lists.append(keys[a:b] & (1 << _SHIFT) - 1)
                    best = _closest(lists, p)
                    if best and best[1] - best[0] <= span + 1:
                        rows += [(ids[d], item, best[0] - int(bases[d]), best[1] - int(bases[d])) for item in block.items[w]]
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "start", "end"])

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs. Rows without a doc_id are kept."""
    hits = exact_matches(docs, benchmark, size).filter((F.size("items") > 0) & F.col("doc_id").isNotNull())
    gone = hits.select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_row")).distinct()
    keyed = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_row": F.xxhash64("text")})
    return keyed.join(gone, ["_id", "_row"], "left_anti").select(docs.columns)
