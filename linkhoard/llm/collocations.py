"""Collocations: phrases whose words stand together more often than their parts would by chance.

Texts are cut into pieces at punctuation and line ends and pieces into words; a phrase is a run of words of one piece. All counts are per
language and exact. They come from suffix trees over words, cut off at ``longest`` words, built group by group:

1. Words are counted. A word that is rarer than the least count ends every suffix, since no candidate holds it. Which words are frequent travels
   as a bitmap over word hashes of bounded size; a rare word that shares a bit only makes suffixes longer than needed.
2. Vertical partitioning: a prefix (at first a word) with more occurrences than the budget is split, that is replaced by its extensions by
   one word, until every prefix is within the budget or has full length. For this, tasks report the extensions that make up a share of their suffixes so
   large that what goes unreported is at most half a budget in all. Prefixes are laid out by hash and dealt to groups within the budget.
3. One pass sends every suffix, cut off, to the group of its prefix; equal suffixes of a task are sent once, with their number. Of suffixes below split
   prefixes the split part is sent too, to groups of its own.
4. A group sorts its suffixes: the distinct ones are the leaves of its subtrees, and a phrase's count is the total of the leaves below it.

No prefix outgrows the budget, whatever the language or phrase; extensions that go unreported are spread over the groups by their hash. Words are named by 64 bits of hash; two words with one name among the words of the
corpus are noticed, and the next seed is taken. Candidates are scored with exact integers and joined to their parts by name. NULL languages are ``und``; NULL and
empty texts have no words; repeated rows count as often as they stand there.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from . import base, grams

#: Suffixes of a group; each takes up to 48 bytes while the group is sorted.
BUDGET = 1 << 20
#: Suffixes of a task that are brought together before they are sent.
_GATHERED = 1 << 19
#: Known words of a task, and words it counts at once.
_KNOWN = 200_000
#: Bits of the bitmap of frequent words for each of them, and at most.
_BITS_A_WORD, _MOST_BITS = 16, 28
#: So many of the most frequent words are sent as numbers of two bytes.
_COMMON = 60_000
_BREAK = b"A"  # no word has an upper-case letter
_TABLE = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(data: bytes) -> list[bytes]:
    """Words of UTF-8 texts, with ``_BREAK`` where a piece ends."""
    return data.translate(_TABLE).replace(b"\n", b" " + _BREAK + b" ").split()


def name(lang: str, word: bytes, seed: int) -> int:
    """The hash that stands for a word of a language; never 0."""
    import xxhash

    return xxhash.xxh3_64_intdigest(word, xxhash.xxh3_64_intdigest(lang.encode(), seed)) or 1


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Texts of one language joined by line ends, of bounded size together."""
    for batch in batches:
        gathered, size = defaultdict(list), 0
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            data = text.as_py()
            gathered[lang].append(data)
            size += len(data)
            if size > base.CHUNK_BYTES:
                yield from ((k, b"\n".join(v)) for k, v in gathered.items())
                gathered, size = defaultdict(list), 0
        yield from ((k, b"\n".join(v)) for k, v in gathered.items())


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


# Words


def count_words(docs: DataFrame) -> DataFrame:
    """``(key, n)`` of all words, stored as a table; a key is the word behind its language and a tab, which no word has."""

    def run(batches):
        counts: dict[str, Counter] = defaultdict(Counter)
        for lang, data in _texts(batches):
            counts[lang].update(words(data))
            del counts[lang][_BREAK]
            if sum(map(len, counts.values())) > 2 * _KNOWN:
                yield from rows(counts)
                counts.clear()
        yield from rows(counts)

    def rows(counts):
        for lang, found in counts.items():
            front = lang.encode() + b"\t"
            keys = pa.array([front + w for w in found], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([keys, pa.array(found.values(), pa.int64())], names=["key", "n"])

    counted = _rows(docs).mapInArrow(run, "key string, n long")
    # Tasks have added up their own words already.
    return materialize(counted.repartition("key").groupBy("key").agg(F.sum("n").alias("n")), "word-counts")


def _with_names(counted: DataFrame, seed: int) -> DataFrame:
    """``(sym, lang, word, n)``, stored as a table; ``sym`` is the word's name."""

    def run(batches):
        for batch in batches:
            parts = [k.rpartition("\t") for k in batch.column(0).to_pylist()]
            names = np.array([name(lang, w.encode(), seed) for lang, _, w in parts], dtype=np.uint64)
            columns = [_signed(names), pa.array([p[0] for p in parts], pa.string()), pa.array([p[2] for p in parts], pa.string()), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=["sym", "lang", "word", "n"])

    return materialize(counted.mapInArrow(run, "sym long, lang string, word string, n long"), "words")


def _named_words(docs: DataFrame) -> tuple[DataFrame, int]:
    """The counted words under a seed that gives each a name of its own, and the seed."""
    counts = count_words(docs)
    for seed in range(100):
        counted = _with_names(counts, seed)
        if counted.groupBy("sym").agg(F.count("*").alias("k")).filter("k > 1").isEmpty():
            return counted, seed
    raise ValueError("no seed names the words apart")


@dataclass
class Bitmap:
    """A set of names with false positives, of bounded size."""

    bits: int
    data: np.ndarray

    @staticmethod
    def of(names: DataFrame, rows: int) -> "Bitmap":
        bits = min(_MOST_BITS, max(15, (rows * _BITS_A_WORD).bit_length()))
        place = F.shiftrightunsigned("sym", 64 - bits) + 1  # the functions count from 1
        bucket, bit = F.bitmap_bucket_number("place"), F.bitmap_bit_position("place")
        found = names.select(place.alias("place")).groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bitmap"))
        data = np.zeros((1 << bits) // 8, dtype=np.uint8)
        table = found.toArrow()  # at most 2 ** 28 bits
        for number, bitmap in zip(table.column("bucket").to_pylist(), table.column("bitmap")):
            data[(number - 1) * 4096 : number * 4096] = np.frombuffer(bitmap.as_buffer(), dtype=np.uint8)
        return Bitmap(bits, data)

    def __contains__(self, sym: int) -> bool:
        place = sym >> 64 - self.bits
        return bool(self.data[place >> 3] >> (place & 7) & 1)


def _most_frequent(often: DataFrame, most: int) -> tuple[np.ndarray, int]:
    """Names of the ``most`` most frequent words, in falling order, and the number of all words.

    Counts of so many binary digits tell which words can be among them; only those are sorted, and by a task: the driver, which would sort what it
    collects, gets no more than the result.
    """
    sizes = dict(often.groupBy(F.length(F.bin("n"))).count().collect())  # at most 64 rows
    least, held = 0, 0
    for digits in sorted(sizes, reverse=True):
        least, held = 1 << digits - 1, held + sizes[digits]
        if held >= most:
            break
    top = often.filter(F.col("n") >= least).orderBy(F.desc("n"), "sym").limit(most).select("sym").toArrow()
    return _longs(top, "sym").view(np.uint64), sum(sizes.values())


def _longs(table: pa.Table, column: str) -> np.ndarray:
    return np.asarray(table.column(column).to_numpy(), dtype=np.int64)


def _symbols(batches: Iterator[pa.RecordBatch], frequent: Bitmap, seed: int, gathered: int) -> Iterator[np.ndarray]:
    """Names of the words in a row, 0 for a break or a word that isn't frequent."""
    known: dict[str, dict[bytes, int]] = defaultdict(dict)
    held, size = [], 0
    for lang, data in _texts(batches):
        found, table = words(data), known[lang]
        row = list(map(table.get, found))
        if None in row:
            if sum(map(len, known.values())) > _KNOWN:
                known.clear()
                table = known[lang]
            for k in (k for k, s in enumerate(row) if s is None):
                word = found[k]
                sym = table.get(word)
                if sym is None:
                    sym = 0 if word == _BREAK else name(lang, word, seed)
                    sym = table[word] = sym if sym and sym in frequent else 0
                row[k] = sym
        row.append(0)
        held.append(np.array(row, dtype=np.uint64))
        size += len(row)
        if size > gathered:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def _suffixes(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(names, rows, counts)``: distinct suffixes of two words and more, cut off at ``longest``, in order, and how often each occurs.

    Rows have places in the sorted ``names``; where a suffix is shorter they have place 0, whose name is 0.
    """
    places = np.flatnonzero((symbols[:-1] != 0) & (symbols[1:] != 0))
    names, ids = np.unique(np.append(symbols, np.uint64(0)), return_inverse=True)
    ids = np.concatenate((ids.astype(np.int32), np.zeros(longest, dtype=np.int32)))
    rows = np.empty((longest, len(places)), dtype=np.int32)
    for k in range(longest):
        rows[k] = ids[places + k]
        if k:
            rows[k] *= rows[k - 1] > 0
    return names, *_distinct(rows.T, np.ones(len(places), dtype=np.int64))


def _distinct(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and the sums of their counts."""
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return rows[new], np.add.reduceat(counts, np.flatnonzero(new)) if len(rows) else counts


# Vertical partitioning


def _extended(key: np.ndarray, sym: np.ndarray) -> np.ndarray:
    return grams.mix(key * np.uint64(grams.MULTIPLIER) + sym)


def _prefix_keys(names: np.ndarray, rows: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key and length of each suffix's prefix: the shortest one that isn't split. Length 0: the suffix is a split prefix itself, or as long as one can be."""
    key, length = names[rows[:, 0]], np.ones(len(rows), dtype=np.int64)
    active = _within(key, split)
    for k in range(1, rows.shape[1]):
        if not active.any():
            break
        ends = active & (rows[:, k] == 0)
        length[ends] = 0
        active &= ~ends
        key[active] = _extended(key[active], names[rows[active, k]])
        length[active] += 1
        active[active] = _within(key[active], split)
    length[active] = 0
    return key, length


def _within(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), dtype=bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def _signed(names: np.ndarray) -> pa.Array:
    return pa.array(names.view(np.int64))


def _reported(docs: DataFrame, frequent: Broadcast, seed: int, split: np.ndarray, size: int, share: float) -> DataFrame:
    """``(key, n)`` of prefixes of ``size`` words whose first ``size - 1`` are split, as far as they are a ``share`` of the suffixes at hand; stored as a table."""

    def run(batches):
        for symbols in _symbols(batches, frequent.value, seed, _GATHERED):
            names, rows, counts = _suffixes(symbols, size)
            key, length = _prefix_keys(names, rows, split)  # no prefix of this size is split yet
            many = (length == size) & (counts >= share * counts.sum())
            yield pa.RecordBatch.from_arrays([_signed(key[many]), pa.array(counts[many])], names=["key", "n"])

    counted = _rows(docs).mapInArrow(run, "key long, n long")
    return materialize(counted.groupBy("key").agg(F.sum("n").alias("n")), "prefixes")


def _split(docs: DataFrame, often: DataFrame, frequent: Broadcast, seed: int, longest: int, budget: int) -> tuple[np.ndarray, DataFrame, int]:
    """Sorted keys of the split prefixes, ``(key, n)`` of the others as far as known, and the occurrences of the rest."""
    total = often.agg(F.sum("n").alias("n")).first()["n"] or 0
    prefixes, leaves, keys, rest, limit = often.select(F.col("sym").alias("key"), "n"), None, np.zeros(0, dtype=np.uint64), 0, budget // 2
    for size in range(2, longest + 2):
        # What no task reports of a prefix is less than half a budget, so one that isn't split has at most a whole one. Of each
        # length at most twice all occurrences divided by the budget are split.
        found = prefixes.filter(F.col("n") > limit).select("key", "n").toArrow()
        others = prefixes.filter(F.col("n") <= limit)
        leaves = others if leaves is None else leaves.unionByName(others)
        if not found.num_rows:
            break
        keys = np.union1d(keys, _longs(found, "key").view(np.uint64))
        rest += int(_longs(found, "n").sum())
        if size > longest:
            break
        prefixes = _reported(docs, frequent, seed, keys, size, limit / total)
        rest = max(0, rest - (prefixes.agg(F.sum("n").alias("n")).first()["n"] or 0))
    return keys, leaves, rest


def _bounds(leaves: DataFrame, rest: int, budget: int) -> np.ndarray:
    """Where groups begin in the order of keys; ``rest`` occurrences are spread evenly. About twice all occurrences divided by the budget."""
    total = (leaves.agg(F.sum("n").alias("n")).first()["n"] or 0) + rest
    bits = min(20, max(6, (64 * total // budget).bit_length()))
    place = F.shiftrightunsigned("key", 64 - bits)
    weights = np.full(1 << bits, -(-rest >> bits), dtype=np.int64)
    found = leaves.groupBy(place.alias("at")).agg(F.sum("n").alias("n")).toArrow()  # at most 2 ** 20 rows
    weights[_longs(found, "at")] += _longs(found, "n")
    starts, held = [0], 0
    for at in np.flatnonzero(weights):
        if held and held + weights[at] > budget:
            starts.append(at)
            held = 0
        held += int(weights[at])
    return np.array(starts, dtype=np.uint64) << np.uint64(64 - bits)


# Suffixes to groups, and counts from their leaves


def _numbered(names: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Numbers of the names: 0 for 0, the place in ``common`` from 1, or -1."""
    order = np.argsort(common)
    place = np.minimum(np.searchsorted(common[order], names), max(0, len(common) - 1))
    found = order[place] + 1 if len(common) else np.zeros(len(names), dtype=np.int64)
    same = common[found - 1] == names if len(common) else np.zeros(len(names), dtype=bool)
    return np.where(names == 0, 0, np.where(same, found, -1))


def _packed(names: np.ndarray, numbers: np.ndarray, common: int, rows: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> bytes:
    """Rows as numbers, by column and byte, frequent words having small ones, so that they compress well. Names without a number get those above ``common``."""
    ids = numbers[rows]
    own = ids < 0
    used, local = np.unique(rows[own], return_inverse=True)
    ids[own] = local + common + 1
    wide = 2 if len(used) + common < 1 << 16 else 4
    planes = np.ascontiguousarray(ids.T).astype(f"<u{wide}")[..., None].view("u1")
    head = np.array([len(used), *rows.shape], dtype="<i8")
    parts = [head, names[used].astype("<u8"), np.moveaxis(planes, 2, 0), counts.astype("<i8")[:, None].view("u1").T, lengths.astype("u1")]
    data = b"".join(p.tobytes() for p in parts)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(own names, rows of numbers, counts, lengths)``."""
    data = pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    count, height, width = np.frombuffer(data, dtype="<i8", count=3).tolist()
    wide, at = 2 if count + len(common) < 1 << 16 else 4, 24 + 8 * count

    def planes(size: int, *shape: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, dtype="u1", count=size * int(np.prod(shape)), offset=at).reshape(size, *shape)
        at += found.nbytes
        return np.ascontiguousarray(np.moveaxis(found, 0, -1))

    rows = planes(wide, width, height).view(f"<u{wide}")[..., 0].T
    counts = planes(8, height).view("<i8")[:, 0]
    return np.frombuffer(data, dtype="<u8", count=count, offset=24), rows, counts, planes(1, height)[:, 0]


def _gathered(blobs: list[bytes], common: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(names, rows, counts, lengths)`` of several blobs together; name 0 is 0."""
    parts = [_unpacked(blob, common) for blob in blobs]
    own = np.unique(np.concatenate([p[0] for p in parts]))
    first = len(common) + 1
    rows = []
    for names, numbers, _, _ in parts:
        number = np.concatenate((np.arange(first), first + np.searchsorted(own, names))).astype(np.int32)
        rows.append(number[numbers])
    return np.concatenate((np.zeros(1, np.uint64), common, own)), np.concatenate(rows), *(np.concatenate([p[k] for p in parts]) for k in (2, 3))


def _subtree(names: np.ndarray, rows: np.ndarray, counts: np.ndarray, lengths: np.ndarray, least: int) -> tuple[list[list[int]], list[int]]:
    """Phrases of at least two words and of the length of their prefix that occur ``least`` times or more, with their counts."""
    order = np.lexsort(rows.T[::-1])
    rows, counts, lengths = rows[order], counts[order], lengths[order]
    phrases, totals = [], []
    new = np.zeros(len(rows), dtype=bool)
    new[:1] = True
    for k in range(rows.shape[1]):
        new[1:] |= rows[1:, k] != rows[:-1, k]
        starts = np.flatnonzero(new)
        total = np.add.reduceat(counts, starts)
        keep = (total >= least) & (rows[starts, k] != 0) & (lengths[starts] <= k + 1)
        if k and keep.any():
            phrases += names[rows[starts[keep], : k + 1]].view(np.int64).tolist()
            totals += total[keep].tolist()
    return phrases, totals


def _above(names: np.ndarray, rows: np.ndarray, counts: np.ndarray, length: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The split part of suffixes with two split words or more, in distinct rows, and their counts."""
    deep = np.where(length > 0, length - 1, longest)
    some = deep >= 2
    cut = np.where(np.arange(rows.shape[1]) < deep[some, None], rows[some], 0)
    return _distinct(cut, counts[some])


def count_phrases(docs: DataFrame, longest: int = 5, least: int = 100, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """``(phrase, n)`` of all phrases of 2 to ``longest`` words that occur ``least`` times in a language, words being named by numbers, and
    ``(sym, lang, word, n)`` of all words. Both are stored as tables."""
    counted, seed = _named_words(docs)
    often = counted.filter(F.col("n") >= least)
    common, rows = _most_frequent(often, _COMMON)
    frequent = docs.sparkSession.sparkContext.broadcast(Bitmap.of(often, rows))  # one copy for all jobs
    split, leaves, rest = _split(docs, often, frequent, seed, longest, budget)
    bounds = _bounds(leaves, rest, budget)

    def spread(batches):
        for symbols in _symbols(batches, frequent.value, seed, _GATHERED):
            names, rows, counts = _suffixes(symbols, longest)
            numbers = _numbered(names, common)
            key, length = _prefix_keys(names, rows, split)
            group = np.where(length > 0, np.searchsorted(bounds, key, side="right"), 0)
            parts = [(rows, counts, length, group)]
            if len(split):
                cut, sums = _above(names, rows, counts, length, longest)
                pair = _extended(names[cut[:, 0]], names[cut[:, 1]]) % np.uint64(len(bounds))
                parts.append((cut, sums, np.ones(len(cut), dtype=np.int64), -1 - pair.astype(np.int64)))
            groups, blobs = [], []
            for rows, counts, length, group in parts:
                order = np.argsort(group, kind="stable")
                edges = np.flatnonzero(np.diff(group[order], prepend=0, append=len(bounds) + 2))
                for at in (order[a:b] for a, b in zip(edges, edges[1:])):
                    groups.append(int(group[at[0]]))
                    blobs.append(_packed(names, numbers, len(common), rows[at], counts[at], length[at]))
            yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array(blobs, pa.binary())], names=["group", "blob"])

    def grow(table: pa.Table) -> pa.Table:
        phrases, totals = _subtree(*_gathered([b.as_py() for b in table.column("blob")], common), least)
        return pa.table({"phrase": pa.array(phrases, pa.list_(pa.int64())), "n": pa.array(totals, pa.int64())})

    found = _rows(docs).mapInArrow(spread, "group long, blob binary").groupBy("group").applyInArrow(grow, "phrase array<long>, n long")
    phrases = materialize(found, "phrases")
    frequent.destroy()
    return phrases, counted


def score(phrases: DataFrame, counted: DataFrame, factor: int = 1000) -> DataFrame:
    """``(phrase, sym, a, l, r, n, score)`` of every phrase, by its weakest cut; ``sym`` names its first word."""
    size = F.size("phrase")
    singles = counted.join(phrases.select(F.explode("phrase").alias("sym")).distinct(), "sym", "left_semi").select(F.array("sym").alias("phrase"), "n")
    parts = phrases.select("phrase", "n").unionByName(singles)
    cuts = phrases.select("phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("phrase", "a", "k", F.slice("phrase", F.lit(1), F.col("k")).alias("left"), F.slice("phrase", F.col("k") + 1, size - F.col("k")).alias("right"))
    cuts = cuts.join(parts.select(F.col("phrase").alias("left"), F.col("n").alias("l")), "left").join(parts.select(F.col("phrase").alias("right"), F.col("n").alias("r")), "right")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    langs = counted.select("sym", "lang")
    first = phrases.select(F.element_at("phrase", 1).alias("sym")).distinct().join(langs, "sym").join(totals, "lang")
    cuts = cuts.withColumn("sym", F.element_at("phrase", 1)).join(first, "sym")

    # 38 digits hold the products of counts up to 10 ** 17 with the factor; a wider result would fail in ANSI mode.
    value = F.expr(f"(cast(a as decimal(19,0)) * cast(total as decimal(19,0)) * cast({factor} as decimal(10,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cuts.withColumn("score", value).groupBy("phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "total", "lang")).alias("x"))
    return best.select("phrase", "x.lang", "x.a", "x.l", "x.r", F.col("x.total").alias("n"), "x.score")


def _maximal(scored: DataFrame, percent: int) -> DataFrame:
    """Phrases that no longer phrase covers. Counts shrink with length, so phrases longer by one word decide."""
    size = F.size("phrase")
    inner = F.array(F.slice("phrase", F.lit(1), size - 1), F.slice("phrase", F.lit(2), size - 1))
    covered = scored.filter(size > 2).select(F.explode(inner).alias("phrase"), "a").groupBy("phrase").agg(F.max("a").alias("_longer"))
    joined = scored.join(covered, "phrase", "left")
    return joined.filter(F.col("_longer").isNull() | (F.col("_longer") * 100 < F.col("a") * percent)).drop("_longer")


def spelled(phrases: DataFrame, counted: DataFrame) -> DataFrame:
    """``phrases`` with their words, separated by spaces, in place of the names."""
    places = phrases.select("phrase", F.posexplode("phrase").alias("at", "sym"))
    text = places.join(counted.select("sym", "word"), "sym").groupBy("phrase").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("x"))
    joined = phrases.join(text, "phrase")
    return joined.withColumn("phrase", F.array_join(F.col("x.word"), " ")).drop("x")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000, factor: int = 1000, percent: int = 100, budget: int = BUDGET) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language by score, count, and phrase."""
    phrases, counted = count_phrases(docs, longest, least, budget)
    scored = materialize(score(phrases, counted, factor), "scored-phrases")
    found = spelled(_maximal(scored, percent), counted)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
