"""Helpers shared by the operators: tables, folds and bounded batches of texts."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task works on at once.
CHUNK_BYTES = 2 << 20
FOLDS = 5


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer, the same on all machines of a cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the rows whose labels are never learned from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> tuple[DataFrame, int]:
    """``(text, label, pick)`` of about ``max_rows`` labelled rows outside the held-out fold, and their number.

    The rows are those with the smallest hashes of their id, so they do not depend on the partitioning.
    Ids with a NULL label are left out; of contradicting labels the larger one counts. ``pick`` is a
    random order. Only the sampled ids, whose number has a bound, are sent to the tasks that read texts.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    total = known.count()
    pick = F.pmod(F.xxhash64(F.lit(label), "doc_id"), F.lit(1 << 30))
    picked = known.withColumn("pick", pick)
    if total > max_rows:
        picked = picked.filter(F.col("pick") < int(max_rows / total * (1 << 30)))
    chosen = F.broadcast(picked) if max_rows <= 100_000 else picked
    return docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "label", "pick"), min(total, max_rows)


#: What a worker keeps from task to task, by name; of one operator at a time.
_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]):
    """What ``make`` gave when a task of this worker last asked for ``name``, or gives now in place of what was kept before."""
    if name not in _KEPT:
        forget()
        _KEPT[name] = make()
    return _KEPT[name]


def forget() -> None:
    """Let go of what the worker keeps. Operators call it in tasks that keep nothing: in a job of several operators, workers would else hold the models
    and words of all of them."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


class Known:
    """What is known of words, in two generations: words met again move to the recent one, the others are forgotten.

    It holds twice ``limit`` words at most, besides those of the texts at hand.
    """

    def __init__(self, limit: int):
        self.limit, self.recent, self.older = limit, {}, {}

    def learn(self, words: set[str], find: Callable[[set[str]], Iterable[tuple[str, bytes]]]) -> None:
        """Bring all ``words`` into the recent generation; ``find`` works out those met for the first time."""
        missing = words - self.recent.keys()
        again = missing & self.older.keys()
        self.recent.update(zip(again, map(self.older.__getitem__, again)))
        self.recent.update(find(missing - again))

    def age(self) -> None:
        if len(self.recent) > self.limit:
            self.recent, self.older = {}, self.recent


def chunks(texts: Iterable[str | None], limit: int = CHUNK_BYTES) -> Iterator[list[str]]:
    """Consecutive texts of at most ``limit`` characters together (or one longer text); NULL is empty."""
    chunk, size = [], 0
    for text in texts:
        text = text or ""
        if chunk and size + len(text) > limit:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text) + 1
    if chunk:
        yield chunk


_GAP = re.compile(r"[\t-\r ]")


def cut(text: str, limit: int, overlap: int = 0) -> list[str]:
    """Pieces of a long text of about ``limit`` characters, cut at ASCII white space only, so that no word is divided; each begins
    with the last ``overlap`` words of the one before. A longer run without white space stays whole."""
    if len(text) <= limit:
        return [text]
    pieces, at = [], 0
    while at < len(text):
        gap = _GAP.search(text, at + limit)
        end = gap.start() if gap else len(text)
        begin = at
        for _ in range(overlap if at else 0):
            while begin > 0 and _GAP.match(text[begin - 1]):
                begin -= 1
            while begin > 0 and not _GAP.match(text[begin - 1]):
                begin -= 1
        pieces.append(text[begin:end])
        at = end
    return pieces
