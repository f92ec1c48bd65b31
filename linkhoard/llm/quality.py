"""Quality score: learned vectors of hashed words and character n-grams, averaged, with softmax output.

A text is the mean of the vectors of its white-space separated words and of the n-grams of 3 and 4
characters of each word with its borders, case kept, and of three marks for a word that repeats one of the
three words before it. Vectors and output layer are learned together by stochastic gradient descent in numpy,
on a sample of at most about ``max_rows`` labelled rows, dealt once to a few shards of about ``rows_per_shard``. The
shards' vectors are put side by side and their outputs averaged, so a model has ``2 ** bits`` vectors of at most
``size * max_rows / rows_per_shard`` numbers, whatever the corpus.

Since the mean is linear, a vector counts for a score only by its product with the output layer. Scoring
therefore looks up one number per n-gram, in one pass over the documents without a shuffle.

NULL, empty and white-space texts have no vector and get the softmax of the output biases. Without usable labels
every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base, grams

#: An n-gram takes some dozens of bytes while it is hashed, so less text is worked on at once than elsewhere.
_CHUNK = base.CHUNK_BYTES // 4
_SIZES = (3, 4)
#: A word that repeats the word so many places before is also an n-gram of its own, whatever the word.
_GAPS = (1, 2, 3)
_SPACE = np.zeros(1 << 16, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, *range(0x2000, 0x200B)]] = True


@dataclass(frozen=True)
class Settings:
    bits: int = 16
    size: int = 12
    max_rows: int = 12_000
    rows_per_shard: int = 4_000
    rounds: int = 6
    rate: float = 1.0
    seed: int = 11


@dataclass
class Model:
    """``vectors`` of the hashed n-grams, ``output`` (2 rows) and ``bias`` (2) of the softmax."""

    bits: int
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def effects(self) -> np.ndarray:
        """What each n-gram adds to the logit of label 1, before the mean."""
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float32)


def features(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, feature)`` of every word and character n-gram, repeats included."""
    pieces = [(k, piece) for k, text in enumerate(texts) for piece in base.cut(text, _CHUNK)]
    owner = np.array([k for k, _ in pieces], dtype=np.int64)
    symbols = np.frombuffer((" " + " ".join(piece for _, piece in pieces) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(piece) + 1 for _, piece in pieces])
    space = _SPACE[np.minimum(symbols, 0xFFFF)]
    symbols = np.where(space, np.uint32(32), symbols)
    sums = grams.running(symbols)
    starts, stops = grams.word_edges(~space)
    found, places = [grams.buckets(grams.spans(sums, starts, stops), bits, 1)], [starts]
    words = grams.spans(sums, starts, stops)
    texts_of = owner[np.searchsorted(ends, starts - 1, side="right")]
    for gap in _GAPS:
        again = np.flatnonzero((words[gap:] == words[:-gap]) & (texts_of[gap:] == texts_of[:-gap])) + gap
        found.append(np.full(len(again), gap))
        places.append(starts[again])
    inner = np.concatenate(([0], np.cumsum(space)))
    for n in _SIZES:
        hashed = grams.windows(sums, n)
        place = np.arange(len(hashed))
        whole = inner[place + n - 1] == inner[place + 1]
        found.append(grams.buckets(hashed[whole], bits, n))
        places.append(place[whole] + 1)
    return owner[np.searchsorted(ends, np.concatenate(places) - 1, side="right")], np.concatenate(found)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max())
    return e / e.sum()


def _pass(labels: list[int], examples: list[tuple[np.ndarray, np.ndarray]], vectors, output, bias, rate: float) -> None:
    """One pass over the rows, changing the parameters in place."""
    for label, (index, share) in zip(labels, examples):
        mine = vectors[index]
        hidden = share @ mine
        error = _softmax(output @ hidden + bias)
        error[int(label)] -= 1
        back = error @ output
        output -= rate * np.outer(error, hidden)
        bias -= 0.1 * rate * error
        # The gradient of a vector is its share of the mean; sqrt keeps rare n-grams of long texts learning.
        vectors[index] = mine - rate * np.sqrt(share)[:, None] * back


def _examples(texts: list[str], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct features of each text, and their shares of its mean."""
    out = []
    for chunk in base.chunks(texts, _CHUNK):
        owner, feature = features(chunk, bits)
        keys, counts = np.unique(owner << bits | feature, return_counts=True)
        bounds = np.searchsorted(keys >> bits, np.arange(len(chunk) + 1))
        values = (keys & (1 << bits) - 1).astype(np.int32)
        out += [(values[a:b], (counts[a:b] / max(1, counts[a:b].sum())).astype(np.float32)) for a, b in zip(bounds, bounds[1:])]
    return out


def _start(s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.random.default_rng(s.seed).uniform(-1 / s.size, 1 / s.size, (1 << s.bits, s.size)).astype(np.float32)
    return vectors, np.zeros((2, s.size), np.float32), np.zeros(2, np.float32)


def _fit(rows: pd.DataFrame, s: Settings) -> pd.DataFrame:
    """The parameters of one shard."""
    base.forget()
    rows = rows.sort_values("pick", kind="stable")
    examples = _examples(rows["text"].tolist(), s.bits)
    vectors, output, bias = _start(s)
    for turn in range(s.rounds):
        _pass(rows["label"].tolist(), examples, vectors, output, bias, s.rate * (1 - turn / s.rounds))
    return pd.DataFrame({"vectors": [vectors.tobytes()], "output": [output.tobytes()], "bias": [bias.tobytes()]})


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of the labelled rows; see the module docstring."""
    s = settings
    sample, rows = base.labelled_sample(docs, labels, label, s.max_rows)
    if not rows:
        return Model(s.bits, *_start(s))
    shard = F.xxhash64("pick") % max(1, round(rows / s.rows_per_shard))
    fitted = sample.groupBy(shard).applyInPandas(lambda part: _fit(part, s), "vectors binary, output binary, bias binary").collect()
    if not fitted:
        return Model(s.bits, *_start(s))
    parts = [[np.frombuffer(r[k], dtype=np.float32) for r in fitted] for k in ("vectors", "output", "bias")]
    vectors = np.hstack([v.reshape(-1, s.size) for v in parts[0]])
    output = np.hstack([o.reshape(2, s.size) for o in parts[1]]) / len(fitted)
    return Model(s.bits, vectors, output, np.mean(parts[2], axis=0))


def score_texts(texts: list[str], bits: int, effects: np.ndarray, shift: float) -> np.ndarray:
    owner, feature = features(texts, bits)
    total = np.bincount(owner, effects[feature], minlength=len(texts))
    count = np.bincount(owner, minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + shift, -35, 35)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row of ``docs``, from ``text`` alone; score is that of label 1."""
    bits, effects, shift = model.bits, model.effects(), float(model.bias[1] - model.bias[0])

    def scored(batches):
        for batch in batches:
            values = [score_texts(chunk, bits, effects, shift) for chunk in base.chunks(batch["text"], _CHUNK)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": np.concatenate(values or [np.zeros(0)])})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(scored, "doc_id long, score double")


def filter_documents(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns kept."""
    bits, effects, shift = model.bits, model.effects(), float(model.bias[1] - model.bias[0])

    at = docs.columns.index("text")

    def kept(batches):
        base.forget()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            values = [score_texts(chunk, bits, effects, shift) for chunk in base.chunks(texts, _CHUNK)]
            yield batch.filter(pa.array(np.concatenate(values or [np.zeros(0)]) >= threshold))

    return docs.mapInArrow(kept, docs.schema)
