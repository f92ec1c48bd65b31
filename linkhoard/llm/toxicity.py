"""Toxicity score: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features of a text are the distinct hashed word unigrams, bigrams and skip-grams (one or two words left out)
of the whole text, lower-cased. FTRL-proximal keeps a learning rate per coordinate and an L1 penalty that
leaves most weights exactly zero, so that the model sent to the scoring tasks is a short list of weights.

Training runs on a sample of at most about ``max_rows`` labelled rows, dealt once to a few shards of about
``rows_per_shard``. Every shard goes several times over its rows in one task and returns its nonzero weights, at most
``2 ** bits`` whatever the corpus; the model is their mean. Scoring is one pass over the documents without a shuffle.

NULL and empty texts have no features and get the score of the intercept. A text without any feature of
nonzero weight gets the same. Without usable labels every score is 0.5 and every prediction 1.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base, grams

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_PIECE = 1 << 20


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    max_rows: int = 24_000
    rows_per_shard: int = 6_000
    rounds: int = 6
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1


@dataclass
class Model:
    """Nonzero weights by feature, and the intercept."""

    bits: int = 18
    indices: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    intercept: float = 0.0


def features(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, feature)`` of every word n-gram, repeats included."""
    pieces = [(k, piece) for k, text in enumerate(texts) for piece in base.cut(text.lower(), _PIECE, overlap=3)]
    blobs = [piece.encode() for _, piece in pieces]
    owner = np.array([k for k, _ in pieces], dtype=np.int64)
    ends = np.cumsum([len(b) + 1 for b in blobs])
    data = np.frombuffer(b"\n".join(blobs) + b"\n", dtype=np.uint8)
    starts, stops = grams.word_edges(_WORD[data])
    words = grams.mix(grams.spans(grams.running(data), starts, stops))
    piece_of = np.searchsorted(ends, starts, side="right")
    found, owners = [grams.buckets(words, bits, 1)], [piece_of]
    for salt, gap in ((2, 1), (3, 2), (4, 3)):
        same = piece_of[gap:] == piece_of[:-gap]
        pairs = words[:-gap] * np.uint64(3) + grams.mix(words[gap:], 7)
        found.append(grams.buckets(pairs[same], bits, salt))
        owners.append(piece_of[gap:][same])
    return owner[np.concatenate(owners)], np.concatenate(found)


def _weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    shrunk = np.sign(z) * s.l1 - z
    return np.where(np.abs(z) <= s.l1, 0, shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _pass(labels: list[int], examples: list[np.ndarray], z: np.ndarray, n: np.ndarray, s: Settings) -> None:
    """One pass over the rows; the last coordinate is the intercept, which is not penalised."""
    top = len(z) - 1
    for label, index in zip(labels, examples):
        zi, ni = z[index], n[index]
        w = _weights(zi, ni, s)
        bias = -z[top] / ((s.beta + np.sqrt(n[top])) / s.alpha)
        g = _sigmoid(w.sum() + bias) - label
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / s.alpha
        z[index] = zi + g - sigma * w
        n[index] = ni + g * g
        z[top] += g - (np.sqrt(n[top] + g * g) - np.sqrt(n[top])) / s.alpha * bias
        n[top] += g * g


def _examples(texts: list[str], bits: int) -> list[np.ndarray]:
    """The distinct features of each text."""
    out = []
    for chunk in base.chunks(texts):
        owner, feature = features(chunk, bits)
        keys = np.unique(owner << bits | feature)
        bounds = np.searchsorted(keys >> bits, np.arange(len(chunk) + 1))
        values = (keys & (1 << bits) - 1).astype(np.int32)
        out += [values[a:b] for a, b in zip(bounds, bounds[1:])]
    return out


def _fit(rows: pd.DataFrame, s: Settings) -> pd.DataFrame:
    """The weights of one shard."""
    rows = rows.sort_values("pick", kind="stable")
    examples = _examples(rows["text"].tolist(), s.bits)
    z = np.zeros((1 << s.bits) + 1)
    n = np.zeros_like(z)
    for _ in range(s.rounds):
        _pass(rows["label"].tolist(), examples, z, n, s)
    weights = _weights(z[:-1], n[:-1], s).astype(np.float32)
    kept = np.flatnonzero(weights).astype(np.int32)
    intercept = -z[-1] / ((s.beta + np.sqrt(n[-1])) / s.alpha)
    return pd.DataFrame({"indices": [kept.tobytes()], "weights": [weights[kept].tobytes()], "intercept": [intercept]})


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of the labelled rows; see the module docstring."""
    s = settings
    sample, rows = base.labelled_sample(docs, labels, label, s.max_rows)
    if not rows:
        return Model(bits=s.bits)
    shard = F.xxhash64("pick") % max(1, round(rows / s.rows_per_shard))
    fitted = sample.groupBy(shard).applyInPandas(lambda part: _fit(part, s), "indices binary, weights binary, intercept double").collect()
    if not fitted:  # no labelled id has a document
        return Model(bits=s.bits)
    mean = np.zeros(1 << s.bits)
    for row in fitted:
        mean[np.frombuffer(row["indices"], dtype=np.int32)] += np.frombuffer(row["weights"], dtype=np.float32) / len(fitted)
    kept = np.flatnonzero(mean).astype(np.int32)
    return Model(s.bits, kept, mean[kept].astype(np.float32), float(np.mean([r["intercept"] for r in fitted])))


def score_texts(texts: list[str], model: Model, table: np.ndarray) -> np.ndarray:
    owner, feature = features(texts, model.bits)
    weighted = table[feature] != 0
    keys = np.unique(owner[weighted] << model.bits | feature[weighted])
    logits = np.bincount(keys >> model.bits, table[keys & (1 << model.bits) - 1], minlength=len(texts))
    return _sigmoid(logits + model.intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row of ``docs``, from ``text`` alone."""

    def scored(batches):
        table = np.zeros(1 << model.bits, dtype=np.float32)
        table[model.indices] = model.weights
        for batch in batches:
            values = [score_texts(chunk, model, table) for chunk in base.chunks(batch["text"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": np.concatenate(values or [np.zeros(0)])})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(scored, "doc_id long, score double")
