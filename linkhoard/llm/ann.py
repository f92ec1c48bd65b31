"""Approximate nearest neighbours by learned partitions of a neighbour graph.

1. Fit, on a sample of at most about ``sample_rows`` vectors: the graph of each vector's nearest neighbours in the sample is cut
   into parts of equal size with few edges between them (recursive bisection with swaps that lower the cut), and a small neural
   network learns, from a vector alone, how its neighbours spread over the parts.
2. Index: the network puts every row into its most probable part; the index is a stored table.
3. Search: the network routes each query to its most probable parts, as many as reach ``recall`` on queries held
   back from the sample (and hold enough candidates), and all rows of those parts are ranked exactly.

The number of parts grows with the square root of the rows up to ``most_parts``. Parts are cut into blocks of about ``block``
rows and queries into groups, so that a task compares one bounded block with one bounded group, however large a part
is and however many equal vectors it has. Nearness is the cosine in double precision on the original vectors; ties go to
the smaller vec_id.

Vectors that are NULL, empty, zero or hold NULL or non-finite numbers take no part, nor do rows without vec_id and vectors of
another length than the commonest. Rows with one vec_id are one candidate, the nearest of them, and never candidates of a query of that id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 8_192
    neighbours: int = 10
    most_parts: int = 128
    hidden: int = 128
    epochs: int = 30
    recall: float = 0.95
    held_back: int = 1_024
    block: int = 4_096
    seed: int = 5


@dataclass
class Model:
    """The network: ``parts`` from vectors, and how many parts a query is routed to."""

    weights: list[np.ndarray]
    probes: int

    @property
    def parts(self) -> int:
        return len(self.weights[3])

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        return _forward(self.weights, _unit(vectors))[1]


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps squares of very large and very small numbers finite.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _forward(weights: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, d = weights
    hidden = np.maximum(x @ a + b, 0)
    logits = hidden @ c + d
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return hidden, e / e.sum(axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest rows of each row, by blocks."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), dtype=np.int64)
    for at in range(0, len(x), 1024):
        near = x[at : at + 1024] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at : at + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Part of each row: bisections along a main direction, then swaps of rows that have more neighbours on the other side."""
    part = np.zeros(len(x), dtype=np.int64)
    ends = np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()
    for _ in range(int(math.log2(parts))):
        new = part * 2
        for p in np.unique(part):
            rows = np.flatnonzero(part == p)
            place = np.full(len(x), -1)
            place[rows] = np.arange(len(rows))
            inside = (place[ends[0]] >= 0) & (place[ends[1]] >= 0)
            a, b = place[ends[0][inside]], place[ends[1][inside]]
            centred = x[rows] - x[rows].mean(axis=0)
            direction = rng.normal(size=x.shape[1])
            for _ in range(10):
                direction = centred.T @ (centred @ direction)
                direction /= np.linalg.norm(direction) or 1
            side = np.zeros(len(rows), dtype=np.int64)
            side[np.argsort(centred @ direction, kind="stable")[len(rows) // 2 :]] = 1
            cut = (side[a] != side[b]).sum()
            for _ in range(40):
                crossing = np.where(side[a] != side[b], 1, -1)
                gain = np.bincount(a, crossing, len(rows)) + np.bincount(b, crossing, len(rows))
                left, right = (np.flatnonzero(side == s) for s in (0, 1))
                left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
                n = min(len(left), len(right))
                good = int((gain[left[:n]] + gain[right[:n]] > 0).sum())
                moved = side.copy()
                take = max(1, good // 2)  # neighbours that move together would spoil each other's gain
                if not good:
                    break
                moved[left[:take]], moved[right[:take]] = 1, 0
                now = (moved[a] != moved[b]).sum()
                if now >= cut:
                    break
                side, cut = moved, now
            new[rows] += side
        part = new
    return part


def fit(vectors: np.ndarray, total: int, s: Settings = Settings()) -> Model:
    """Fit on the vectors of a sample of ``total`` rows."""
    rng = np.random.default_rng(s.seed)
    x = _unit(vectors)
    parts = 2 ** max(0, min(int(math.log2(max(1.0, math.sqrt(total) / 8))), int(math.log2(s.most_parts)), int(math.log2(max(1.0, len(x) / 64)))))
    size = x.shape[1]
    if parts == 1:
        return Model([np.zeros((size, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1)
    graph = neighbour_graph(x, s.neighbours)
    part = balanced_parts(x, graph, parts, rng)
    # A row's target is how it and its neighbours spread over the parts.
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0)
    target[np.arange(len(x)), part] += 1
    target /= target.sum(axis=1, keepdims=True)
    back = rng.permutation(len(x))
    held, learned = back[: min(s.held_back, len(x) // 5)], back[min(s.held_back, len(x) // 5) :]
    weights = [rng.normal(0, math.sqrt(2 / size), (size, s.hidden)), np.zeros(s.hidden), rng.normal(0, math.sqrt(1 / s.hidden), (s.hidden, parts)), np.zeros(parts)]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    step = 0
    for _ in range(s.epochs):
        order = rng.permutation(learned)
        for at in range(0, len(order), 256):
            rows = order[at : at + 256]
            hidden, p = _forward(weights, x[rows])
            error = (p - target[rows]) / len(rows)
            back_error = error @ weights[2].T * (hidden > 0)
            step += 1
            for w, m, g in zip(weights, moments, (x[rows].T @ back_error, back_error.sum(axis=0), hidden.T @ error, error.sum(axis=0))):
                m[0] += 0.1 * (g - m[0])
                m[1] += 0.001 * (g * g - m[1])
                w -= 0.003 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    # Rows are found where the network puts them, so recall is measured on its own parts.
    placed = _forward(weights, x)[1].argmax(axis=1)
    ranked = np.argsort(-_forward(weights, x[held])[1], axis=1, kind="stable")
    rank_of = np.argsort(ranked, axis=1)
    reached = rank_of[np.arange(len(held))[:, None], placed[graph[held]]]
    share = np.array([(reached < p).mean() for p in range(1, parts + 1)])
    return Model(weights, int(np.argmax(share >= s.recall)) + 1 if share[-1] >= s.recall else parts)


def usable(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """``(vec_id, vec)`` of the rows that take part."""
    vec = F.col(column).cast("array<double>")
    finite = ~F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col(column).isNotNull() & finite & F.exists(vec, lambda v: v != 0)
    )
    common = rows.groupBy(F.size("vec").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    return rows.filter(F.size("vec") == (common[0]["length"] if common else 0))


def train(rows: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Fit on the rows with the smallest hashes, a bounded sample, in one task."""
    s = settings
    total = rows.count()
    if not total:
        return None
    pick = F.pmod(F.xxhash64(F.lit(s.seed), "vec_id"), F.lit(1 << 30))
    sample = rows.filter(pick < math.ceil(min(1.0, s.sample_rows / total) * (1 << 30)))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        vectors = np.array(part.sort_values("vec_id", kind="stable")["vec"].tolist(), dtype=np.float64)
        model = fit(vectors, total, s)
        return pd.DataFrame({"weights": [[w.tobytes() for w in model.weights]], "shapes": [[list(w.shape) for w in model.weights]], "probes": [model.probes]})

    found = sample.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(run, "weights array<binary>, shapes array<array<int>>, probes int").collect()
    if not found:  # very few rows, none of them picked
        return train_trivial(rows)
    weights = [np.frombuffer(bytes(w), dtype=np.float64).reshape(tuple(shape)) for w, shape in zip(found[0]["weights"], found[0]["shapes"])]
    return Model(weights, found[0]["probes"])


def train_trivial(rows: DataFrame) -> Model:
    """One part for everything."""
    size = rows.select(F.size("vec")).first()[0]
    return Model([np.zeros((size, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1)


def _routed(rows: DataFrame, model: Model, probes: Column | int, counts: list[int] | None, needed: int) -> DataFrame:
    """``(vec_id, vec, part)``: with the most probable parts of each row, ``probes`` of them or as many as hold ``needed`` rows."""

    def run(batches):
        sizes = None if counts is None else np.array(counts)
        for batch in batches:
            if not len(batch):
                continue
            p = model.probabilities(np.array(batch["vec"].tolist(), dtype=np.float64))
            order = np.argsort(-p, axis=1, kind="stable")
            taken = np.full(len(batch), probes)
            if sizes is not None:
                short = (np.cumsum(sizes[order], axis=1) < needed).sum(axis=1) + 1
                taken = np.minimum(np.maximum(taken, short), model.parts)
            row = np.repeat(np.arange(len(batch)), taken)
            rank = np.arange(len(row)) - np.repeat(np.cumsum(taken) - taken, taken)
            yield pd.DataFrame({"vec_id": batch["vec_id"].to_numpy()[row], "vec": batch["vec"].to_numpy()[row], "part": order[row, rank].astype(np.int32)})

    return rows.mapInPandas(run, "vec_id long, vec array<double>, part int")


def index(rows: DataFrame, model: Model) -> DataFrame:
    """Every row with its part, as a stored table."""
    return materialize(_routed(rows, model, 1, None, 0), "vector-index")


def _compare(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        q, r = (np.array(x["vec"].tolist(), dtype=np.float64) for x in (left, right))
        q, r = _unit(q), _unit(r)
        query_ids, row_ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        # Rows that repeat an id must not crowd out others.
        out, most = [], min(k, len(r)) if len(np.unique(row_ids)) == len(row_ids) else len(r)
        near = q @ r.T
        near[query_ids[:, None] == row_ids] = -np.inf
        best = np.partition(near, -most, axis=1)[:, -most]
        for i, least in enumerate(best):
            # The product of matrices rounds differently from place to place; scores are summed alike for every pair.
            some = np.flatnonzero((near[i] >= least - 1e-9) & (near[i] > -np.inf))
            score = (q[i] * r[some]).sum(axis=1)
            ids, at = _distinct(row_ids[some], score)
            order = np.lexsort((ids, -score[at]))[:k]
            out.append(pd.DataFrame({"query_id": query_ids[i], "vec_id": ids[order], "score": score[at][order]}))
        return pd.concat(out)[names]

    return run


def _distinct(ids: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id once, where its score is largest."""
    order = np.lexsort((-score, ids))
    first = np.ones(len(order), dtype=bool)
    first[1:] = np.diff(ids[order]) != 0
    return ids[order][first], order[first]


def search(indexed: DataFrame, queries: DataFrame, model: Model, k: int = 5, settings: Settings = Settings()) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each row ``(vec_id, vec)`` of ``queries``, but itself."""
    s = settings
    counts = [0] * model.parts
    for row in indexed.groupBy("part").count().collect():  # one row per part
        counts[row["part"]] = row["count"]
    routed = materialize(_routed(queries, model, model.probes, counts, k + 1), "routed-queries")
    asked = [0] * model.parts
    for row in routed.groupBy("part").count().collect():
        asked[row["part"]] = row["count"]
    blocks = F.element_at(F.array(*[F.lit(max(1, -(-n // s.block))) for n in counts]), F.col("part") + 1)
    groups = F.element_at(F.array(*[F.lit(max(1, -(-n // s.block))) for n in asked]), F.col("part") + 1)
    rows = indexed.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), blocks)).withColumn("group", F.explode(F.sequence(F.lit(0), groups - 1)))
    wanted = routed.withColumn("group", F.pmod(F.xxhash64(F.lit(2), "vec_id"), groups).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)))
    keys = ["part", "block", "group"]
    found = wanted.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(_compare(k), "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # At most k rows of each block compared with a query: sorted as one array of bounded size.
    best = once.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k).alias("near"))
    return best.select("query_id", F.posexplode("near").alias("rank", "x")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.far")).alias("score"))


def nearest(embeddings: DataFrame, every: int = 50, k: int = 5, settings: Settings = Settings()) -> DataFrame:
    """``search`` for the rows whose vec_id is divisible by ``every``, among all rows."""
    rows = usable(embeddings)
    model = train(rows, settings)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    indexed = index(rows, model)
    return search(indexed, indexed.filter(F.col("vec_id") % every == 0).select("vec_id", "vec"), model, k, settings)
