"""Mixing sources to target weights by fitting budgets of words.

Sources in the order of their code points (NULL last) weigh ``weights``, repeating. Together they get ``share`` times the
words of all documents; a source gets at most ``most`` times its own words, and what that leaves over is dealt to the others
by weight until none is above. The size of a document is its number of words, NULL being empty.

1. Documents are counted by exact size within each source: a histogram, combined before it is shuffled.
2. A target is some whole copies of the source and a budget for a part of it. The budget is first filled with the same
   share of every size, rounded down. What remains is fitted by bounded-knapsack dynamic programming over the sizes that are
   left: the sum nearest to the budget, as far as one exists. A task holds the histogram of one source and one number per
   word of the remaining budget, never its documents.
3. Of each size the number found is picked by a seeded hash of the document. A group of equal sizes is cut into buckets of the
   hash; whole buckets are taken or left by their counts, and only one bucket per size is ranked.

Every row is a document of its own; rows with equal ids, texts and sources differ at most in who of them is picked. Sources without words have
target 0. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import running_total
from ..sources.tables import is_small, materialize, measure

#: Words of a remaining budget that dynamic programming works on; what is above is filled from the largest size down.
FITTED = 1 << 15
_BUCKETS = 12


def size(text: str | Column) -> Column:
    """Words of a text: runs of characters that aren't ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int, share: float) -> DataFrame:
    """``(source, no, source_size, target)`` from ``(source, source_size)``, one row per source."""
    named, seen = measure(sizes.withColumns({"_all": F.lit(0), "_last": F.col("source").isNull(), "_one": F.lit(1)}), "sources", rows=F.count("*"), total=F.sum("source_size"))
    rows, total = seen["rows"], (seen["total"] or 0) * share
    numbered = running_total(named, "_all", ["_last", "source"], "_one", "no", rows=rows)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("no") % len(weights) + 1).cast("int")).cast("long")
    weighed = numbered.select("source", "source_size", "no", "_all", weight.alias("weight"), (F.col("source_size") * most).alias("cap"))
    weighed = weighed.withColumn("ratio", F.col("cap") / F.col("weight"))
    if not is_small(rows):
        weighed = materialize(weighed, "weighed-sources")
    # In the order of cap / weight, the sources up to some place stop at their caps and the others get one level times their weight.
    ordered = running_total(weighed, "_all", ["ratio", "no"], "cap", "capped", rows=rows)
    ordered = running_total(ordered, "_all", ["ratio", "no"], "weight", "passed", rows=rows)
    whole = weighed.agg(F.sum("weight").alias("w")).first()["w"] or 1
    level = (F.lit(float(total)) - F.col("capped")) / (F.lit(whole) - F.col("passed"))
    found = ordered.withColumn("level", level).filter("ratio >= level").agg(F.min(F.struct("ratio", "no", "level")).alias("x")).first()["x"]
    target = F.col("cap").cast("double")
    if found:
        target = F.least(target, F.col("weight") * F.lit(found["level"]))
    return weighed.select("source", "no", "source_size", target.alias("target"))


def fit(lengths: Iterable[int], counts: Iterable[int], budget: float, fitted: int = FITTED) -> list[int]:
    """How many of each length to take so that their sum comes nearest to ``budget``; lengths are distinct and above 0."""
    lengths, counts = [int(x) for x in lengths], [int(x) for x in counts]
    total = sum(n * c for n, c in zip(lengths, counts))
    whole = min(int(budget), total)
    taken = [c * whole // total for c in counts] if total else [0] * len(counts)
    rest = whole - sum(n * t for n, t in zip(lengths, taken))
    order = sorted(range(len(lengths)), key=lambda k: -lengths[k])
    for k in order:
        more = min(counts[k] - taken[k], max(0, rest - fitted) // lengths[k])
        taken[k] += more
        rest -= more * lengths[k]
    for k, more in _nearest([(k, lengths[k], counts[k] - taken[k]) for k in order if taken[k] < counts[k]], rest + budget - whole):
        taken[k] += more
    return taken


def _nearest(items: list[tuple[int, int, int]], budget: float) -> list[tuple[int, int]]:
    """Bounded knapsack: ``(key, times)`` of the items ``(key, length, most times)`` whose sum is nearest to ``budget``."""
    if not items:
        return []
    goal = round(budget)
    limit = goal + min(goal, max(n for _, n, _ in items)) + 1  # a sum further above is no nearer than none at all, or than one item less
    within = (1 << limit + 1) - 1
    reached, stage = 1, np.full(limit + 1, -1, dtype=np.int32)
    stage[0] = 0
    for number, (_, length, most) in enumerate(items, 1):
        before, left, step = reached, most, 1
        while left and length * step <= limit:  # 1, 2, 4 ... times, so that every number up to the most is a sum of steps
            step = min(step, left)
            reached |= (reached << length * step) & within
            left -= step
            step *= 2
        if fresh := reached & ~before:
            bits = np.frombuffer(fresh.to_bytes((limit >> 3) + 1, "little"), dtype=np.uint8)
            stage[np.flatnonzero(np.unpackbits(bits, bitorder="little", count=limit + 1))] = number
        if reached >> goal & 1:
            break
    sums = np.flatnonzero(stage >= 0)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    out = []
    while at:
        number, times = stage[at], 0
        while stage[at] >= number:
            at -= items[number - 1][1]
            times += 1
        out.append((items[number - 1][0], times))
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, share: float = 1.0, seed: int = 13) -> DataFrame:
    """``(doc_id, source, row, size, source_size, target, copies)`` of every row: ``copies`` times it is in the mix; ``row`` is a hash of the text."""
    picked = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("row"))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("row"), size("text").alias("size"))
    sized = materialize(rows.withColumn("key", picked), "sized-documents")
    aims, seen = measure(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most, share), "targets", rows=F.count("*"))
    aims = aims.withColumnRenamed("source", "_source")
    numbered = sized.join(F.broadcast(aims) if is_small(seen["rows"]) else aims, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    counted = numbered.groupBy("no", "size").agg(F.count("*").alias("rows"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))

    def fitted(part: pd.DataFrame) -> pd.DataFrame:
        whole = int(part["target"].iloc[0] // part["source_size"].iloc[0])
        budget = part["target"].iloc[0] - whole * part["source_size"].iloc[0]
        return pd.DataFrame({"no": part["no"], "size": part["size"], "rows": part["rows"], "whole": whole, "extra": fit(part["size"], part["rows"], budget)})

    plan = materialize(counted.filter("size > 0").groupBy("no").applyInPandas(fitted, "no long, size long, rows long, whole long, extra long"), "size-plan")
    planned = numbered.join(plan, ["no", "size"], "left").withColumn("bucket", F.shiftrightunsigned("key", 64 - _BUCKETS))
    some = planned.filter("extra > 0 and extra < rows")
    buckets = some.groupBy("no", "size", "bucket").agg(F.count("*").alias("n"), F.first("extra").alias("extra"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("no", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # ``room`` is how many of a bucket are picked; it exceeds the bucket where all of them are.
    rooms = buckets.select("no", "size", "bucket", "n", (F.col("extra") - before).alias("room"))
    roomy = some.join(rooms, ["no", "size", "bucket"])
    ranked = F.row_number().over(Window.partitionBy("no", "size", "bucket").orderBy("key", "doc_id", "source"))
    out = ["doc_id", "source", "row", "size", "source_size", "target"]
    whole = F.coalesce("whole", F.lit(0))
    plain = planned.filter("extra is null or extra = 0 or extra >= rows").select(*out, (whole + F.coalesce((F.col("extra") > 0).cast("long"), F.lit(0))).alias("copies"))
    clear = roomy.filter("room <= 0 or room >= n").select(*out, (whole + (F.col("room") > 0).cast("long")).alias("copies"))
    split = roomy.filter("room > 0 and room < n").withColumn("_rank", ranked).select(*out, (whole + (F.col("_rank") <= F.col("room")).cast("long")).alias("copies"))
    return plain.union(clear).union(split)


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` as the mix has them: each row as often as it is taken, with its number in ``copy``. Rows with equal ids, texts and sources are one."""
    taken = mix(docs, **settings).groupBy("doc_id", "source", "row").agg(F.sum("copies").alias("_copies")).filter("_copies > 0")
    keyed = docs.withColumns({"_row": F.xxhash64("text"), "_from": F.col("source").cast("string")}).dropDuplicates(["doc_id", "_from", "_row"])
    taken = taken.withColumnsRenamed({"doc_id": "_doc", "source": "_src", "row": "_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("_from").eqNullSafe(F.col("_src")) & (F.col("_row") == F.col("_hash"))
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return keyed.join(taken, same).withColumn("copy", copies).select(*[c for c in docs.columns if c != "copy"], "copy")
