"""Positions within groups, computed in bounded pieces so that no task holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import NO_LIMIT, check_limit
from ..sources.tables import is_small, settle
from .lookup import lookup

ROWS_PER_CHUNK = 1 << 18


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys, NULL being equal to NULL; the keys come from ``left``."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [left[k].eqNullSafe(other[f"_right_{k}"]) for k in keys]
    return left.join(other, same).drop(*[f"_right_{k}" for k in keys])


def number_rows(
    df: DataFrame,
    group: str,
    ord: str,
    *,
    ties: tuple[str, ...] = (),
    limit: int | str = NO_LIMIT,
    rn: str = "rn",
    extra: dict[str, str] | None = None,
    chunk: int = ROWS_PER_CHUNK,
    rows: int | None = None,
) -> DataFrame:
    """Add ``rn``, the 1-based position of each row in its group by ``ord`` and ``ties``.

    ``ord`` is a long; (``ord``, ``ties``) is unique in a group. A group is cut into chunks of
    ``chunk`` consecutive ``ord`` values: rows are counted per chunk (map-side first), the small
    chunk table is summed up per group, and rows are ranked inside their chunk only.

    NULL is a group like any other, and NULL ``ord`` values come first in their group, in both plans.

    ``limit`` keeps positions up to a limit; chunks behind it are skipped before any ranking. It may name a column that has one value
    in all rows of a group, -1 or NULL for no limit.
    ``extra`` adds group facts: ``{"total": column name}``, ``{"first": column name}``.
    ``rows`` is a known upper bound on the rows of ``df``; small tables are ranked directly.
    """
    extra = extra or {}
    most = F.col(limit) if isinstance(limit, str) else F.lit(limit)

    def within_limit(position: Column, bound: Column = most) -> Column:
        return bound.isNull() | (bound == NO_LIMIT) | (position <= bound)

    if is_small(rows):
        whole = Window.partitionBy(group)
        order = whole.orderBy(ord, *ties)
        facts = {
            "total": F.count("*").over(whole),
            "first": F.min(ord).over(whole),
        }
        numbered = df.withColumn(rn, F.row_number().over(order).cast("long")).select(
            "*", *[facts[name].alias(column) for name, column in extra.items()]
        )
        return numbered if limit == NO_LIMIT else numbered.filter(within_limit(F.col(rn)))
    cut = df.withColumn("_chunk", F.expr(f"`{ord}` div {chunk}"))
    sizes = cut.groupBy(group, "_chunk").agg(F.count("*").alias("_size"), F.min(ord).alias("_first"), F.max(most).alias("_most"))
    chunks = Window.partitionBy(group)
    before = F.coalesce(
        F.sum("_size").over(chunks.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    facts = {"total": F.sum("_size").over(chunks), "first": F.min("_first").over(chunks)}
    offsets = sizes.select(
        group, "_chunk", before.alias("_before"), "_most", *[facts[name].alias(column) for name, column in extra.items()]
    )
    if limit != NO_LIMIT:
        offsets = offsets.filter(within_limit(F.col("_before") + 1, F.col("_most")))
    offsets = offsets.drop("_most")
    within = Window.partitionBy(group, "_chunk").orderBy(ord, *ties)
    numbered = (
        _null_safe_join(cut, offsets, [group, "_chunk"])
        .withColumn("_local", F.row_number().over(within).cast("long"))
        .withColumn(rn, F.col("_before") + F.col("_local"))
        .select(*df.columns, rn, *extra.values())
    )
    return numbered if limit == NO_LIMIT else numbered.filter(within_limit(F.col(rn)))


def limit_per_source(urls: DataFrame, limit: int | None, source_id: str = "source_id", ord: str = "ord") -> DataFrame:
    """First ``limit`` rows of every source in input order; ``-1`` keeps all."""
    limit = check_limit(limit)
    if limit == NO_LIMIT:
        return urls
    return number_rows(urls, source_id, ord, limit=limit, rn="_rn").drop("_rn")


def limit_by_source(urls: DataFrame, sources: DataFrame, default: int | None = NO_LIMIT) -> DataFrame:
    """First rows of every source, as many as its ``url_limit`` in ``(source_id, url_limit)`` says.

    NULL stands for ``default``; -1 keeps all. Of several rows of one source the smallest limit counts, NULL is a source, and
    a source that isn't listed has the default limit.
    """
    default = check_limit(default)
    key = F.coalesce(F.col("source_id").cast("string"), F.lit("null"))
    given = F.coalesce(F.col("url_limit").cast("long"), F.lit(default).cast("long"))
    limits = sources.groupBy(key.alias("_limited")).agg(F.min(F.when(given != NO_LIMIT, given)).alias("_most"), F.lit(True).alias("_listed"))
    told = lookup(urls.withColumn("_source", key), limits, "_source", "_limited", spread=["ord", "url"])
    most = F.when(F.col("_listed"), F.col("_most")).otherwise(F.lit(default).cast("long"))
    ranked = number_rows(told.withColumn("_most", most), "source_id", "ord", limit="_most", rn="_rn")
    return ranked.select(*urls.columns)


def running_total(
    df: DataFrame, group: str, order: list[str], size: str, out: str, *, rows: int | None = None
) -> DataFrame:
    """Add ``out``, the sum of ``size`` over the rows before this one in its group.

    For orders that are no integers. Rows are range-partitioned by group and order, so that a
    large group spans many partitions; every partition is summed up on its own and shifted by
    the totals of the earlier partitions. The partition number is written with the rows because
    a second run of the range partitioning might cut elsewhere. ``rows`` is a known upper bound on
    the rows of ``df``; small tables are summed up directly.
    """

    def sum_before(window: WindowSpec, column: str) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    if is_small(rows):
        return df.withColumn(out, sum_before(Window.partitionBy(group).orderBy(*order), size))
    placed = settle(
        df.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()), "running-total", rows
    )
    totals = placed.groupBy(group, "_part").agg(F.sum(size).alias("_sum"))
    shifts = totals.select(group, "_part", sum_before(Window.partitionBy(group).orderBy("_part"), "_sum").alias("_shift"))
    within = Window.partitionBy(group, "_part").orderBy(*order)
    return (
        _null_safe_join(placed, shifts, [group, "_part"])
        .withColumn(out, F.col("_shift") + sum_before(within, size))
        .select(*df.columns, out)
    )
