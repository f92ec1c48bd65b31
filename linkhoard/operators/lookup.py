"""Joins to a table with unique keys that stay balanced when one key is very common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import is_small

# A key is hot when it may hold more than this share of the rows: at most 1/share keys are.
HOT_SHARE = 0.005


def salt_count(df: DataFrame) -> int:
    """A key holding a third of all rows should fill its share of the shuffle partitions."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 3)


def lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    *,
    spread: list[str],
    how: str = "left",
    rows: int | None = None,
    unique: bool = False,
    narrow_right: bool = False,
    light: bool = False,
) -> DataFrame:
    """Join on ``left_key = right_key``, ``left`` or ``inner``; ``right`` holds each key at most once.

    The rows of a hot (or NULL) left key are spread over many partitions by a hash of the
    ``spread`` columns, and the matching right row is repeated for each. Hot keys come from a
    frequent-item sketch, which misses none above its threshold and holds at most
    ``1 / HOT_SHARE`` keys. Which others it holds depends on the order of rows, so it is worked out once,
    when the join is stated, and both sides spread the same keys: the join result does not depend on it.
    The right key column is dropped.

    ``rows`` is a known upper bound on the rows of ``left``; when it is small, or the left keys are
    declared ``unique``, no key can be hot and the join is a plain one. ``narrow_right`` first
    keeps only the right rows that are asked for: if ``left`` is small, its keys are broadcast and
    ``right`` is read without a shuffle. ``light`` says that right rows are a few short columns;
    together with a small ``left`` the rows asked for are then few and short enough to broadcast.
    """
    small = is_small(rows)
    if small and narrow_right and how == "inner":
        right = right.withColumnRenamed(right_key, "_right_key")
        return right.join(F.broadcast(left), F.col(left_key) == F.col("_right_key")).drop("_right_key")
    if narrow_right:
        wanted = left.select(F.col(left_key).alias(right_key))
        right = right.join(F.broadcast(wanted) if small else wanted.distinct(), right_key, "left_semi")
    right = right.withColumnRenamed(right_key, "_right_key")
    if small or unique:
        if small and narrow_right and light:
            right = F.broadcast(right)
        return left.join(right, F.col(left_key) == F.col("_right_key"), how).drop("_right_key")

    salts = salt_count(left)
    hot = [key for key in left.stat.freqItems([left_key], HOT_SHARE).head()[0] if key is not None]

    def is_hot(key: Column) -> Column:
        return F.coalesce(key.isin(hot), F.lit(False))

    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    copies = F.when(is_hot(F.col("_right_key")), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_left = left.withColumn(
        "_salt", F.when(is_hot(F.col(left_key)) | F.col(left_key).isNull(), salt).otherwise(F.lit(0))
    )
    salted_right = right.withColumn("_right_salt", F.explode(copies))
    on = (F.col(left_key) == F.col("_right_key")) & (F.col("_salt") == F.col("_right_salt"))
    return salted_left.join(salted_right, on, how).drop("_salt", "_right_salt", "_right_key")
