"""Input readers and intermediate tables."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U


# Row counts up to this take the direct plans: one window per group, plain joins, broadcast keys.
SMALL_ROWS = 100_000


def is_small(rows: int | None) -> bool:
    """True if a known bound on a row count allows the direct plans."""
    return rows is not None and rows <= SMALL_ROWS


def work_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("linkhoard.work.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("linkhoard.work.dir", folder)
    return f"{folder.rstrip('/')}/linkhoard"


#: Tables written within the innermost ``passing``, with their paths.
_PASSING: ContextVar[list[tuple[DataFrame, str]] | None] = ContextVar("passing", default=None)
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the work folder and read it back.

    Cuts the lineage of loops, survives lost executors, and, being columnar, later steps read
    only the columns they need. The shuffle files of the write go with it, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{label}-{uuid4().hex}"
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if before is None else spark.conf.set(_SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    written = _PASSING.get()
    if written is not None:
        written.append((table, path))
    return table


@contextmanager
def passing() -> Iterator[Callable[[DataFrame], None]]:
    """Tables materialized within are deleted at the end, except those given to the function that this yields.

    For steps whose lasting result is a small table: nothing that reads the others may leave.
    """
    written: list[tuple[DataFrame, str]] = []
    kept: list[DataFrame] = []
    token = _PASSING.set(written)
    try:
        yield kept.append
    finally:
        _PASSING.reset(token)
        around = _PASSING.get()
        for table, path in written:
            if not any(table is k for k in kept):
                spark = table.sparkSession
                place = spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
            elif around is not None:
                around.append((table, path))


def measure(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize``, and aggregates of the rows written, taken while they are written."""
    seen = Observation()
    table = materialize(df.observe(seen, *[value.alias(name) for name, value in metrics.items()]), label)
    return table, seen.get


def settle(df: DataFrame, label: str, rows: int | None) -> DataFrame:
    """``materialize`` unless the rows are known to be few, when computing them twice is cheaper."""
    return df if is_small(rows) else materialize(df, label)


def url_list(df: DataFrame, source_id: str = "source_id", urls: str = "urls") -> DataFrame:
    """``(source_id, ord, url)`` from one list, or one single URL, per row."""
    listed = F.col(urls)
    if df.schema[urls].dataType.typeName() != "array":
        listed = F.array(listed)
    return df.select(F.col(source_id).alias("source_id"), F.posexplode(listed).alias("ord", "url")).select(
        "source_id", F.col("ord").cast("long").alias("ord"), "url"
    )


def arguments(df: DataFrame, source_id: str = "source_id", url: str = "url") -> DataFrame:
    """``(source_id, source)``: stripped, blank ones dropped, one independent run each."""
    return df.select(F.col(source_id).alias("source_id"), U.strip(F.col(url)).alias("source")).filter(
        F.col("source") != ""
    )


def read_url_text(spark: SparkSession, path: str) -> DataFrame:
    """``(source_id, ord, url)`` of text files with one URL per line; each file is one source.

    Lines are numbered by file, split and line without a global sort: ``ord`` grows along the
    file but has gaps, and rankings only compare it.
    """
    lines = spark.read.text(path).select(
        F.xxhash64("_metadata.file_path").alias("source_id"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        U.strip(F.col("value")).alias("url"),
    )
    # A split starts a new partition counter, so block start (bytes) and line counter order a file.
    return lines.filter(F.col("url") != "").select(
        "source_id", (F.col("_block") + F.col("_line").bitwiseAND(F.lit((1 << 33) - 1))).alias("ord"), "url"
    )
