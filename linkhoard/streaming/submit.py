"""Submit URLs as they arrive, with one result row per key however often a batch is tried."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.submit import Adapter, as_adapter
from ..schemas import RESULTS


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_KEYS = ["source_id", "ord"]


def submit_stream(
    urls: DataFrame,
    adapter: Adapter,
    results_path: str,
    checkpoint_path: str,
    *,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that submits a stream of ``(source_id, ord, url)``.

    The keys seen are kept as keyed state beside the checkpoint, on disk and partitioned by key, so a micro-batch costs what its own
    rows cost, however many results there are. It appends to its folder ``batch=<id>``; a batch tried again reads that folder alone
    and submits only what has no result yet. Keys must not be NULL. The checkpoint knows which keys were submitted: a new checkpoint needs a new
    folder of results, and one that holds results is refused. ``on_batch`` sees the written results of a batch, errored ones included.
    """
    send = as_adapter(adapter)
    missing = F.raise_error(F.lit("source_id and ord of a stream of URLs must not be NULL"))
    keyed = urls.withColumns({k: F.coalesce(k, missing.cast(urls.schema[k].dataType)) for k in _KEYS})

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = f"{results_path}/batch={batch_id}"
        spark.createDataFrame([], RESULTS).write.mode("append").parquet(target)  # so that a first try has a folder to read
        if batch_id == 0 and not recorded_results(spark, results_path).filter("batch <> 0").isEmpty():
            raise ValueError(f"{results_path} holds results of another checkpoint")
        tried = spark.read.schema(RESULTS).parquet(target).select(_KEYS)
        send(batch.join(tried, _KEYS, "left_anti")).write.mode("append").parquet(target)
        if on_batch is not None:
            on_batch(spark.read.schema(RESULTS).parquet(target), batch_id)

    spark = urls.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ON_DISK)
    try:  # a query takes the settings it is started with
        return (
            keyed.dropDuplicates(_KEYS)
            .writeStream.foreachBatch(run)
            .option("checkpointLocation", checkpoint_path)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        spark.conf.set(_PROVIDER, before)


def recorded_results(spark: SparkSession, results_path: str) -> DataFrame:
    """All result rows so far, with the ``batch`` that wrote them."""
    return spark.read.schema(f"{RESULTS}, batch long").option("basePath", results_path).parquet(results_path)
