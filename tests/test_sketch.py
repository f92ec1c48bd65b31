"""Joins to hot keys where the sketch of their keys differs each time it is worked out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkhoard.operators import lookup as joins
from linkhoard.plans.oracles import all_oracles
from linkhoard.plans.queries import all_queries
from linkhoard.sources import tables

from .compare import difference

GIVEN = "/root/testdata/sf0.01"
# With these, a sketch that stands twice in a plan may be worked out once.
SHARED = ("spark.sql.execution.reuseSubquery", "spark.sql.exchange.reuse")


def _disordered(batches):
    for batch in batches:
        yield batch.iloc[np.random.default_rng().permutation(len(batch))]


@pytest.fixture
def own_sketches(spark, monkeypatch):
    """Which keys are left in a sketch depends on the order of rows, here another one each time."""
    kind = type(spark.range(0).stat)
    sketch = kind.freqItems

    def disordered(self, cols, support=None):
        keys = self.df.select(*cols)
        return sketch(keys.mapInPandas(_disordered, keys.schema).stat, cols, support)

    monkeypatch.setattr(kind, "freqItems", disordered)
    before = [spark.conf.get(name) for name in SHARED]
    for name in SHARED:
        spark.conf.set(name, "false")
    yield spark
    for name, value in zip(SHARED, before):
        spark.conf.set(name, value)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_loses_no_row_to_the_sketch(own_sketches, how):
    n = 5000
    left = own_sketches.range(n, numPartitions=4).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    right = left.select(F.col("k").alias("r"), (F.col("id") * 2).alias("v"))
    rows = joins.lookup(left, right, "k", "r", spread=["id"], how=how).collect()
    assert sorted((r["id"], -1 if r["v"] is None else r["v"]) for r in rows) == [(i, 2 * i) for i in range(n)]


@pytest.mark.parametrize("key", ("archive_run", "archive_sitemap", "archive_urls", "auto", "crawl_polite", "posted", "run_summary"))
def test_query_does_not_depend_on_the_sketch(own_sketches, monkeypatch, key):
    monkeypatch.setattr(tables, "SMALL_ROWS", -1)
    monkeypatch.setattr(joins, "HOT_SHARE", 0.05)  # a sketch of fewer keys than there are
    assert difference(all_queries()[key](own_sketches, GIVEN), GIVEN, all_oracles()[key]) is None
