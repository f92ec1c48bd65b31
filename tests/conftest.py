import tempfile

import pytest
from pyspark.sql import SparkSession

from linkhoard.sources import tables


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["small", "large"])
def plans(request, monkeypatch):
    """Run a test with the direct plans and with those for large tables."""
    if request.param == "large":
        monkeypatch.setattr(tables, "SMALL_ROWS", -1)
    return request.param
