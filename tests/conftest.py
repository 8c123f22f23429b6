import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quern-test-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def tiny_blocks(spark):
    """Every key with more than a handful of rows takes the split path."""
    spark.conf.set("quern.block.rows", "5")
    spark.conf.set("quern.broadcast.rows", "0")
    yield
    for name in ("quern.block.rows", "quern.broadcast.rows"):
        spark.conf.unset(name)


@pytest.fixture(params=["plain", "split"])
def both_ways(request, spark):
    """Run a test with plain windows and again with every key cut into blocks."""
    if request.param == "split":
        request.getfixturevalue("tiny_blocks")
    return request.param
