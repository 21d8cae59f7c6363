import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_limits(monkeypatch):
    """Make every input count as too large for a broadcast."""
    from mapweave.operators import skew

    monkeypatch.setattr(skew, "will_broadcast", lambda df: False)


def rows(df):
    """Rows as sorted tuples, nulls first."""
    return sorted(map(tuple, df.collect()), key=lambda r: [(v is not None, v) for v in r])
