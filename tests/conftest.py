import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from chainlake import session as settings  # noqa: E402
from chainlake.functions import columns  # noqa: E402
from chainlake.operators import heads, ordered  # noqa: E402
from chainlake.plans.registry import Source  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield settings.prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def src(spark):
    return Source(spark, SF_DIR)


@pytest.fixture(scope="session")
def database():
    from check import database

    return database(SF_DIR)


@pytest.fixture
def hot(monkeypatch):
    """Slices so narrow that every key spans many of them."""
    monkeypatch.setattr(ordered, "SLICE", 7)
    monkeypatch.setattr(heads, "SLICE", 7)
    monkeypatch.setattr(columns, "BLOCKS_PER_BUCKET", 20)


def rows(df, *order):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def scratch(spark):
    return lambda name: settings.scratch(spark, name)
