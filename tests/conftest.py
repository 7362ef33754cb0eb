import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larderlake.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def path(tmp_path):
    """A folder of this test's own."""
    return str(tmp_path)


def rows(df, *order):
    """Rows as dicts, sorted by the given columns (default: all)."""
    found = [r.asDict() for r in df.collect()]
    keys = order or tuple(df.columns)
    return sorted(found, key=lambda r: tuple((r[k] is not None, str(r[k])) for k in keys))


def ts(text):
    return datetime.fromisoformat(text)


def day(text):
    return date.fromisoformat(text)
