"""One Spark session for all tests, in a time zone with daylight saving to show that results do not depend on it."""

from __future__ import annotations

import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """Local session."""
    root = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", str(root / "shared"))
               .config("spark.sql.warehouse.dir", str(root / "warehouse"))
               .config("spark.sql.session.timeZone", "America/New_York").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
