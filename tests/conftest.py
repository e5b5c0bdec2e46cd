import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
for p in (str(ROOT), str(ROOT / "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)

from cellspan.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("tests").config("spark.driver.memory", "8g")
    builder = configure(builder, shuffle_partitions=4).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted plain tuples of chosen columns."""

    def collect(df, *columns):
        names = columns or df.columns
        return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)

    return collect
