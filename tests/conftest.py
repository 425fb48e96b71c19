import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lakekit.session import build_session

    session = build_session(
        "local[8]", "lakekit-tests",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.default.parallelism": "8"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, NULLs first."""

    def collect(df, *columns):
        found = (df.select(*columns) if columns else df).collect()
        return sorted((tuple(r) for r in found), key=lambda r: [(v is not None, v) for v in r])

    return collect
