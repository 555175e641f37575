import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terraloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, nulls first."""
    def collect(df, *cols):
        got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(got, key=lambda r: tuple((v is not None, v) for v in map(_plain, r)))
    return collect


def _plain(v):
    return str(v) if isinstance(v, (dict, list, tuple)) else v
