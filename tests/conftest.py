import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rawstar.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted plain tuples of a DataFrame."""

    def collect(df, *columns):
        found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(found, key=lambda t: tuple((v is not None, str(v)) for v in t))

    return collect
