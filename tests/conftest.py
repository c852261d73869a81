import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from corpusloom.session import get_spark

    session = get_spark(
        "tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    # Models defined in a test module must be importable in the workers.
    session.sparkContext.environment["PYTHONPATH"] = os.path.join(ROOT, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


def values(df, *columns):
    """Rows as plain tuples, in the frame's order."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def pairs(df):
    """A two-column frame as a dict."""
    return {r[0]: r[1] for r in df.collect()}
