import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from hammerline.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__sql__streaming__stateStore__maintenanceInterval="600s",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def values(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def column(df, name=None):
    return [r[name or df.columns[0]] for r in df.collect()]
