import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from codecorpus.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test tables are absent")
    return SF


def values(df, *columns):
    """Rows as tuples, sorted."""
    return sorted(tuple(r) for r in df.select(*columns).collect())


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
