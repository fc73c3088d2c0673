from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from acceptance.compare import local_session, oracle_connection  # noqa: E402
from tidemark.session import tune  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = tune(local_session())
    yield session
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df):
    """The rows as a sorted list of tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
