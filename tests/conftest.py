import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "millrace-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rows():
    """All rows of a frame as sorted tuples."""

    def sorted_rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return sorted_rows
