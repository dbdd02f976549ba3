import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import local_session  # noqa: E402

DATA = os.environ.get("TIDEWATER_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=8, name="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
