import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadloom.session import local_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
