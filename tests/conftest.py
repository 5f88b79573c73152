import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomwork.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", shuffle_partitions=4, memory="4g", app="loomwork-tests")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SF
