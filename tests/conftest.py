import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch.session import clear_scratch, local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CORES", "8"), "tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
