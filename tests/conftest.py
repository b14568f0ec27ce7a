import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tamizal.session import build_session

    session = build_session("tests", "4", 4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    return DATA
