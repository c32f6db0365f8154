import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from harborline.session import local_session

    return local_session(8)


@pytest.fixture(scope="session")
def duck():
    from oracle import connect

    return connect(SF)


@pytest.fixture(scope="session")
def sf():
    return SF
