import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from navlib.session import local_session

    s = local_session("*", 8, app="navlib-tests")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
