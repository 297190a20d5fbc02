import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fathom.session import build_session
    s = build_session(master="local[8]", cpus=8, app="fathom-tests")
    yield s


@pytest.fixture(scope="session")
def wh(spark):
    from fathom.catalog import warehouse
    return warehouse(spark, SF_SMALL)


@pytest.fixture(scope="session")
def con():
    from oracle_util import duck
    return duck(SF_SMALL)
