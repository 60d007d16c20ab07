import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("RISKFEAT_TEST_SF", "/root/testdata/sf0.01")
SMALL_SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riskfeat.session import build_session

    s = build_session(master="local[8]", app_name="riskfeat-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck():
    from harness import duck_connect

    return duck_connect(SF_DIR)
