import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from burnup.session import checkpoint_dir, get_session
    s = get_session("burnup-tests", "local[4]", 4)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from oracle import duck
    return duck(SMALL)


@pytest.fixture(scope="session")
def tables(spark):
    from burnup.plans.domain import Tables
    return Tables(spark, SMALL)
