import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("LECTERN_TEST_SF", "/root/testdata/sf0.001")
SF_ORACLE = os.environ.get("LECTERN_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from lectern.session import get_session

    s = get_session("local[*]", conf={"spark.sql.shuffle.partitions": "8"})
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
