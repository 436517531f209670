import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import tessera.plans.all  # noqa: E402,F401  (registers every query)

SF_SMALL = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.config import get_session

    s = get_session(master="local[*]", app_name="tessera-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck():
    from tests.compare import duck as make

    return make(SF_SMALL)


@pytest.fixture(scope="session")
def mart(spark):
    from tessera.mart import Mart

    return Mart(spark, SF_MID)
