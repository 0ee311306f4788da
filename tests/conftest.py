import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from evalspark.session import get_spark

    s = get_spark("local[4]", shuffle_partitions=8, app="evalspark-tests")
    yield s


SF = os.environ.get("EVALSPARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF
