import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session
    s = build_session("local[4]", app="quarry-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def cat(spark):
    from quarry.fixtures import Catalog
    return Catalog(spark, SF001)
