import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stratum.session import local_session
    s = local_session("*", 8, app="stratum-tests", max_failures=4)
    yield s
    s.stop()


@pytest.fixture()
def lake(spark):
    from stratum.session import Lake
    return Lake.fresh(spark, "test")
