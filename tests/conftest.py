import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from contrail.session import local_session

    s = local_session("*", shuffle_partitions=8, app="contrail-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from contrail.session import scratch_dir

    return scratch_dir(spark, "test")
