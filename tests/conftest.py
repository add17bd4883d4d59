import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from bidscope.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app_name="bidscope-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def src_small(spark):
    from bidscope.sources.fixture import fixture_sources
    return fixture_sources(spark, SF_SMALL)
