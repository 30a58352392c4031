import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martforge.session import get_session

    s = get_session("local[4]", app="martforge-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture(scope="session")
def layers(spark, sf):
    """The silver and gold layers of the small input, each table built on first use."""
    from martforge.plans import queries

    return queries.layers_of(spark, sf)
