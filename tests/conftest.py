import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.fixture(scope="session")
def spark():
    from hirescope.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="hirescope-tests")
    yield s
    s.stop()


def column(spark, values, type_="string"):
    """One-column DataFrame ``t`` from a Python list."""
    return spark.createDataFrame([(v,) for v in values], f"t {type_}")
