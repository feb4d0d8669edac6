import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from longtide.session import local_session

    s = local_session(cpus=4, memory="4g", partitions=4)
    yield s


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(df):
    """Rows as sorted tuples, NaN and null comparable."""
    return sorted((tuple("NaN" if isinstance(v, float) and v != v else v for v in r) for r in df.collect()), key=repr)
