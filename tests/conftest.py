import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from funnelworks.session import get_session

    os.environ.setdefault("FUNNELWORKS_SCRATCH", tempfile.mkdtemp(prefix="fw-tests-"))
    s = get_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="fw-test-", dir="/tmp")


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
